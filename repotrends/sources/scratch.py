"""Where short-lived tables go."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder path every executor can reach.

    A cluster names its shared folder in `spark.checkpoint.dir`. Only a local session
    without that setting may use the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = "file://" + tempfile.mkdtemp(prefix="repotrends-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
