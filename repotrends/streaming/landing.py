"""Land only the event files not landed before.

The file source's checkpoint remembers every file it has read, which replaces a per-file
existence test, and the file sink commits whole batches, so a lost executor or a killed run
leaves neither gaps nor repeats.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import file_month_key
from ..operators import pull_request_events, push_events
from ..schemas import EVENT, PULL_REQUEST_LINE


def push_stream(spark: SparkSession, path: str, max_files: int = 10_000) -> DataFrame:
    """Pushes of new files, with the month key of their file."""
    raw = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", max_files).json(path)
    return push_events(raw, file_month_key(F.col("_metadata.file_name")).alias("yymm"))


def pull_request_stream(spark: SparkSession, path: str, max_files: int = 10_000) -> DataFrame:
    """Pull requests of new files."""
    reader = spark.readStream.schema(PULL_REQUEST_LINE).option("maxFilesPerTrigger", max_files)
    return pull_request_events(reader.json(path))


def land_new_files(stream: DataFrame, dest: str, checkpoint: str, partition_by=()) -> None:
    """Append everything new to a Parquet table, then stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(dest).awaitTermination()
