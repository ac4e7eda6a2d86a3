"""Session settings."""

from pyspark.sql import SparkSession

# Settings the jobs rely on, on a cluster as well. The adaptive planner merges small shuffle
# partitions and splits those of hot keys, but not uniformly large ones: so it starts wide.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
BYTES_PER_PARTITION = 256 << 20


def configure(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Apply the settings to a session of a cluster, with shuffles as wide as the input asks for."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    wide = max(200, -(-input_bytes // BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wide))
    spark.conf.set("spark.sql.shuffle.partitions", str(wide))
    return spark


def local_session(name: str = "repotrends", cores: str = "*", memory: str = "8g") -> SparkSession:
    """One-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
