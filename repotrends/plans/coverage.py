"""Report of snapshot files that are expected but absent."""

from pyspark.sql import DataFrame, SparkSession

from ..operators import missing_snapshots, snapshot_calendar
from ..sources import list_files


def snapshot_coverage(span: DataFrame, files: DataFrame, days, hour: int = 15) -> DataFrame:
    """Expected snapshots of the span with no entry in `files` (column `file_name`)."""
    return missing_snapshots(snapshot_calendar(span, days, hour), files)


def folder_coverage(spark: SparkSession, path, span: DataFrame, days, hour: int = 15) -> DataFrame:
    """Expected snapshots that a folder lacks, by a listing of it; its files are not opened."""
    return snapshot_coverage(span, list_files(spark, path), days, hour)
