"""Which snapshot files a period should have, and which of them are missing."""

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import file_month_key, snapshot_file_name

# The two collection calendars (first month, last month, days, hour).
PUSH_CALENDAR = ("2022-01", "2026-05", (2,), 15)
PULL_REQUEST_CALENDAR = ("2025-12", "2026-05", (2, 9, 16, 23), 15)


def calendar_span(spark: SparkSession, first_month: str, last_month: str) -> DataFrame:
    """A span given as `yyyy-MM` months."""
    first, last = (datetime.date.fromisoformat(m + "-01") for m in (first_month, last_month))
    return spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))


def span_of(df: DataFrame, ts: str) -> DataFrame:
    """The span of months that a table's timestamps cover."""
    month = lambda c: F.trunc(c.cast("date"), "month")
    return df.agg(month(F.min(ts)).alias("first"), month(F.max(ts)).alias("last"))


def snapshot_calendar(span: DataFrame, days, hour: int = 15) -> DataFrame:
    """One row per expected snapshot: every month of the span, on each of the days it has."""
    months = span.select(F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("month"))
    day = F.explode(F.array(*(F.lit(d) for d in days)))
    dated = months.select("month", day.alias("day")).withColumn(
        "snapshot_date", F.date_add("month", F.col("day") - 1))
    return dated.filter(F.month("snapshot_date") == F.month("month")).select("snapshot_date").withColumn("file_name", snapshot_file_name(F.col("snapshot_date"), hour))


def missing_snapshots(expected: DataFrame, present: DataFrame, key: str = "file_name") -> DataFrame:
    """Expected snapshots with no file."""
    return expected.join(present.select(key).distinct(), key, "left_anti").select(*expected.columns)


def files_per_month(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Sorted file names per month key. A month has at most 31 x 24 hourly names; repeats
    collapse before they are gathered."""
    keyed = files.select(file_month_key(F.col(name)).alias("yymm"), name)
    return keyed.filter(F.col("yymm").isNotNull()).distinct().groupBy("yymm").agg(
        F.sort_array(F.collect_list(name)).alias("files")
    )
