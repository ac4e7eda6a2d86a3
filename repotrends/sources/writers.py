"""Sinks. All of them write from the executors; no result passes through the driver."""

import hashlib
import json
from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.checks import require_unique
from ..schemas import SUMMARY, SUMMARY_KEYS
from .monthly import MonthlyTable
from .readers import TSV_OPTIONS, read_events_and_rest


def write_tsv(df: DataFrame, path: str) -> None:
    """Replace a folder with TSV part files, each with a header (interchange only)."""
    df.write.mode("overwrite").options(**TSV_OPTIONS).csv(path)


def _tsv_bytes(df: DataFrame):
    """No less than the bytes of a row in a TSV file: quotes are doubled, and each field may be quoted."""
    def field(name):
        value = F.col(f"`{name}`").cast("string")
        quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))
        return F.coalesce(F.octet_length(value) + quotes, F.lit(0)).cast("long") + 3

    return reduce(add, map(field, df.columns))


def write_bounded_tsv(df: DataFrame, path: str, max_bytes: int = 1 << 30) -> None:
    """`write_tsv` with no file over `max_bytes`, but for one that holds a single longer row.

    A file of quoted line breaks is read by one task, so the bound is that task's. Files are cut by the
    number of rows, from the widths that a pass over the rows measures: rows of up to four times the
    mean, then those of up to 16 times that, and so on, each of these classes with a number of its
    own, so a few wide rows don't make all files small. The success marker comes with the last
    class. Pass a stored table: it is read once for the widths and once for each class (five if the widest
    row is a hundred thousand times the mean).
    """
    width = _tsv_bytes(df)
    header = sum(len(c.encode()) + c.count('"') + 3 for c in df.columns)
    room = max(1, max_bytes - header)
    mean, widest = df.agg(F.avg(width), F.max(width)).first()
    mean, widest = mean or 1, widest or 1
    edges = [0, int(4 * mean) + 1]
    while edges[-1] < widest:
        edges.append(16 * edges[-1])
    for n, (low, high) in enumerate(zip(edges, edges[1:])):
        df.filter((width > low) & (width <= high)).write.mode("append" if n else "overwrite").options(**TSV_OPTIONS).option(
            "maxRecordsPerFile", max(1, room // min(high, widest))).option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", str(high >= widest).lower()).csv(path)


def write_plain_tsv(df: DataFrame, path: str) -> None:
    """Replace a folder with headerless TSV part files."""
    df.write.mode("overwrite").options(**{**TSV_OPTIONS, "header": False}).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a folder with headered CSV; part files keep the order of a sorted input."""
    df.write.mode("overwrite").option("header", True).csv(path)


def drop_blank_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines with at least one character (blanks count as characters)."""
    return lines.filter(F.length(col) > 0)


def _exists(reader, path: str) -> bool:
    try:
        reader(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def stage_is_complete(spark: SparkSession, path: str) -> bool:
    """True when a write to `path` ran to its end and left its success marker."""
    return _exists(spark.read.format("binaryFile").load, path.rstrip("/") + "/_SUCCESS")


def _made_from(spark: SparkSession, path: str) -> str | None:
    """What a complete stage says it was made from; None if it says nothing."""
    note = path.rstrip("/") + "/_made_from"
    if not stage_is_complete(spark, path) or not _exists(spark.read.text, note):
        return None
    row = spark.read.text(note).first()
    return row and row[0]


def write_once(df: DataFrame, path: str, partition_by=(), made_from=None) -> DataFrame:
    """Write a stage as Parquet unless it is already complete; return the stored table.

    Save mode `ignore` asks only whether the folder exists, so it would keep the remains of
    a job that died half-way. Asking for the success marker redoes such a stage.

    made_from  options and input files, as JSON values. They are noted beside the stage after
    it is written; a stage that was made from anything else is redone.
    """
    spark = df.sparkSession
    note = None if made_from is None else hashlib.sha256(
        json.dumps(made_from, sort_keys=True).encode()).hexdigest()
    if not stage_is_complete(spark, path) or note != (note and _made_from(spark, path)):
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        if note:
            spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode(
                "overwrite").text(f"{path.rstrip('/')}/_made_from")
    return spark.read.schema(df.schema).parquet(path)


def months_held(spark: SparkSession, path: str) -> list[str]:
    """Months that were written to their end, from the table's commit log; short by nature."""
    return sorted(MonthlyTable(spark, path, StructType()).records())


def append_missing_months(df: DataFrame, path: str, month: str = "yymm") -> DataFrame:
    """Add only the months the table does not hold yet; return the whole table.

    Rows without a month are left out. The months held become a literal filter, which Catalyst
    pushes through grouping and windows by month down to the scan: where the month comes from the
    file name, files of held months are not opened. A month is held once the commit log has a record of
    it; what a killed run left is not read.
    """
    table = MonthlyTable(df.sparkSession, path, df.schema, month)
    held = sorted(table.records())
    table.write(df.filter(F.col(month).isNotNull() & ~F.col(month).isin(held)))
    return table.read()


def write_counted(**outputs) -> DataFrame:
    """Write tables, given as name=(rows, path), and return the number of rows of each: (name,
    n_rows). They are counted in passing, so nothing is read again."""
    counts = []
    for name, (df, path) in outputs.items():
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(path)
        counts.append((name, seen.get["n_rows"]))
    return df.sparkSession.createDataFrame(counts, "name string, n_rows long")


def store_events(spark: SparkSession, path, out: str) -> tuple[DataFrame, DataFrame]:
    """Parse event files once into Parquet; return the stored events, and the lines that failed to
    parse as (file_name, broken_line), byte for byte. They lie apart, so neither is read with the other."""
    rows = read_events_and_rest(spark, path).withColumn("broken", F.col("broken_line").isNotNull())
    rows.write.mode("overwrite").partitionBy("broken").parquet(out)
    stored = spark.read.schema(rows.schema).parquet(out)
    return (stored.filter(~F.col("broken")).drop("broken", "broken_line"),
            stored.filter("broken").select("file_name", "broken_line"))


def write_jdbc_table(summary: DataFrame, url: str, table: str, properties: dict,
                     num_partitions: int = 8) -> None:
    """Full reload of the summary table: create it if absent, else empty and refill it.

    The key is checked first, so a duplicate stops the load before the table is emptied.
    `num_partitions` bounds the connections the database sees at once. Pass a stored
    summary: the check and the load each read it.
    """
    require_unique(summary, SUMMARY_KEYS)
    (
        summary.select(*SUMMARY.fieldNames())
        .write.format("jdbc").mode("overwrite")
        .options(
            url=url, dbtable=table, truncate="true", numPartitions=str(num_partitions),
            createTableColumnTypes=(
                "year VARCHAR(4), month VARCHAR(2), primary_language VARCHAR(255)"
            ),
            **properties,
        )
        .save()
    )
