"""Scans. Every reader passes an explicit schema, so no pass over the data infers one."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import file_month_key
from ..schemas import (
    AI_REPOS, AI_REPOS_WITH_LANGUAGE, ENRICHED, EVENT, LANGUAGE_BYTES, METADATA, PULL_REQUEST_LINE,
)

# NULL as \N keeps it apart from the empty string, which is written as ""; quotes are doubled, as
# in RFC 4180. A text that is exactly \N comes back as NULL.
TSV_OPTIONS = {
    "sep": "\t", "header": True, "quote": '"', "escape": '"', "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


NO_MONTH = "none"   # the month of files whose name carries none


class MissingInputError(RuntimeError):
    """An input path or table that has to hold data holds none."""


def _load(reader, path, what):
    try:
        return reader(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise MissingInputError(f"no {what} at {path}") from e
        raise


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise MissingInputError(f"{what} is empty")
    return df


def input_report(spark: SparkSession, **inputs) -> DataFrame:
    """Which of a job's inputs can be used, before it starts: (name, n_rows) of inputs given as name=(reader,
    path); n_rows is NULL where nothing is at the path, and 0 where it holds no rows."""
    counts = []
    for name, (reader, path) in inputs.items():
        try:
            rows = reader(spark, path)
        except MissingInputError:
            rows = None
        # Counting is lazy: all inputs are counted by the one job that reads the report.
        counts.append(spark.range(1).select(F.lit(name).alias("name"), F.lit(None).cast("long").alias("n_rows"))
                      if rows is None else rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows"))
    return reduce(DataFrame.unionByName, counts)


def list_files(spark: SparkSession, path) -> DataFrame:
    """(path, file_name, length, modified, yymm) of the files under a path. It is a listing: without
    the column `content` no file is opened. Files whose name carries no month have yymm NULL."""
    name = F.element_at(F.split("path", "/"), -1)
    files = _load(spark.read.format("binaryFile").load, path, "files")
    return files.select("path", name.alias("file_name"), "length", F.col("modificationTime").alias("modified"),
                        file_month_key(name).alias("yymm"))


def file_stamps(files: DataFrame) -> DataFrame:
    """(yymm, stamp): per month a digest of its files' paths, lengths and times; it changes when a
    file comes, goes or is written anew. A month has at most 31 x 24 hourly files."""
    one = F.concat_ws("|", "path", "length", F.unix_micros("modified"))
    return files.groupBy(F.coalesce("yymm", F.lit(NO_MONTH)).alias("yymm")).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list(one)), "\n"), 256).alias("stamp"))


def read_events(spark: SparkSession, path, with_file: bool = False) -> DataFrame:
    """Newline-delimited JSON event files (gzip or plain), all files as one table.

    A line that fails to parse comes back with NULL fields and falls to any filter on
    `type`. `with_file` adds the source file's name for month grouping.
    """
    df = _load(spark.read.schema(EVENT).json, path, "event files")
    return df.select("*", F.col("_metadata.file_name").alias("file_name")) if with_file else df


def read_events_and_rest(spark: SparkSession, path) -> DataFrame:
    """The event files with two more columns: `file_name`, and `broken_line`, the whole text of a line that
    fails to parse, NULL for all others."""
    schema = StructType(EVENT.fields + [StructField("broken_line", StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "broken_line")
    return _load(reader.json, path, "event files").select("*", F.col("_metadata.file_name").alias("file_name"))


def read_pull_request_events(spark: SparkSession, path) -> DataFrame:
    """The event files with the fields of a pull request. The parser stops at the type of
    a line that fails the filter, which is quicker than reading lines and parsing them."""
    return _load(spark.read.schema(PULL_REQUEST_LINE).json, path, "event files")


def read_event_lines(spark: SparkSession, path) -> DataFrame:
    """The same files as raw text lines, one JSON document per row in `value`."""
    return _load(spark.read.text, path, "event files")


def read_metadata(spark: SparkSession, path) -> DataFrame:
    """Metadata files, each one JSON array; no file at all gives an empty table."""
    try:
        return _load(spark.read.schema(METADATA).option("multiLine", True).json, path, "metadata")
    except MissingInputError:
        return spark.createDataFrame([], METADATA)


def read_enriched_tsv(spark: SparkSession, path) -> DataFrame:
    """Headered TSV interchange files. Quoted fields may hold line breaks, so one file is
    one task here; stages inside a job hand over Parquet instead."""
    return _load(
        spark.read.schema(ENRICHED).options(**TSV_OPTIONS).option("multiLine", True).csv,
        path, "enriched pushes",
    )


def read_ai_repos(spark: SparkSession, path, with_language: bool = False) -> DataFrame:
    """CSV with header: repositories and their matching pull requests."""
    schema = AI_REPOS_WITH_LANGUAGE if with_language else AI_REPOS
    return _load(spark.read.schema(schema).option("header", True).csv, path, "repository counts")


def read_language_bytes(spark: SparkSession, path) -> DataFrame:
    """Parquet rows (repo_name, language, bytes)."""
    return _load(spark.read.schema(LANGUAGE_BYTES).parquet, path, "language bytes")


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict, **bounds) -> DataFrame:
    """Whole table over JDBC. `bounds` (partitionColumn, lowerBound, upperBound,
    numPartitions) split a large one into parallel reads; credentials come with `properties`."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, **properties, **{k: str(v) for k, v in bounds.items()}
    ).load()
