"""The given tables in the roles of the library's inputs.

lineitem = pushes (part = repository, ship date = time), part = metadata (brand = language,
name = commit message, type = author address), orders = a second push log (customer =
repository, order = head commit), events and documents = the raw event log, documents and
labels = messages with a nullable second field.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from repotrends.operators import attach_dominant, count_by, dominant_category
from repotrends.schemas import OTHER_LANGUAGE, PULL_REQUEST_EVENT, PUSH_EVENT
from repotrends.sources import scratch_path

# Stand-ins for the fixed lists: the given texts hold none of the real terms.
BRANDS = tuple(f"Brand#{i}" for i in range(1, 15))
TERMS = ("license", "apache", "mit")
RULES = {
    "terms": ("red", "cold"),
    "email_terms": ("promo",),
    "buckets": (
        ("feat", ("ring", "gear")), ("fix", ("bolt",)), ("refactor", ("widget",)), ("docs", ("plate",)),
    ),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pushes(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.lit(PUSH_EVENT).alias("event_type"),
        F.col("l_partkey").alias("repo_name"),
        F.col("l_suppkey").cast("string").alias("head_sha"),
        F.col("l_shipdate").cast("date").cast("string").alias("created_at"),
    )


def metadata(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("repo_name"),
        F.pmod("p_partkey", F.lit(100)).cast("string").alias("head_sha"),
        F.col("p_name").alias("commit_message"),
        F.col("p_type").alias("author_email"),
        F.when(size < 4, "Unknown").when(size == 5, "").otherwise(F.col("p_brand"))
        .alias("primary_language"),
    )


def messages(spark, sf):
    """Labelled and unlabelled documents: NULL message where quality is 0, NULL address
    where there is no label."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("repo_name"),
        F.when(F.col("quality") == 0, F.lit(None)).otherwise(F.col("text")).alias("commit_message"),
        F.concat(F.lit("Toxic"), F.col("toxic").cast("string")).alias("author_email"),
        F.when(F.col("quality") == 1, F.col("lang")).when(F.col("quality") == 0, "")
        .alias("primary_language"),
    )


def pull_requests(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("source").alias("repo_name"), F.col("lang").alias("title"),
        F.col("text").alias("body"), F.lit("").alias("head_ref"),
    )


def language_bytes(spark, sf):
    """Bytes per repository and language, added up over the documents."""
    return table(spark, sf, "documents").groupBy(
        F.col("source").alias("repo_name"), F.col("lang").alias("language")
    ).agg(F.sum("n_chars").alias("bytes"))


def heads(spark, sf):
    """Order rows as pushes under the month key of their snapshot file."""
    return table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyMM").alias("yymm"),
        F.col("o_custkey").alias("repo_name"),
        F.col("o_orderkey").cast("string").alias("head_sha"),
        F.col("o_orderdate").cast("date").cast("string").alias("created_at"),
        F.col("o_orderkey").cast("string").alias("event_id"),
    )


def ai_repos(spark, sf):
    """Urgent order lines per part as matching pull requests, with the part's brand."""
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    counted = count_by(
        lines.join(urgent.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")),
        "l_partkey",
    )
    brands = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("language"),
        F.col("p_size").alias("bytes"),
    )
    best = dominant_category(brands, "l_partkey", allowed=BRANDS)
    return attach_dominant(counted, best, "l_partkey", fallback=OTHER_LANGUAGE)


def event_log(spark, sf):
    """The given events and documents as raw log lines: pushes, pull requests, other types,
    and one kind of line that breaks off half-way."""
    kind = F.col("event_type")
    push = kind.isin("click", "purchase")
    line = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.when(push, PUSH_EVENT).when(kind == "view", "WatchEvent").when(kind == "error", PUSH_EVENT)
        .otherwise("ForkEvent").alias("type"),
        F.struct(F.concat(F.lit("org/r"), F.col("user_id")).alias("name")).alias("repo"),
        F.struct(F.when(kind == "click", F.md5(F.col("event_id").cast("string"))).otherwise("").alias("head"))
        .alias("payload"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    ))
    broken = F.expr("substring(line, 1, length(line) - 12)")
    events = table(spark, sf, "events").withColumn("line", line).select(
        F.when(kind == "error", broken).otherwise(F.col("line")).alias("value")
    )
    pull = F.struct(
        F.col("lang").alias("title"), F.col("text").alias("body"),
        F.struct(F.col("source").alias("ref")).alias("head"),
    )
    prs = table(spark, sf, "documents").select(F.to_json(F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.lit(PULL_REQUEST_EVENT).alias("type"),
        F.struct(F.col("source").alias("name")).alias("repo"),
        F.struct(pull.alias("pull_request")).alias("payload"),
    )).alias("value"))
    return events.unionByName(prs)


def stored_log(spark, sf):
    """The log as gzip files in a fresh shared folder; returns the folder."""
    path = scratch_path(spark, "log")
    event_log(spark, sf).write.option("compression", "gzip").text(path)
    return path


def write_named_files(spark, lines, path):
    """Gzip event files under real names: `lines` has value and file, and each file is written whole by
    one task. Their number is bounded by the calendar."""
    parts = scratch_path(spark, "named")
    lines.select("value", "file").repartition("file").write.partitionBy("file").option("compression", "gzip").text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    files.mkdirs(target)
    for row in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(parts).select("path").collect():
        name = row["path"].split("/file=")[1].split("/")[0]
        place = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        files.delete(place, False)   # a file that is written anew
        files.rename(jvm.org.apache.hadoop.fs.Path(row["path"]), place)


def order_lines(spark, sf):
    """Orders as pushes in the snapshot file of their month."""
    return table(spark, sf, "orders").select(
        F.to_json(F.struct(
            F.col("o_orderkey").cast("string").alias("id"), F.lit(PUSH_EVENT).alias("type"),
            F.struct(F.concat(F.lit("org/r"), F.col("o_custkey")).alias("name")).alias("repo"),
            F.struct(F.col("o_orderkey").cast("string").alias("head")).alias("payload"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'").alias("created_at"))).alias("value"),
        F.date_format("o_orderdate", "yyyy-MM-'02-15.json.gz'").alias("file"), "o_orderstatus", "o_orderkey")
