"""Latest value, top-n and seeded samples, and the list of repositories to look up."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import file_month_key, present
from ..schemas import PUSH_EVENT, SAMPLE_PER_MONTH

FAN = 1000   # parts of a group that are merged in one task


def push_heads(events: DataFrame) -> DataFrame:
    """Pushes with both a repository and a head commit, under their file's month key."""
    month = file_month_key(F.col("file_name")).alias("yymm")
    return events.filter(F.col("type") == PUSH_EVENT).select(
        month, F.col("repo.name").alias("repo_name"), F.col("payload.head").alias("head_sha"),
        "created_at", F.col("id").alias("event_id"),
    ).filter(present(F.col("repo_name"), F.col("head_sha")) & F.col("yymm").isNotNull())


def latest_per_key(df: DataFrame, keys, values, order) -> DataFrame:
    """Values of the last row per key by event time; one partial row per task and key is
    shuffled, so a hot key costs no more than any other."""
    last = F.max_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("last")).select(*keys, "last.*")


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """Top n by an order that has no ties; each task sends on at most n rows."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, group: str, n: int, order) -> DataFrame:
    """First n rows of each group, for an n of which `FAN` times as many rows fit in a task.

    Every group is first cut in parts by hash, as many as a shuffle has tasks, then in a thousandth of
    them, and so on to the whole, so a hot group's rows never meet in one task: what meets is n rows for
    each of at most `FAN` parts. The top n of a group is always within the top n of its parts. A filter
    on the group reaches the scan.
    """
    def cut(rows, *part):
        w = Window.partitionBy(*part).orderBy(*order)
        return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).drop("rank")

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
    while parts > 1:
        rows = cut(rows.withColumn("part", F.pmod("part", F.lit(parts))), group, "part")
        parts = -(-parts // FAN)
    return cut(rows.drop("part"), group)


def distinct_rows(df: DataFrame, *cols) -> DataFrame:
    """Different values of the columns."""
    return df.select(*cols).distinct()


def distinct_count(df: DataFrame, col: str, *keys, name: str = "unique_repos") -> DataFrame:
    """Different non-null values of a column, in all or per key; counted in two steps, so no
    key's values meet in one task."""
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(name))


def _digest(key: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def seeded_sample(df: DataFrame, group: str, key: str, n: int = SAMPLE_PER_MONTH,
                  seed: str = "0") -> DataFrame:
    """Up to n rows per group, picked by a hash of seed and key; the input is read twice.

    Uniform over keys and the same on every run and partitioning, unlike `rand(seed)`. The n smallest
    hashes are found by counting: hashes fall in steps, 64 of them from one power of two to the
    next, so a group has at most 3,841 counts, and tasks send counts alone. They tell in which step
    the n-th row is. Rows beyond that step are dropped where they are read; the others, about n and a
    hundredth, are ranked step by step, so neither a hot group nor a large n meets in one task. Rows of
    one key are of one step. Rows without a key come first; those without a group are a group.
    """
    digest = _digest(key, seed)
    # Steps are ordered as the digests are: a digit string's first 60 bits, on a logarithmic scale.
    bits = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    step = F.coalesce(F.floor(64 * F.log2(bits + 1)).cast("int"), F.lit(-1))
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(group).alias("of"), step.alias("step"))
    counts = rows.groupBy("of", "step").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("of").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    last = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).filter(
        F.col("before") < n).groupBy("of").agg(F.max("step").alias("last"), F.max("before").alias("before"))
    near = rows.alias("r").join(last.alias("l"), F.col("r.of").eqNullSafe(F.col("l.of")) & (
        F.col("step") <= F.col("last"))).select("r.*", "last", "before")
    place = F.row_number().over(Window.partitionBy("of", "step").orderBy(_digest(f"row.{key}", seed), f"row.{key}"))
    return near.withColumn("place", place).filter(
        (F.col("place") <= n) & ((F.col("step") < F.col("last")) | (F.col("before") + F.col("place") <= n))).select("row.*")


def metadata_targets(heads: DataFrame, n: int = SAMPLE_PER_MONTH, seed: str = "0") -> DataFrame:
    """Which repositories to look up: per month a sample of n, each with its latest head."""
    # Numeric ids of unequal length compare by length first.
    order = ["created_at", F.length("event_id"), "event_id"]
    # The aggregation sorts by its keys: the name goes first, for a task sees few months.
    latest = latest_per_key(heads, ["repo_name", "yymm"], ["head_sha"], order)
    # Read once: a log is costlier to parse again than what n rows of each part cost.
    return top_n_per_group(latest, "yymm", n, [_digest("repo_name", seed), F.col("repo_name")]).select(
        "yymm", "repo_name", "head_sha")
