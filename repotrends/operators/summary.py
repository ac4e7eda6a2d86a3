"""Monthly language summary, from enriched rows or straight from pushes and metadata."""

from pyspark.sql import DataFrame, functions as F

from ..functions import ai_flag, first_match_bucket, is_known, month_of, year_of
from ..schemas import (
    COMMIT_TERMS, DEFAULT_TASK, EMAIL_TERMS, SUMMARY_KEYS, TASK_BUCKETS, UNKNOWN_LANGUAGE,
)
from .enrich import matching_rows


def _task_names(buckets, default):
    return [label for label, _ in buckets] + [default]


def _count_columns(buckets, default):
    return ["total_commits", "unique_repos", "ai_commits",
            *(f"{t}_commits" for t in _task_names(buckets, default))]


def classify(rows: DataFrame, terms=COMMIT_TERMS, email_terms=EMAIL_TERMS, buckets=TASK_BUCKETS,
             default=DEFAULT_TASK, unknown=UNKNOWN_LANGUAGE) -> DataFrame:
    """Rows of a known language with `is_ai` and `task_type`."""
    message, email = F.col("commit_message"), F.col("author_email")
    return rows.filter(is_known(F.col("primary_language"), unknown)).select(
        *[c for c in rows.columns if c not in ("commit_message", "author_email")],
        ai_flag(message, email, terms, email_terms).alias("is_ai"),
        first_match_bucket(message, buckets, default).alias("task_type"),
    )


def _ai_by_task(task):
    return F.count_if((F.col("is_ai") == 1) & (F.col("task_type") == task))


def monthly_language_summary(enriched: DataFrame, buckets=TASK_BUCKETS, default=DEFAULT_TASK,
                             **rules) -> DataFrame:
    """Counts per year, month and language over enriched rows.

    The one distinct count makes Spark group by (keys, repository) first, so neither a hot
    language nor a hot repository lands in one task.
    """
    rows = classify(enriched, buckets=buckets, default=default, **rules).select(
        year_of(F.col("created_at")).alias("year"),
        month_of(F.col("created_at")).alias("month"),
        "primary_language", "repo_name", "is_ai", "task_type",
    )
    return rows.groupBy(*SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias("total_commits"),
        F.count_distinct("repo_name").alias("unique_repos"),
        F.sum("is_ai").alias("ai_commits"),
        *(_ai_by_task(t).alias(f"{t}_commits") for t in _task_names(buckets, default)),
    )


def metadata_weights(meta: DataFrame, buckets=TASK_BUCKETS, default=DEFAULT_TASK, keys=("repo_name",),
                     **rules) -> DataFrame:
    """Per key and language: metadata rows, and how many of them count as AI work, in all and
    by task. Texts are classified once per metadata row, not once per push."""
    return classify(meta, buckets=buckets, default=default, **rules).groupBy(
        *keys, "primary_language"
    ).agg(
        F.count(F.lit(1)).alias("total_commits"),
        F.sum("is_ai").alias("ai_commits"),
        *(_ai_by_task(t).alias(f"{t}_commits") for t in _task_names(buckets, default)),
    )


def repo_month_counts(pushes: DataFrame, meta: DataFrame, buckets=TASK_BUCKETS, default=DEFAULT_TASK,
                      keys=("repo_name",), by=(), prune: bool = False, **rules) -> DataFrame:
    """The counts of each repository, month (`yyyymm`) and language, without building enriched rows.

    Pushes only bring a key and a month, metadata only a language and flags, so each pair of
    joined rows counts `pushes x metadata rows`: both sides are added up before they meet and
    no repository's pairs are ever written out. What is shuffled is one row per key and month;
    message texts never are. How to join is left to the sizes that Spark measures.

    keys   `repo_name`, or with `head_sha` for the exact match.
    by     columns of the pushes to count by as well.
    prune  drop pushes without metadata where they are read, so that only the others are shuffled; for
           metadata of few of the repositories.
    """
    weights = metadata_weights(meta, buckets, default, keys, **rules)
    counts = [c for c in _count_columns(buckets, default) if c != "unique_repos"]
    at = F.col("created_at")
    if prune:
        pushes = matching_rows(pushes, weights, keys)
    # Year and month as one key; both parts can be cut out of it again without loss.
    months = pushes.dropna(subset=list(keys)).select(
        *keys, *by, F.concat(year_of(at), month_of(at)).alias("yyyymm")
    )
    pushed = months.groupBy(*keys, *by, "yyyymm").agg(F.count(F.lit(1)).alias("pushes"))
    joined = pushed.join(weights, list(keys)).select(
        "repo_name", *by, "yyyymm", "primary_language", *((F.col("pushes") * F.col(c)).alias(c) for c in counts)
    )
    if len(keys) > 1:
        joined = joined.groupBy("repo_name", *by, "yyyymm", "primary_language").agg(
            *(F.sum(c).alias(c) for c in counts))
    return joined


def _in_summary_form(summed: DataFrame, buckets, default) -> DataFrame:
    return summed.select(
        F.substring("yyyymm", 1, 4).alias("year"), F.substring("yyyymm", 5, 2).alias("month"),
        "primary_language", *_count_columns(buckets, default),
    )


def summary_from_parts(pushes: DataFrame, meta: DataFrame, buckets=TASK_BUCKETS, default=DEFAULT_TASK,
                       keys=("repo_name",), prune: bool = False, **rules) -> DataFrame:
    """The same summary from counts by repository."""
    joined = repo_month_counts(pushes, meta, buckets, default, keys, prune=prune, **rules)
    # One row per month, language and repository: counting rows counts repositories.
    summed = joined.groupBy("yyyymm", "primary_language").agg(
        F.count(F.lit(1)).alias("unique_repos"),
        *(F.sum(c).alias(c) for c in _count_columns(buckets, default) if c != "unique_repos"),
    )
    return _in_summary_form(summed, buckets, default)


def mergeable_summary(counts: DataFrame, ids: DataFrame, buckets=TASK_BUCKETS, default=DEFAULT_TASK,
                      by=()) -> DataFrame:
    """Counts by repository to a summary that can be merged with others: the repositories of a month
    and language as bitmaps over their numbers (`ids`: name, id), 32,768 to a row."""
    sums = [c for c in _count_columns(buckets, default) if c != "unique_repos"]
    numbered = counts.join(ids.withColumnRenamed("name", "repo_name"), "repo_name")
    return numbered.groupBy(*by, "yyyymm", "primary_language", F.bitmap_bucket_number("id").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("repos"), *(F.sum(c).alias(c) for c in sums))


def merged_summary(parts: DataFrame, buckets=TASK_BUCKETS, default=DEFAULT_TASK) -> DataFrame:
    """Mergeable summaries of any number of increments to the summary. Bitmaps are united before they
    are counted, so a repository that several increments hold counts once."""
    sums = [c for c in _count_columns(buckets, default) if c != "unique_repos"]
    united = parts.groupBy("yyyymm", "primary_language", "block").agg(
        F.bitmap_count(F.bitmap_or_agg("repos")).alias("unique_repos"), *(F.sum(c).alias(c) for c in sums))
    summed = united.groupBy("yyyymm", "primary_language").agg(
        *(F.sum(c).alias(c) for c in _count_columns(buckets, default)))
    return _in_summary_form(summed, buckets, default)


def distinct_bitmaps(rows: DataFrame, ids: DataFrame, col: str, *keys) -> DataFrame:
    """The values of a column, by key, as bitmaps over their numbers (`ids`: name, id)."""
    named = ids.withColumnRenamed("name", col)
    return rows.select(*keys, col).distinct().join(named, col).groupBy(
        *keys, F.bitmap_bucket_number("id").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("members"))


def distinct_count_of_bitmaps(bitmaps: DataFrame, *keys, name: str = "unique_repos") -> DataFrame:
    """How many different values the bitmaps of any number of increments hold, by key."""
    united = bitmaps.groupBy(*keys, "block").agg(F.bitmap_count(F.bitmap_or_agg("members")).alias("n"))
    return united.groupBy(*keys).agg(F.sum("n").alias(name))
