"""Push activity: event files and metadata in, enriched pushes and monthly summary out."""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import file_month_key
from ..operators import (
    attach_metadata, mergeable_summary, merged_summary, metadata_side, metadata_targets, one_row_per_key,
    push_events, push_heads, repo_month_counts, summary_from_parts,
)
from ..schemas import ENRICHED_BY_MONTH, PUSHES_BY_MONTH, SAMPLE_PER_MONTH, SUMMARY_PARTS
from ..sources import (
    NO_MONTH, BucketedTable, MonthlyTable, append_missing_months, extend_dictionary, file_stamps, list_files, read_events,
    read_metadata, require_rows, write_once,
)


def enriched_pushes(spark: SparkSession, log_path, meta_path, **options) -> DataFrame:
    """Every push of the log with its repository's metadata."""
    return attach_metadata(
        push_events(read_events(spark, log_path)), read_metadata(spark, meta_path), **options
    )


def monthly_summary(pushes: DataFrame, meta: DataFrame, match: str = "repo", dedupe: bool = False,
                    **rules) -> DataFrame:
    """Monthly language summary, counted on both sides before they are joined."""
    keys, meta = _matching(meta, match, dedupe)
    return summary_from_parts(pushes, meta, keys=keys, **rules)


def _matching(meta: DataFrame, match: str, dedupe: bool):
    """The keys of a match, and the metadata rows for it."""
    keys = ("repo_name", "head_sha") if match == "head" else ("repo_name",)
    if dedupe:
        meta = one_row_per_key(meta if match == "head" else meta.drop("head_sha"), list(keys))
    return keys, meta


def stored_enriched(spark: SparkSession, out: str) -> DataFrame:
    """The enriched pushes that `run_activity` keeps under `out`."""
    return MonthlyTable(spark, f"{out}/enriched", ENRICHED_BY_MONTH).read().drop("yymm")


def run_activity(spark: SparkSession, log_path, meta_path, out: str, match: str = "repo",
                 dedupe: bool = False, skew: str = "adaptive", keep_enriched: bool = True,
                 buckets: int | None = None) -> DataFrame:
    """Store pushes, enriched pushes and summary under `out`; return the summary in order.

    The log is parsed once, into Parquet by month of its files: gzip text gives one task per file and no
    column pruning, Parquet gives both to every later stage. Every table is kept by that month, each with
    a record of what it was made from. A listing of the files (path, length, time) tells which months have
    new, changed or missing files: only their files are opened, and only their months are made
    anew. A month's part of the summary holds its repositories as bitmaps over their numbers in a
    dictionary, so parts are merged without going back to rows, and distinct counts stay exact where
    two months' files hold pushes of the same day. Other metadata files or options make all
    months' enriched pushes and parts anew, for a repository's metadata belongs to its pushes of any month.
    No input is an error, and nothing is stored.

    buckets  lay the pushes by the keys of the match, in so many buckets, when they land. Each month's pushes
             are shuffled then, once; later joins with new metadata shuffle the metadata only. `skew` is
             not asked then, for hot repositories lie in several buckets.
    """
    listed = list_files(spark, log_path)
    log = require_rows(read_events(spark, log_path, with_file=True), "the event log")
    stamps = {r["yymm"]: r["stamp"] for r in file_stamps(listed).collect()}
    month = F.coalesce(file_month_key(F.col("file_name")), F.lit(NO_MONTH))

    if buckets:
        keys = ("repo_name", "head_sha") if match == "head" else ("repo_name",)
        pushes = BucketedTable(spark, f"{out}/pushes-{match}-{buckets}", PUSHES_BY_MONTH, keys, buckets)
    else:
        pushes = MonthlyTable(spark, f"{out}/pushes", PUSHES_BY_MONTH)
    new, gone = pushes.stale(stamps)
    if new or gone:
        pushes.write(push_events(log.filter(month.isin(*new)), month.alias("yymm")), new, gone)

    meta = read_metadata(spark, meta_path)
    known = sorted(r["stamp"] for r in file_stamps(list_files(spark, meta_path)).collect()) if meta.inputFiles() else []
    made_from = {m: json.dumps([r["attempt"], known, match, dedupe]) for m, r in pushes.records().items()}

    enriched = MonthlyTable(spark, f"{out}/enriched", ENRICHED_BY_MONTH)
    new, gone = enriched.stale(made_from)
    if keep_enriched and (new or gone):
        if buckets:
            _, side = metadata_side(meta, match, dedupe)
            joined = pushes.join(side, months=new).select(*ENRICHED_BY_MONTH.fieldNames())
        else:
            joined = attach_metadata(pushes.read(new), meta, match, dedupe, skew, keep=("yymm",))
        enriched.write(joined, new, gone)

    parts = MonthlyTable(spark, f"{out}/parts", SUMMARY_PARTS)
    new, gone = parts.stale(made_from)
    if new or gone:
        rows = pushes.read(new)
        ids = extend_dictionary(rows.select("repo_name"), f"{out}/repositories")
        keys, weights = _matching(meta, match, dedupe)
        # Metadata is a sample: most repositories have none, and their pushes aren't shuffled.
        counts = repo_month_counts(rows, weights, keys=keys, by=("yymm",), prune=True)
        parts.write(mergeable_summary(counts, ids, by=("yymm",)), new, gone)
    held = sorted((m, r["attempt"]) for m, r in parts.records().items())
    summary = write_once(merged_summary(parts.read()), f"{out}/summary", made_from=held)
    return summary.orderBy("year", "month", F.desc("ai_commits"), "primary_language")


def metadata_lookup_list(spark: SparkSession, log_path, out: str, n: int = SAMPLE_PER_MONTH,
                         seed: str = "0") -> DataFrame:
    """Repositories to look up, one sample per month; months already listed are kept."""
    heads = push_heads(read_events(spark, log_path, with_file=True))
    return append_missing_months(metadata_targets(heads, n, seed), out)
