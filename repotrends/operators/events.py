"""From raw log rows to push and pull-request tables, and counts over them."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import compose_text, matches_any
from ..schemas import PR_TERMS, PULL_REQUEST_EVENT, PULL_REQUEST_LINE, PUSH_EVENT


def push_events(events: DataFrame, *extra: Column, event_type: str = PUSH_EVENT) -> DataFrame:
    """Push rows, flattened, plus any extra columns. The type test and the nested columns
    both reach the scan."""
    return events.filter(F.col("type") == F.lit(event_type)).select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("repo.name").alias("repo_name"),
        F.col("payload.head").alias("head_sha"),
        F.col("created_at"),
        *extra,
    )


def _may_hold(line: Column, word: str) -> Column:
    """Cheap byte search before the JSON parse. A name spelled with \\u escapes would hide
    from a plain search, so lines with such an escape go on to the parser as well."""
    return F.contains(line, F.lit(word)) | F.contains(line, F.lit("\\u"))


def parse_pull_request_lines(lines: DataFrame, event_type: str = PULL_REQUEST_EVENT) -> DataFrame:
    """Raw text lines to the fields that `pull_request_events` reads.

    A line that can match is parsed once, into five fields. `inline` holds that parse in
    place: as a plain column it would be repeated in the filter on the type.
    """
    return lines.filter(_may_hold(F.col("value"), event_type)).select(
        F.inline(F.array(F.from_json("value", PULL_REQUEST_LINE)))
    )


def pull_request_events(events: DataFrame, event_type: str = PULL_REQUEST_EVENT) -> DataFrame:
    """Pull-request rows, flattened; missing texts become empty."""
    text = {
        "title": "payload.pull_request.title",
        "body": "payload.pull_request.body",
        "head_ref": "payload.pull_request.head.ref",
    }
    return events.filter(F.col("type") == F.lit(event_type)).select(
        F.col("repo.name").alias("repo_name"),
        *(F.coalesce(F.col(path), F.lit("")).alias(name) for name, path in text.items()),
    )


def ai_pull_requests(prs: DataFrame, terms=PR_TERMS) -> DataFrame:
    """Pull requests whose title, body or branch name holds any of the terms."""
    return prs.filter(matches_any(compose_text("title", "body", "head_ref"), terms))


def count_by(df: DataFrame, key: str = "repo_name", name: str = "ai_pr_count") -> DataFrame:
    """Rows per key, NULL keys left out; partial counts absorb a hot key before the shuffle."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def id_order(col: str) -> list[Column]:
    """Numeric ids in their order, also if they are held as text: the shorter first."""
    return [F.length(F.col(col).cast("string")), F.col(col)]


def first_event(events: DataFrame, event_type: str, type_col: str = "type", order=None) -> DataFrame:
    """The first event of a type in the given order, by default that of `id`."""
    return events.filter(F.col(type_col) == F.lit(event_type)).orderBy(*(order or id_order("id"))).limit(1)


def preview_messages(enriched: DataFrame, n: int = 5, order=None) -> DataFrame:
    """The first rows that carry a commit message, by default in the order of `event_id`."""
    return enriched.filter(F.col("commit_message").isNotNull()).orderBy(*(order or id_order("event_id"))).limit(n)
