"""Keyword tests, ordered classification and labels."""

import re

from pyspark.sql import Column, functions as F

from ..schemas import COMMIT_TERMS, DEFAULT_TASK, EMAIL_TERMS, PR_TERMS, TASK_BUCKETS


def compose_text(*cols) -> Column:
    """Non-null parts joined by one space, lower-cased."""
    return F.lower(F.concat_ws(" ", *cols))


def matches_any(text: Column, terms=PR_TERMS) -> Column:
    """Unanchored search for any of the terms, in any case; `text` must already be lower-case.

    One alternation reads the text once; a chain of `contains` would be pushed into the
    filter with its own copy of the composed text per term. The look-ahead changes no match:
    it lets the search skip every character that no term starts with.
    """
    if not all(terms):
        raise ValueError("an empty term would match every text")
    if not terms:
        return F.lit(False)
    terms = [t.lower() for t in terms]
    starts = "".join(sorted({re.escape(t[0]) for t in terms}))
    words = "|".join(re.escape(t) for t in terms)
    return text.rlike(f"(?=[{starts}])(?:{words})")


def contains_any(col: Column, terms) -> Column:
    """Case-insensitive substring test for any term; NULL in, NULL out."""
    return matches_any(F.lower(col), terms)


def ai_flag(message: Column, email: Column, terms=COMMIT_TERMS, email_terms=EMAIL_TERMS) -> Column:
    """1 when the message or the author address names an assistant, else 0.

    SQL three-valued OR: a NULL message with a matching address still gives 1.
    """
    hit = contains_any(message, terms) | contains_any(email, email_terms)
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


def first_match_bucket(message: Column, buckets=TASK_BUCKETS, default=DEFAULT_TASK) -> Column:
    """Label of the first bucket with a term in the message; `default` if none (or NULL)."""
    (label, terms), *rest = buckets
    chain = F.when(contains_any(message, terms), F.lit(label))
    for label, terms in rest:
        chain = chain.when(contains_any(message, terms), F.lit(label))
    return chain.otherwise(F.lit(default))


def percent_label(name: Column, share: Column) -> Column:
    """`name (12.3%)`, the share rounded half-even on its exact binary value.

    `format_string('%.1f')` would round half-up on the shortest decimal form instead.
    """
    return F.concat(name, F.lit(" ("), F.format_number(share, 1), F.lit("%)"))
