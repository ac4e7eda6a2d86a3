"""Defaults and guards for missing values."""

from pyspark.sql import Column, functions as F

from ..schemas import UNKNOWN_LANGUAGE


def blank_to(col: Column, default: str) -> Column:
    """NULL or empty string becomes `default`."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def is_known(col: Column, unknown: str = UNKNOWN_LANGUAGE) -> Column:
    """False for NULL, empty and the unknown marker alike."""
    return col.isNotNull() & (col != F.lit(unknown)) & (col != F.lit(""))


def present(*cols) -> Column:
    """True when every column is neither NULL nor empty."""
    test = F.lit(True)
    for c in cols:
        test = test & c.isNotNull() & (c != F.lit(""))
    return test


def share_of(part: Column, whole: Column) -> Column:
    """`part / whole * 100` in that order; NULL when the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100)
