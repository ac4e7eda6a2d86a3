"""Months cut from ISO timestamps and from snapshot file names."""

from pyspark.sql import Column, functions as F

from ..schemas import FILE_MONTH_PATTERN


def year_of(created_at: Column) -> Column:
    return F.substring(created_at, 1, 4)


def month_of(created_at: Column) -> Column:
    return F.substring(created_at, 6, 2)


def month_start(year: Column, month: Column) -> Column:
    """First day of the month; NULL when the parts make no date."""
    text = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lit("01"))
    return F.try_to_date(text, "yyyy-MM-dd")


def file_month_key(file_name: Column, pattern: str = FILE_MONTH_PATTERN) -> Column:
    """`2026-04-02-15.json.gz` -> `2604`; NULL for names that carry no month."""
    key = F.concat(
        F.substring(F.regexp_extract(file_name, pattern, 1), 3, 2),
        F.regexp_extract(file_name, pattern, 2),
    )
    return F.nullif(key, F.lit(""))


def snapshot_file_name(day: Column, hour: int = 15) -> Column:
    """Name of the hourly file that holds this day's snapshot."""
    return F.concat(day.cast("date").cast("string"), F.lit(f"-{hour}.json.gz"))
