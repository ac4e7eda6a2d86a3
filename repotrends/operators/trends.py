"""Shares, top lists, growth index and comparisons over the monthly summary."""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import month_start, percent_label, share_of
from ..schemas import REST_LABEL, TARGET_LANGUAGES, TOP_LANGUAGES


def target_rows(df: DataFrame, targets=TARGET_LANGUAGES, col: str = "primary_language") -> DataFrame:
    return df.filter(F.col(col).isin(*targets))


def monthly_volume(summary: DataFrame, col: str = "primary_language",
                   value: str = "total_commits") -> DataFrame:
    """Total per month start and category; rows without a valid month are left out.

    They are told by a count of dates in the group. A test on the date itself would be
    pushed below the summary's own grouping and parse a date for every push.
    """
    date = month_start(F.col("year"), F.col("month"))
    totals = summary.withColumn("date", date).groupBy("date", col).agg(
        F.sum(value).alias(value), F.count("date").alias("dated")
    )
    return totals.filter(F.col("dated") > 0).drop("dated")


def month_share(monthly: DataFrame, value: str = "total_commits") -> DataFrame:
    """Add the month's total and each row's share of it in percent.

    One window, no join back. Its groups hold one row per category and month, which the
    allow-list of `target_rows` bounds.
    """
    total = F.sum(value).over(Window.partitionBy("date"))
    return monthly.withColumn("month_total", total).withColumn(
        "share", share_of(F.col(value), F.col("month_total"))
    )


def category_volume(df: DataFrame, col: str = "primary_language",
                    value: str = "total_commits") -> DataFrame:
    """Total per category, NULL categories left out."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.sum(value).alias(value))


def top_categories(df: DataFrame, n: int = TOP_LANGUAGES, col: str = "primary_language",
                   value: str = "total_commits") -> DataFrame:
    """The n largest categories, ties by name."""
    return category_volume(df, col, value).orderBy(F.desc(value), col).limit(n)


def keep_top(df: DataFrame, top: DataFrame, n: int = TOP_LANGUAGES,
             col: str = "primary_language") -> DataFrame:
    """Rows of the categories in `top`, a list cut to n rows by `top_categories`."""
    return df.join(top.select(col), col, "left_semi").select(*df.columns)


def growth_index(shares: DataFrame, col: str = "primary_language", share: str = "share") -> DataFrame:
    """Each share as percent of the category's first known share (first month = 100).

    Groups hold one row per month of one category.
    """
    whole = Window.partitionBy(col).orderBy("date").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    base = F.first(share, ignorenulls=True).over(whole)
    return shares.withColumn("base_share", base).withColumn(
        "growth_index", share_of(F.col(share), F.col("base_share"))
    ).filter(F.col("growth_index").isNotNull())


def pivot_series(series: DataFrame, categories, value: str = "share",
                 col: str = "primary_language") -> DataFrame:
    """Month x category matrix over the given categories, NULL where a month has none."""
    wide = series.groupBy("date").pivot(col, list(categories)).agg(F.first(value))
    return wide.dropna(how="all", subset=list(categories))


def unpivot_series(matrix: DataFrame, categories, value: str = "share",
                   col: str = "primary_language") -> DataFrame:
    """Matrix back to one row per month and category, empty cells dropped."""
    return matrix.unpivot("date", list(categories), col, value).filter(F.col(value).isNotNull())


def mix_with_rest(df: DataFrame, n: int = TOP_LANGUAGES, col: str = "primary_language",
                  value: str = "ai_pr_count", rest: str = REST_LABEL) -> DataFrame:
    """The n largest categories plus one row for all others, with shares and labels.

    The remainder keeps its own group even if a category bears its name, and there is no
    such row when nothing remains. From the regroup on there are at most n + 1 rows, so the
    window over all of them is a single small task.
    """
    volume = category_volume(df, col, value).filter(F.col(value) > 0)
    top = volume.orderBy(F.desc(value), col).limit(n)
    tagged = volume.join(top.select(col, F.lit(False).alias("is_rest")), col, "left")
    is_rest = F.coalesce("is_rest", F.lit(True))
    parts = tagged.groupBy(
        is_rest.alias("is_rest"), F.when(is_rest, F.lit(rest)).otherwise(F.col(col)).alias(col)
    ).agg(F.sum(value).alias(value))
    total = F.sum(value).over(Window.partitionBy())
    return parts.withColumn("share", share_of(F.col(value), total)).withColumn(
        "label", percent_label(F.col(col), F.col("share"))
    ).orderBy("is_rest", F.desc(value), col).select(col, value, "share", "label")


def activity_vs_adoption(summary: DataFrame, ai_repos: DataFrame, col: str = "primary_language",
                         activity: str = "total_commits", adoption: str = "ai_pr_count") -> DataFrame:
    """Categories seen on both sides with positive totals: activity beside adoption."""
    return category_volume(summary, col, activity).join(
        category_volume(ai_repos, col, adoption), col
    ).filter((F.col(activity) > 0) & (F.col(adoption) > 0))
