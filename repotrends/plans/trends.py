"""The four result tables over the monthly summary and the repository list."""

from pyspark.sql import DataFrame

from ..operators import (
    activity_vs_adoption, growth_index, keep_top, mix_with_rest, month_share, monthly_volume,
    target_rows, top_categories,
)
from ..schemas import TARGET_LANGUAGES, TOP_LANGUAGES
from ..sources import require_rows


def language_shares(summary: DataFrame, targets=TARGET_LANGUAGES) -> DataFrame:
    """Monthly volume and share of every target language; the total counts those only."""
    return month_share(monthly_volume(target_rows(summary, targets)))


def language_share_trend(summary: DataFrame, targets=TARGET_LANGUAGES,
                         top: int = TOP_LANGUAGES) -> DataFrame:
    """Monthly shares of the largest target languages.

    Shares and top list start from the same monthly volume, so Spark computes it once and
    reuses its exchange.
    """
    monthly = monthly_volume(target_rows(summary, targets))
    return keep_top(month_share(monthly), top_categories(monthly, top), top)


def language_growth_index(summary: DataFrame, targets=TARGET_LANGUAGES,
                          top: int = TOP_LANGUAGES) -> DataFrame:
    """Shares of the largest languages against their first month (= 100)."""
    trend = language_share_trend(summary, targets, top)
    return growth_index(trend).select("date", "primary_language", "share", "growth_index")


def ai_language_mix(ai_repos: DataFrame, top: int = TOP_LANGUAGES) -> DataFrame:
    """Pull requests by language, the largest ones and the rest."""
    return mix_with_rest(ai_repos, top)


def activity_comparison(summary: DataFrame, ai_repos: DataFrame, targets=TARGET_LANGUAGES) -> DataFrame:
    """Commits beside matching pull requests, per target language."""
    return activity_vs_adoption(target_rows(summary, targets), ai_repos)


def run_trends(summary: DataFrame, ai_repos: DataFrame) -> dict[str, DataFrame]:
    """All four tables. Pass stored inputs: each table reads them anew."""
    require_rows(summary, "monthly summary")
    return {
        "language_share_trend": language_share_trend(summary).orderBy("date", "primary_language"),
        "ai_language_mix": ai_language_mix(ai_repos),
        "activity_vs_adoption": activity_comparison(summary, ai_repos),
        "growth_index": language_growth_index(summary).orderBy("primary_language", "date"),
    }
