"""The jobs a user calls, put together from the operators."""

from .activity import enriched_pushes, metadata_lookup_list, monthly_summary, run_activity, stored_enriched  # noqa: F401
from .coverage import folder_coverage, snapshot_coverage  # noqa: F401
from .pull_requests import ai_pr_repos, ai_repos_with_language, run_pull_requests  # noqa: F401
from .trends import (  # noqa: F401
    activity_comparison, ai_language_mix, language_growth_index, language_shares,
    language_share_trend, run_trends,
)
