"""DataFrame in, DataFrame out. None uses a Python UDF; only the checks run a job."""

from .checks import duplicate_keys, require_unique, row_counts  # noqa: F401
from .coverage import (  # noqa: F401
    calendar_span, files_per_month, missing_snapshots, snapshot_calendar, span_of,
)
from .enrich import (  # noqa: F401
    attach_dominant, attach_metadata, dominant_category, language_rows, matching_rows, metadata_side,
    one_row_per_key,
)
from .events import (  # noqa: F401
    ai_pull_requests, count_by, first_event, id_order, parse_pull_request_lines, preview_messages,
    pull_request_events, push_events,
)
from .sampling import (  # noqa: F401
    distinct_count, distinct_rows, latest_per_key, metadata_targets, push_heads, seeded_sample,
    top_n_per_group, top_rows,
)
from .summary import (  # noqa: F401
    classify, distinct_bitmaps, distinct_count_of_bitmaps, merged_summary, mergeable_summary,
    monthly_language_summary, repo_month_counts, summary_from_parts,
)
from .trends import (  # noqa: F401
    activity_vs_adoption, category_volume, growth_index, keep_top, mix_with_rest, month_share,
    monthly_volume, pivot_series, target_rows, top_categories, unpivot_series,
)
