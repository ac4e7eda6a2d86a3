"""Column-level building blocks: Column in, Column out, all on Spark built-ins."""

from .dates import (  # noqa: F401
    file_month_key, month_of, month_start, snapshot_file_name, year_of,
)
from .text import (  # noqa: F401
    ai_flag, compose_text, contains_any, first_match_bucket, matches_any, percent_label,
)
from .values import blank_to, is_known, present, share_of  # noqa: F401
