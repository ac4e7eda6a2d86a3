"""Readers and writers: event logs, metadata, interchange files, stage tables, JDBC."""

from .buckets import BucketedTable  # noqa: F401
from .monthly import MonthlyTable, extend_dictionary  # noqa: F401
from .readers import (  # noqa: F401
    MissingInputError, NO_MONTH, file_stamps, input_report, list_files, read_ai_repos, read_enriched_tsv,
    read_event_lines, read_events, read_events_and_rest, read_jdbc_table, read_language_bytes, read_metadata, read_pull_request_events, require_rows,
)
from .scratch import scratch_path  # noqa: F401
from .writers import (  # noqa: F401
    append_missing_months, drop_blank_lines, months_held, stage_is_complete, store_events, write_bounded_tsv,
    write_counted, write_csv, write_jdbc_table, write_once, write_plain_tsv, write_tsv,
)
