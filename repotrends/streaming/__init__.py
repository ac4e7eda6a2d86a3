"""Incremental landing of new event files."""

from .landing import land_new_files, pull_request_stream, push_stream  # noqa: F401
