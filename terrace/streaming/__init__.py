"""Incremental landing of page files, and a stream merged into a keyed layer."""

from terrace.streaming.landing import land_new_pages
from terrace.streaming.upsert import newest_of_stream, recency_columns, stream_upserts

__all__ = ["land_new_pages", "newest_of_stream", "recency_columns", "stream_upserts"]
