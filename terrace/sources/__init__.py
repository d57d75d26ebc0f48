"""Readers of pages, mapped JSON and stored layers."""

from terrace.sources.json_map import COPY_MAPPING, map_json, mapping_schema, read_mapped_json
from terrace.sources.json_rows import map_json_rows, read_json_rows
from terrace.sources.layers import newer_than, read_layer
from terrace.sources.pages import keep_page_prefix, list_page_files, list_pages, page_boundary, read_page_files, read_pages, stream_pages, write_pages
from terrace.sources.widened import common_schema, common_type, read_runs, run_schemas, schema_drift, to_schema

__all__ = [
    "COPY_MAPPING",
    "common_schema",
    "common_type",
    "keep_page_prefix",
    "list_page_files",
    "list_pages",
    "map_json",
    "map_json_rows",
    "mapping_schema",
    "newer_than",
    "page_boundary",
    "read_json_rows",
    "read_layer",
    "read_mapped_json",
    "read_page_files",
    "read_pages",
    "read_runs",
    "run_schemas",
    "schema_drift",
    "stream_pages",
    "to_schema",
    "write_pages",
]
