"""Parquet layers, catalog tables and bucketed merges."""

from terrace.sinks.buckets import BucketLayer, Merge, StaleBaseError
from terrace.sinks.layers import compact, create_namespaces, publish_table, quoted, write_layer
from terrace.sinks.zorder import zorder

__all__ = [
    "BucketLayer",
    "Merge",
    "StaleBaseError",
    "compact",
    "create_namespaces",
    "publish_table",
    "quoted",
    "write_layer",
    "zorder",
]
