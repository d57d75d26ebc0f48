"""Group aggregates of the gold layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_count(df: DataFrame, dims: Sequence[str], key: str, out: str = "entity_count") -> DataFrame:
    """Rows with a non-NULL `key` per combination of `dims`."""
    return df.groupBy(*dims).agg(F.count(key).alias(out))


def signed_changes(before: DataFrame, after: DataFrame, dims: Sequence[str], out: str = "entity_count") -> DataFrame:
    """Change of the row count per combination of `dims` between two states of the same rows:
    rows that left count -1, rows that entered +1. Groups that did not change are left out."""
    left = before.select(*dims, F.lit(-1).cast("long").alias(out))
    entered = after.select(*dims, F.lit(1).cast("long").alias(out))
    return left.unionByName(entered).groupBy(*dims).agg(F.sum(out).alias(out)).filter(F.col(out) != 0)


def sum_by(df: DataFrame, dims: Sequence[str], measure: str, out: str) -> DataFrame:
    return df.groupBy(*dims).agg(F.sum(measure).alias(out))
