"""Scans of stored layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A layer by path. The schema also types the partition columns, so a state
    `01` stays text."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def newer_than(source: DataFrame, target: DataFrame, ts: str, keys: Sequence[str]) -> DataFrame:
    """Rows of `source` that `target` does not have yet; all of them if it is empty.

    Rows stamped after everything in `target` are new. Rows stamped with its last
    stamp, and rows without a stamp, may have come later than their like: they are new
    unless `target` has a row of the same stamp and `keys`. The mark is one value that
    Spark works out first and hands to both scans, so only target rows at the mark or
    without a stamp are joined.
    """
    mark = target.agg(F.max(ts)).scalar()
    open_ = source.filter(mark.isNull() | (F.col(ts) >= mark) | F.col(ts).isNull())
    known = target.filter((F.col(ts) >= mark) | F.col(ts).isNull())
    known = known.select(*[F.col(c).alias(f"_known_{c}") for c in (ts, *keys)])
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in (ts, *keys)]
    return open_.join(known, same, "left_anti")
