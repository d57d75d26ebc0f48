"""Duplicate report, deterministic dedupe and keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(
    df: DataFrame, keys: Sequence[str], recency: Sequence[str], tie_break: Sequence[str] | None
) -> list[Column]:
    """Descending order that picks the survivor of a key.

    With `tie_break=None` all remaining columns follow `recency`, so that the
    survivor depends on the rows alone and never on how they were partitioned. Pass
    `()` where `recency` is already unique within a key.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in recency]
    return [F.col(c).desc() for c in [*recency, *tie_break]]


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their counts. NULL is one key."""
    return df.groupBy(*keys).agg(F.count("*").alias(out)).filter(F.col(out) > 1)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str] = (),
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key; NULL keys count as one key.

    `row_number() = 1` is planned with a WindowGroupLimit on both sides of the
    shuffle: every map task sends at most one row per key, so a key that holds a
    large part of the input adds one row per task and no more.
    """
    order = newest_first(df, keys, recency, tie_break) or [F.lit(0).asc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def upsert(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str] = (),
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key over both sides; a row of `new` wins a tie in `recency`.

    A record that is delivered late so never replaces a newer one. Without `recency` the
    rows of `new` replace those of `old`. A NULL key counts as one key; drop such rows
    first. The whole of `old` is shuffled: see `merge_buckets` for a stored layer of which
    only the touched part is rewritten.
    """
    columns = old.columns
    both = old.withColumn("_new", F.lit(0)).unionByName(new.select(*columns).withColumn("_new", F.lit(1)))
    if tie_break is None:
        tie_break = [c for c in columns if c not in keys and c not in recency]
    return latest_per_key(both, keys, [*recency, "_new"], tie_break).select(*columns)
