"""What changed between two states of a keyed table, and the history of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_digest(columns: Sequence[str]) -> Column:
    """128 bits of the row's values; a NULL is told from other values by its place."""
    values = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(1), *values).alias("b"))


def _null_safe(left: str, right: str, keys: Sequence[str]) -> list[Column]:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def row_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key whose row was `inserted`, `updated` or `deleted`: the keys, `change`, the
    names of the columns that `changed`, and the row `before` and `after` as structs.

    `columns` (all but the keys, unless given) are compared; others, such as load stamps, do not
    count. Keys must be unique on either side; NULL is a key. Keys and digests of all rows are
    compared first, and only rows that differ are then fetched whole.
    """
    columns = list(columns if columns is not None else [c for c in before.columns if c not in keys])
    old, new = (df.select(*keys, row_digest(columns).alias("digest")) for df in (before, after))
    met = old.alias("o").join(new.alias("n"), _null_safe("o", "n", keys), "full_outer")
    differs = ~F.col("o.digest").eqNullSafe(F.col("n.digest"))
    changed = met.filter(differs).select(*[F.when(F.col("n.digest").isNull(), F.col(f"o.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in keys])
    rows = [df.select(*keys, F.struct(*columns).alias(side)) for df, side in ((before, "before"), (after, "after"))]
    out = changed.alias("k")
    for part, side in zip(rows, ("before", "after")):
        out = out.join(part.alias(side[0]), _null_safe("k", side[0], keys), "left")
    out = out.select(*[F.col(f"k.{k}").alias(k) for k in keys], F.col("b.before").alias("before"), F.col("a.after").alias("after"))
    names = [F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.lit(c)) for c in columns]
    change = F.when(F.col("before").isNull(), "inserted").when(F.col("after").isNull(), "deleted").otherwise("updated")
    return out.select(*keys, change.alias("change"), F.array_compact(F.array(*names)).alias("changed"), "before", "after")


def row_history(
    versions: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    run: str,
    gone: str,
    recency: Sequence[str] = (),
) -> DataFrame:
    """Each state of a key with the runs from which (`valid_from`) and up to which (`valid_to`,
    exclusive, NULL while it holds) it is the key's row.

    `versions` has the rows that each `run` (a number) brought, at most one a key and run. A
    version counts from its run on if no earlier run brought a newer one by `recency`; a `gone`
    version ends the key. Runs that bring the same `columns` again do not start a new state. A
    key's versions, at most one a run, are one window group.
    """
    by_run = Window.partitionBy(*keys).orderBy(run)
    upto = by_run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    order = F.struct(*recency, run)
    current = versions.withColumn("_newest", F.max(order).over(upto)).filter(F.col("_newest") == order)
    state = F.struct(F.col(gone).alias("gone"), F.when(~F.col(gone), row_digest(columns)).alias("digest"))
    stated = current.withColumn("_state", state).withColumn("_before", F.lag("_state").over(by_run))
    starts = stated.filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_state")))
    ended = starts.withColumn("valid_to", F.lead(run).over(by_run)).filter(~F.col(gone))
    return ended.select(*keys, *[c for c in columns if c not in keys], F.col(run).alias("valid_from"), "valid_to")


def rows_as_of(history: DataFrame, run: int) -> DataFrame:
    """The rows that were valid after a run."""
    holds = (F.col("valid_from") <= run) & (F.col("valid_to").isNull() | (F.col("valid_to") > run))
    return history.filter(holds).drop("valid_from", "valid_to")
