"""Load reconciliation, quality totals and the gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import POSTAL_US, any_present, bad_postal
from terrace.operators.dedupe import latest_per_key
from terrace.schemas import CONTACT_FIELDS

# Only bad postal codes stop a load by default. Duplicates and rows without contact
# are resolved by the load itself; a caller may limit them too.
DEFAULT_LIMITS = {"bad_postal": 0}


class QualityGateError(RuntimeError):
    """The load breaks a limit; nothing of it was written."""

    def __init__(self, metrics: Mapping[str, int], limits: Mapping[str, int]):
        self.metrics = dict(metrics)
        broken = ", ".join(f"{k}={metrics[k]} (limit {v})" for k, v in limits.items() if metrics[k] > v)
        super().__init__(f"quality gate failed: {broken}")


def reconcile_rule(df: DataFrame, keep: Column) -> DataFrame:
    """One row: how many rows a filter keeps and drops, in one pass and without it."""
    kept = F.count_if(keep)
    return df.agg(F.count("*").alias("total"), kept.alias("kept"), (F.count("*") - kept).alias("dropped"))


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: total, kept and dropped row counts of a step between two stored frames.
    A frame that is not stored would be computed twice; see `reconcile_rule`."""
    total = before.agg(F.count("*").alias("total"), F.lit(0).cast("long").alias("kept"))
    kept = after.agg(F.lit(0).cast("long").alias("total"), F.count("*").alias("kept"))
    return (
        total.unionByName(kept)
        .agg(F.sum("total").alias("total"), F.sum("kept").alias("kept"))
        .withColumn("dropped", F.col("total") - F.col("kept"))
    )


def reconcile_keys(df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: what deduping `df` by `keys` will keep and drop, without doing it.

    `counts` names extra row predicates to count. Only the key columns and the
    counters are shuffled, after a partial count on the map side.
    """
    counts = counts or {}
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("_copies"), *[F.count_if(c).alias(n) for n, c in counts.items()]
    )
    return per_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total"),
        F.count("*").alias("kept"),
        F.count_if(F.col("_copies") > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
    ).select(
        "total", "kept", (F.col("total") - F.col("kept")).alias("dropped"), "duplicate_keys", *counts
    )


def entity_rules(
    patterns: Mapping[str, str] = POSTAL_US,
    contacts: Sequence[str] = CONTACT_FIELDS,
    country: str = "country",
    postal: str = "postal_code",
) -> dict[str, Column]:
    """Row predicates of the silver checks, on rows with lower-cased country."""
    return {
        "bad_postal": bad_postal(patterns, country, postal),
        "no_contact": ~any_present(contacts),
        "postal_missing": F.col(postal).isNull(),
    }


def quality_metrics(
    df: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Column],
    recency: Sequence[str] = (),
    tie_break: Sequence[str] | None = (),
) -> DataFrame:
    """One row of totals, measured before anything is deduped or filtered.

    `duplicate_keys` counts keys with several rows (NULL is one key). Every rule is
    counted over rows with a complete key. With `recency` a rule looks only at the
    newest row of each key, else at all rows. Only keys, flags and recency columns are
    shuffled; the copies are counted by a hash aggregate with a map-side combine, the
    newest rows picked with a group limit before the shuffle.
    """
    names = list(rules)
    if recency and tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in recency]
    order = [*recency, *(tie_break or ())] if recency else []
    flagged = df.select(*keys, *order, *[rules[n].cast("long").alias(f"_{n}") for n in names])
    copies = F.count("*").alias("_copies")
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    sums = [F.coalesce(F.sum(F.when(keyed, F.col(f"_{n}"))), F.lit(0)).alias(n) for n in names]
    duplicates = F.count_if(F.col("_copies") > 1).alias("duplicate_keys")
    if not recency:
        per_key = flagged.groupBy(*keys).agg(copies, *[F.sum(f"_{n}").alias(f"_{n}") for n in names])
        return per_key.agg(duplicates, *sums)
    counted = flagged.groupBy(*keys).agg(copies).agg(duplicates, *[F.lit(0).cast("long").alias(n) for n in names])
    newest = latest_per_key(flagged, keys, order, ()).agg(F.lit(0).cast("long").alias("duplicate_keys"), *sums)
    return counted.unionByName(newest).agg(*[F.sum(c).alias(c) for c in ("duplicate_keys", *names)])


def require_known(limits: Mapping[str, int], known: Iterable[str]) -> None:
    """Refuse limits on totals that a load does not measure, before any job runs."""
    unknown = sorted(set(limits) - set(known))
    if unknown:
        raise ValueError(f"no such total: {', '.join(unknown)}; there are {', '.join(sorted(known))}")


def gate(metrics: DataFrame, limits: Mapping[str, int] = DEFAULT_LIMITS) -> DataFrame:
    """`metrics` with the limited total `issues`, the verdict and the quality flag (1 or 0)."""
    issues = F.lit(0).cast("long")
    passed = F.lit(True)
    for name, limit in limits.items():
        issues = issues + F.col(name)
        passed = passed & (F.col(name) <= limit)
    return metrics.withColumns({"issues": issues, "passed": passed}).withColumn(
        "fl_quality", F.col("passed").cast("int")
    )


def check_gate(metrics: Mapping[str, int], limits: Mapping[str, int] = DEFAULT_LIMITS) -> None:
    """Raise `QualityGateError` where a total exceeds its limit."""
    if any(metrics[name] > limit for name, limit in limits.items()):
        raise QualityGateError(metrics, limits)
