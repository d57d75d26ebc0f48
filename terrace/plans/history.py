"""The stored totals of a lake's runs, and the bounds that they set for the next one."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import QualityGateError
from terrace.operators.drift import DriftRule, with_bounds
from terrace.plans.runs import finished_runs
from terrace.schemas import Layout
from terrace.session import exists

METRICS = "load string, metric string, value long, stopped string, at timestamp, run_id string"
# Totals whose fall matters as much as their rise.
SIZES = ("total", "kept", "accepted")


@dataclass(frozen=True)
class HistoryGate:
    """Bounds from history for the totals of a load. Sizes are bounded on both sides."""

    rule: DriftRule = DriftRule()
    sizes: DriftRule = DriftRule(falls=True)
    metrics: tuple[str, ...] = ("bad_postal", "no_contact", "postal_missing", "duplicate_keys", "coord_malformed", *SIZES)


class DriftError(QualityGateError):
    """Totals are far from those of the earlier runs; nothing of the load was written."""

    def __init__(self, metrics: Mapping[str, int], drifted: Mapping[str, tuple[float, float]]):
        self.metrics = dict(metrics)
        told = ", ".join(f"{k}={metrics[k]} (history {low:g} to {high:g})" for k, (low, high) in drifted.items())
        RuntimeError.__init__(self, f"quality gate failed: {told}")


def metric_history(spark: SparkSession, layout: Layout) -> DataFrame:
    """run (its number), load, metric and value of every finished run."""
    path = layout.layer("metrics")
    if not exists(spark, path):
        return spark.createDataFrame([], "run int, load string, metric string, value long")
    runs = spark.createDataFrame([(r.label, r.number) for r in finished_runs(spark, layout)], "run_id string, run int")
    stored = spark.read.schema(METRICS).parquet(path)
    return stored.join(runs, "run_id").select("run", "load", "metric", "value")


def bounds_for_next(spark: SparkSession, layout: Layout, gate: HistoryGate = HistoryGate()) -> dict[str, dict[str, tuple[float, float]]]:
    """For each load the (low, high) of its totals, where there is history enough: one row a total."""
    history = metric_history(spark, layout).filter(F.col("metric").isin(*gate.metrics))
    ahead = history.select("load", "metric").distinct().select(F.lit((1 << 31) - 1).alias("run"), "load", "metric", F.lit(None).cast("long").alias("value"))
    out: dict[str, dict[str, tuple[float, float]]] = {}
    size = F.col("metric").isin(*SIZES)
    for rule, part in ((gate.sizes, size), (gate.rule, ~size)):
        rows = with_bounds(history.unionByName(ahead).filter(part), rule, ("load", "metric"))
        for r in rows.filter(f"run = {(1 << 31) - 1} AND high IS NOT NULL").collect():
            out.setdefault(r.load, {})[r.metric] = (float("-inf") if r.low is None else r.low, r.high)
    return out


def check_drift(metrics: Mapping[str, int], bounds: Mapping[str, tuple[float, float]]) -> None:
    """Raise `DriftError` where a total lies outside its bounds."""
    drifted = {k: (low, high) for k, (low, high) in bounds.items() if k in metrics and not low <= metrics[k] <= high}
    if drifted:
        raise DriftError(metrics, drifted)
