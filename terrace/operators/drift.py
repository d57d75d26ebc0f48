"""Totals of a run against those of the runs before it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Makes the median distance to the median an estimate of the standard deviation (fixed value).
MAD_TO_SIGMA = 1.4826


@dataclass(frozen=True)
class DriftRule:
    """How far a total may lie from the median of up to `runs` earlier ones: `factor` times their
    spread, but at least `share` of the median and at least `least`. With fewer than `least_runs`
    earlier runs there is no bound. `falls` bounds the total from below as well."""

    runs: int = 60
    least_runs: int = 5
    factor: float = 6.0
    share: float = 0.5
    least: float = 20.0
    falls: bool = False


def _median(values: Column) -> Column:
    """Of a sorted array; NULL if it is empty."""
    n = F.size(values)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(values, low) + F.get(values, high)) / 2)


def with_bounds(totals: DataFrame, rule: DriftRule, by: Sequence[str] = ("metric",), run: str = "run", value: str = "value") -> DataFrame:
    """The totals with `earlier` (how many runs are looked at), `median`, `spread`, `low`, `high`
    and `drifted`. `totals` has at most one row per run and group `by`, in the order of `run`.

    Only the last `rule.runs` values of a group are held per row.
    """
    before = Window.partitionBy(*by).orderBy(run).rowsBetween(-rule.runs, -1)
    held = totals.withColumn("_held", F.sort_array(F.collect_list(F.col(value).cast("double")).over(before)))
    held = held.withColumns({"earlier": F.size("_held"), "median": _median(F.col("_held"))})
    away = F.sort_array(F.transform("_held", lambda x: F.abs(x - F.col("median"))))
    held = held.withColumn("_away", away).withColumn("spread", MAD_TO_SIGMA * _median(F.col("_away")))
    room = F.greatest(rule.factor * F.col("spread"), rule.share * F.abs("median"), F.lit(rule.least))
    known = F.col("earlier") >= rule.least_runs
    low = F.col("median") - room if rule.falls else F.lit(None).cast("double")
    held = held.withColumns({"low": F.when(known, low), "high": F.when(known, F.col("median") + room)})
    out = F.coalesce((F.col(value) > F.col("high")) | (F.col(value) < F.col("low")), F.col(value) > F.col("high"), F.lit(False))
    return held.withColumn("drifted", out).drop("_held", "_away")
