"""Column profiles of the runs of a layer, stored as sketches and merged over runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from terrace.operators.profile import column_sketches, merged_sketches, profile_of
from terrace.schemas import Layout
from terrace.sinks import write_layer

SKETCHES = (
    "column string, rows long, nulls long, least string, greatest string, distinct_sketch binary, "
    "quantile_sketch binary, numeric boolean"
)


def store_profile(rows: DataFrame, layout: Layout, label: str, columns: Sequence[str], by: Sequence[str] = ()) -> str:
    """Store the sketches of a run's rows, one row per column and group `by`."""
    path = layout.run("profiles", label)
    write_layer(column_sketches(rows, columns, by), path)
    return path


def profile_over_runs(
    spark: SparkSession, layout: Layout, labels: Sequence[str], by: Sequence[str] = (), quantiles: Sequence[float] = (0.5,)
) -> DataFrame:
    """The profile of all rows of the runs together, from their sketches alone. `by` may be fewer
    of the columns that the profiles were stored by."""
    kinds = "".join(f"{name} string, " for name in by)
    stored = spark.read.schema(kinds + SKETCHES).parquet(*[layout.run("profiles", label) for label in labels])
    return profile_of(merged_sketches(stored, by), quantiles)
