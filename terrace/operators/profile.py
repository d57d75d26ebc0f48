"""Column profiles that are stored per run or group and merged without reading rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# 2^12 registers: distinct counts within 1.6 % (one standard error).
DISTINCT_BITS = 12
# Ranks of quantiles within about 1 %.
QUANTILE_K = 200


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group `by` and column: `column`, `rows`, `nulls`, `least` and `greatest` as
    text, and the sketches `distinct_sketch` (of the values as text) and `quantile_sketch` (of
    the values of numeric columns that are numbers, as doubles). One pass over the rows; what is
    shuffled is a few sketches a group and task. Groups without a value have NULL sketches."""
    profiles = []
    for name in columns:
        value, kind = F.col(name), df.schema[name].dataType
        number = F.when(~F.isnan(value.cast("double")), value.cast("double"))
        sketch = F.kll_sketch_agg_double(number, QUANTILE_K) if isinstance(kind, NumericType) else F.lit(None).cast("binary")
        profiles.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count("*").alias("rows"),
                F.count_if(value.isNull()).alias("nulls"),
                F.min(value).cast("string").alias("least"),
                F.max(value).cast("string").alias("greatest"),
                F.hll_sketch_agg(value.cast("string"), DISTINCT_BITS).alias("distinct_sketch"),
                sketch.alias("quantile_sketch"),
                F.lit(isinstance(kind, NumericType)).alias("numeric"),
            )
        )
    wide = df.groupBy(*by).agg(F.array(*profiles).alias("profiles"))
    return wide.select(*by, F.explode("profiles").alias("profile")).select(*by, "profile.*")


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketch rows of several runs or groups as those of all their rows, per column and `by`."""
    numeric = F.col("numeric")

    def extreme(name: str, pick) -> Column:
        # Text orders 10 before 9: numbers are compared as numbers.
        as_number = F.struct(F.col(name).try_cast("double").alias("number"), F.col(name).alias("text"))
        return F.when(F.any_value("numeric"), pick(F.when(numeric & F.col(name).isNotNull(), as_number))["text"]).otherwise(pick(F.when(~numeric, F.col(name))))

    return sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        extreme("least", F.min).alias("least"),
        extreme("greatest", F.max).alias("greatest"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.any_value("numeric").alias("numeric"),
    )


def profile_of(sketches: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """The sketch rows with `distinct`, the estimated count of distinct values, and for numeric
    columns with values `quantiles`, the estimated values at these shares."""
    has_values = F.col("numeric") & (F.col("rows") > F.col("nulls"))
    picked = F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q))) for q in quantiles])
    return sketches.withColumns(
        {"distinct": F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)), "quantiles": F.when(has_values, picked)}
    ).drop("distinct_sketch", "quantile_sketch", "numeric")
