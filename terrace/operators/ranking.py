"""Results relative to a group: shares, row numbers and the first rows.

A group may hold a large part of all rows, so none of these brings a whole group
into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import percentage
from terrace.session import scratch_dir

_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def with_group_total(df: DataFrame, by: Sequence[str], measure: str, out: str) -> DataFrame:
    """Each row with the total of `measure` over its group.

    The totals are aggregated with a map-side combine and joined back, instead of a
    window that would sort each whole group in one task. AQE broadcasts the totals
    when their measured size is small and splits a hot group otherwise.
    """
    totals = df.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(F.sum(measure).alias(out))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    return df.join(totals, same, "inner").drop(*[f"_of_{c}" for c in by])


def percent_of_group(
    df: DataFrame, by: Sequence[str], measure: str, out: str = "percentage"
) -> DataFrame:
    """Each row with its share of the group total, in percent rounded to 2 places."""
    return (
        with_group_total(df, by, measure, "_total")
        .withColumn(out, percentage(measure, "_total"))
        .drop("_total")
    )


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first `n` rows of each group.

    Planned as WindowGroupLimit before and after the shuffle, so a task sends at
    most `n` rows per group. Spark does that up to a limit of `n`; a larger one is
    refused, as whole groups would meet in a task: `number_rows` splits them. `order`
    must be total for a repeatable result.
    """
    limit = int(df.sparkSession.conf.get(_GROUP_LIMIT, "1000"))
    if n > limit:
        raise ValueError(f"n is over {_GROUP_LIMIT}={limit}; use number_rows")
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") <= n).drop("_nth")


def number_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "rank", slices: int | None = None
) -> DataFrame:
    """Row number (long) within each group. `order` must be total for a repeatable result.

    The rows are cut into ordered slices by a range shuffle on (group, order), so that a
    large group spreads over several, and stored. They are then numbered within their
    slice and moved up by the rows that the group has in earlier slices. The upstream is
    computed once; the sizes are taken from the stored slices.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *[F.col(c).asc() for c in by], *order)
    # The slice bounds come from a sample. Writing the slices fixes them: a task that
    # is run again later reads the same slices and does not cut new ones.
    path = scratch_dir(spark, "slices")
    sliced = ranged.withColumn("_slice", F.spark_partition_id())
    sliced.write.parquet(path)
    cut = spark.read.schema(sliced.schema).parquet(path)

    w = Window.partitionBy(*by, "_slice").orderBy(*order)
    numbered = cut.withColumn("_local", F.row_number().over(w))
    sizes = cut.groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    # One row per group and slice: at most the number of slices in a window.
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_of_{c}") for c in by],
        F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by] + [F.col("_slice") == F.col("_at")]
    return numbered.join(offsets, same, "inner").select(
        *df.columns, (F.col("_local") + F.col("_offset")).alias(out)
    )
