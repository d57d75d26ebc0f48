"""KPI queries over a gold table (`entity_count` per name, category and place)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators import percent_of_group, sum_by, top_n

# The order among equal counts, so that a winner never depends on the partitioning.
TIE_BREAK = ("category", "name", "country", "city")


def category_grain(gold: DataFrame, measure: str = "entity_count") -> DataFrame:
    """Gold summed up to one row per state and category."""
    return sum_by(gold, ["state", "category"], measure, measure)


def largest_first(df: DataFrame, measure: str) -> list[Column]:
    """Descending by measure, then by the tie-break columns that the frame has."""
    return [F.col(measure).desc(), *[F.col(c).asc() for c in TIE_BREAK if c in df.columns]]


def total_by(
    gold: DataFrame, dim: str, measure: str = "entity_count", out: str = "total_entities"
) -> DataFrame:
    """Total per value of `dim`, largest first."""
    return sum_by(gold, [dim], measure, out).orderBy(F.desc(out), dim)


def states_for_category(
    gold: DataFrame, category: str, measure: str = "entity_count", out: str = "total_entities"
) -> DataFrame:
    """States by their total of one category, largest first."""
    return total_by(gold.filter(F.col("category") == category), "state", measure, out)


def share_within_state(
    gold: DataFrame, measure: str = "entity_count", extra: Sequence[str] = ()
) -> DataFrame:
    """Each row's share of its state. The grain is that of `gold`: see `category_grain`."""
    shares = percent_of_group(gold, ["state"], measure)
    columns = ["state", "category", *extra, measure, "percentage"]
    ties = [c for c in TIE_BREAK if c in shares.columns]
    return shares.orderBy("state", F.desc("percentage"), *ties).select(*columns)


def popular_categories(gold: DataFrame, measure: str = "entity_count") -> DataFrame:
    """Categories of the largest row of each state: summed counts and states won."""
    winners = top_n(gold, ["state"], largest_first(gold, measure))
    return (
        winners.groupBy(F.col("category").alias("most_popular_category"))
        .agg(F.sum(measure).alias("total"), F.count("*").alias("states"))
        .orderBy(F.desc("total"), "most_popular_category")
    )
