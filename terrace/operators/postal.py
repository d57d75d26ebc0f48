"""Postal codes against a table of patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATTERN = "_postal_pattern"


def pattern_table(patterns: DataFrame, country: str = "country", pattern: str = "pattern") -> DataFrame:
    """One pattern per country: a code may match any of a country's patterns. Rows without a
    country or a pattern do not count."""
    named = patterns.filter(F.col(country).isNotNull() & F.col(pattern).isNotNull())
    own = named.groupBy(F.col(country).alias("_country")).agg(F.sort_array(F.collect_set(pattern)).alias("all"))
    either = F.concat(F.lit("(?:"), F.array_join("all", ")|(?:"), F.lit(")"))
    return own.select("_country", F.when(F.size("all") > 1, either).otherwise(F.get("all", F.lit(0))).alias(PATTERN))


def with_postal_pattern(df: DataFrame, patterns: DataFrame, country: str = "country") -> DataFrame:
    """The rows with the pattern of their country in `_postal_pattern`, sorted by it within a
    task: `rlike` keeps the pattern it used last, so each is compiled once a task.

    The plan is the same for any number of countries. AQE broadcasts the table when its measured
    size is small and splits a country with most of the rows otherwise.
    """
    table = pattern_table(patterns)
    met = df.join(table, df[country] == table["_country"], "left").drop("_country")
    return met.sortWithinPartitions(PATTERN)


def breaks_pattern(postal: str = "postal_code") -> Column:
    """True where a code breaks the joined pattern; a missing code or pattern breaks none."""
    return F.coalesce(~F.rlike(F.col(postal), F.col(PATTERN)), F.lit(False))


def invalid_postal_by_table(
    df: DataFrame, patterns: DataFrame, country: str = "country", postal: str = "postal_code"
) -> DataFrame:
    """Rows whose code breaks the pattern of their country in the table (country, pattern)."""
    return with_postal_pattern(df, patterns, country).filter(breaks_pattern(postal)).drop(PATTERN)
