"""Row-wise refinement: projection, casts, masking, stamps and filters.

Every function maps a DataFrame to a DataFrame without a shuffle, so it can be
chained with `df.transform`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from terrace.functions import POSTAL_US, any_present, bad_postal, coordinate, masked


def project(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the fields of `schema`, in its order: missing ones NULL, others dropped."""
    have = {f.name: f.dataType for f in df.schema}

    def field(f) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if have[f.name] == f.dataType:
            return F.col(f.name)
        return F.col(f.name).try_cast(f.dataType).alias(f.name)

    return df.select(*[field(f) for f in schema])


def extra_columns(df: DataFrame, schema: StructType) -> list[str]:
    """Columns that `project` would drop."""
    return [c for c in df.columns if c not in schema.names]


def enforce_schema(df: DataFrame, schema: StructType) -> tuple[DataFrame, list[str]]:
    """The projected frame and the names of the columns it no longer has."""
    return project(df, schema), extra_columns(df, schema)


def parse_coords(df: DataFrame, names: Iterable[str] = ("longitude", "latitude")) -> DataFrame:
    return df.withColumns({c: coordinate(c) for c in names})


def cast_cols(df: DataFrame, types: Mapping[str, str | DataType]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def lower_cols(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in names})


def hash_col(df: DataFrame, name: str, salt: str = "") -> DataFrame:
    return df.withColumn(name, masked(name, salt))


def stamp(df: DataFrame, name: str, ts: datetime | None = None) -> DataFrame:
    """One load timestamp for the whole frame: `ts`, or the time the query starts."""
    return df.withColumn(name, F.current_timestamp() if ts is None else F.lit(ts))


def drop_null_key(df: DataFrame, keys: Iterable[str] = ("id",)) -> DataFrame:
    """Rows with a complete key. Plain IS NOT NULL terms reach the Parquet scan; the
    expression behind `na.drop` does not."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def require_any(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows with at least one of the columns present."""
    return df.filter(any_present(names))


def missing_all(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows with none of the columns present: the complement of `require_any`."""
    return df.filter(~any_present(names))


def invalid_postal(
    df: DataFrame,
    patterns: Mapping[str, str] = POSTAL_US,
    country: str = "country",
    postal: str = "postal_code",
) -> DataFrame:
    """Rows whose postal code breaks the pattern of their country."""
    return df.filter(bad_postal(patterns, country, postal))
