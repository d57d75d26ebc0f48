"""Reading runs of a layer whose schemas differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from terrace.session import setting

# Each holds all values of the ones before it.
_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
# Whole numbers that a float or double holds exactly.
_EXACT_IN = {FloatType(): (ByteType(), ShortType()), DoubleType(): (ByteType(), ShortType(), IntegerType(), FloatType())}
MOST_DIGITS = 38


def common_type(a: DataType, b: DataType) -> DataType:
    """The smallest type that holds every value of both unchanged; text if there is none.

    Whole numbers widen to larger ones, to decimals, and to a double if it holds them exactly; a
    date widens to a timestamp, structs field by field, arrays and maps by their parts.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    for x, y in ((a, b), (b, a)):
        if y in _EXACT_IN.get(x, ()):
            return x
        if isinstance(x, DecimalType) and (y in _WHOLE or isinstance(y, DecimalType)):
            scale = max(x.scale, getattr(y, "scale", 0))
            before = max(x.precision - x.scale, y.precision - y.scale if isinstance(y, DecimalType) else _DIGITS[y])
            return DecimalType(before + scale, scale) if before + scale <= MOST_DIGITS else StringType()
        if isinstance(x, (TimestampType, TimestampNTZType)) and isinstance(y, DateType):
            return x
    if isinstance(a, StructType) and isinstance(b, StructType):
        return common_schema([a, b])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(common_type(a.elementType, b.elementType), True)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType), True)
    return StringType()


def common_schema(schemas: Sequence[StructType]) -> StructType:
    """All columns of the schemas, in the order they first occur, each of its common type and
    nullable. Names that differ in case only are one column, as Spark reads them."""
    types: dict[str, StructField] = {}
    for schema in schemas:
        for own in schema:
            known = types.get(own.name.lower())
            kind = common_type(known.dataType, own.dataType) if known else own.dataType
            types[own.name.lower()] = StructField(known.name if known else own.name, kind, True)
    return StructType(list(types.values()))


def to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows under a wider schema: absent columns are NULL, others are cast."""
    own = {c.lower(): c for c in df.columns}
    columns = [
        (F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    return df.select(*columns)


def schema_drift(spark: SparkSession, schemas: Mapping[str, StructType]) -> DataFrame:
    """One row (run, column, change, before, after) per column that a run has `added`, lacks
    (`missing`), has `widened` or has `narrowed` or turned (`retyped`), against the common schema
    of the runs before it, in the order given."""
    rows, seen = [], None
    for run, schema in schemas.items():
        if seen is not None:
            old, new = ({f.name.lower(): f for f in s} for s in (seen, schema))
            for name in {**old, **new}:
                before, after = (s[name].dataType if name in s else None for s in (old, new))
                if before is None:
                    change = "added"
                elif after is None:
                    change = "missing"
                elif before == after:
                    continue
                else:
                    both = common_type(before, after)
                    change = "widened" if both == after else "narrowed" if both == before else "retyped"
                told = [t.simpleString() if t is not None else None for t in (before, after)]
                rows.append((run, (new.get(name) or old.get(name)).name, change, *told))
        seen = schema if seen is None else common_schema([seen, schema])
    return spark.createDataFrame(rows, "run string, column string, change string, before string, after string")


def run_schemas(spark: SparkSession, layer: str, run_ids: Sequence[str]) -> dict[str, StructType]:
    """The schema of each run of a layer as its files say; one footer a run is read. Partition
    columns are text."""
    with setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        return {run: spark.read.parquet(f"{layer.rstrip('/')}/run_id={run}").schema for run in run_ids}


def read_runs(spark: SparkSession, layer: str, run_ids: Sequence[str]) -> DataFrame:
    """The runs of a layer under their common schema, with the id of each in `run_id`.

    Runs of one schema are one scan, so the plan grows with the number of schemas, not of runs.
    """
    if not run_ids:
        raise ValueError("no runs to read")
    schemas = run_schemas(spark, layer, run_ids)
    owner = StructField("run_id", StringType(), True)
    wide = StructType([*common_schema(list(schemas.values())).fields, owner])
    alike: dict[str, list[str]] = {}
    for run, schema in schemas.items():
        alike.setdefault(schema.json(), []).append(run)
    out = None
    for runs in alike.values():
        # With the layer as base the run id is a partition column like those within the run.
        reader = spark.read.schema(StructType([*schemas[runs[0]].fields, owner])).option("basePath", layer)
        part = to_schema(reader.parquet(*[f"{layer.rstrip('/')}/run_id={run}" for run in runs]), wide)
        out = part if out is None else out.unionByName(part)
    return out
