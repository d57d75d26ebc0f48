"""JSON records to columns by an explicit path list."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from terrace.schemas import LANDING

# Fixed value: the field list of the landing copy, as path -> column.
COPY_MAPPING = {f"$['{name}']": name for name in LANDING.names}

_STEP = re.compile(r"\['([^']+)'\]|\.([A-Za-z_][\w]*)")


def path_steps(path: str) -> list[str]:
    """`$['a']['b']` or `$.a.b` as its field names."""
    steps = [quoted or plain for quoted, plain in _STEP.findall(path)]
    if not path.startswith("$") or not steps or _STEP.sub("", path[1:]):
        raise ValueError(f"not a field path: {path}")
    return steps


def mapping_schema(mapping: Mapping[str, str]) -> StructType:
    """Schema that holds every path of `mapping` as text and nothing else."""
    tree: dict = {}
    for path in mapping:
        node = tree
        *parents, leaf = path_steps(path)
        for name in parents:
            node = node.setdefault(name, {})
            if node is None:
                raise ValueError(f"{path} goes through a field that is mapped as text")
        if node.get(leaf) is not None:
            raise ValueError(f"{path} is mapped as text and has fields of its own")
        node[leaf] = None

    def build(node: dict) -> StructType:
        return StructType(
            [StructField(n, StringType() if sub is None else build(sub), True) for n, sub in node.items()]
        )

    return build(tree)


def _field(root: Column | None, steps: list[str]) -> Column:
    column = root
    for name in steps:
        column = F.col(f"`{name}`") if column is None else column.getField(name)
    return column


def map_json(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Adds one text column per path. The JSON text is parsed once for all of them."""
    parsed = F.from_json(column, mapping_schema(mapping))
    return (
        df.withColumn("_json", parsed)
        .withColumns({out: _field(F.col("_json"), path_steps(p)) for p, out in mapping.items()})
        .drop("_json")
    )


def read_mapped_json(
    spark: SparkSession, path: str, mapping: Mapping[str, str] = COPY_MAPPING, multi_line: bool = True
) -> DataFrame:
    """JSON files as one text column per path."""
    df = spark.read.schema(mapping_schema(mapping)).option("multiLine", multi_line).json(path)
    return df.select(*[_field(None, path_steps(p)).alias(out) for p, out in mapping.items()])
