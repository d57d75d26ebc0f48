"""Parquet sinks. A run writes a folder of its own; readers move over when it is published."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.session import stored_bytes


def write_layer(
    df: DataFrame, path: str, by: Sequence[str] = (), rebalance: bool = True, mode: str = "errorifexists"
) -> None:
    """Snappy Parquet, one folder per value of the `by` columns. A path that is there
    already is refused unless `mode` says otherwise: a run id is used once.

    The rebalance brings equal values together, so that not every task opens a file
    in every folder; AQE then splits a value that is too big for one task and joins
    small ones. Turn it off for input that is already stored by these columns: the
    write then needs no shuffle.
    """
    if by and rebalance:
        df = df.hint("rebalance", *by)
    df.write.mode(mode).option("compression", "snappy").partitionBy(*by).parquet(path)


def create_namespaces(spark: SparkSession, names: Iterable[str] = ("silver", "gold")) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")


def quoted(name: str) -> str:
    """A dotted name with every part quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def publish_table(
    spark: SparkSession, name: str, run_id: str, path: str, schema: StructType, by: Sequence[str] = ()
) -> None:
    """Let the catalog name `name` show a finished run.

    The run becomes the table `name__run_id` over its files, and the view `name` is
    replaced to read it. The replacement is one catalog update: a reader sees the old
    run or the new one, never none. Earlier runs keep their tables and files. A run that
    is published again keeps the table that it has, so that nothing is taken from under
    a view; only the view is moved.
    """
    # A catalog takes letters, digits and underscores; other characters become their code.
    suffix = re.sub(r"[^A-Za-z0-9_]", lambda m: f"_x{ord(m[0]):x}_", run_id)
    table = quoted(f"{name}__{suffix}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    partitioning = f"PARTITIONED BY ({', '.join(quoted(c) for c in by)})" if by else ""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {partitioning} LOCATION '{location}'")
        if by:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    names = ", ".join(quoted(f.name) for f in schema)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS SELECT {names} FROM {table}")


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    file_bytes: int = 512 * 1024 * 1024,
) -> int:
    """Rewrite a layer as fewer, larger files and return how many slices were written.

    The slice count follows from the stored bytes. Rows are range-partitioned by
    (`by`, `cluster_by`), which keeps a folder in few files and lets a hot folder
    spread over several slices; within a file they are sorted by the same columns,
    so that min/max statistics can skip row groups. Without `cluster_by` a hash of the
    other columns splits a hot folder.
    """
    slices = max(1, -(-stored_bytes(spark, source) // file_bytes))
    df = spark.read.schema(schema).parquet(source).select(*schema.names)
    rest = [F.xxhash64(*[c for c in schema.names if c not in by])] if by and not cluster_by else []
    order = [*by, *cluster_by, *rest]
    if order:
        df = df.repartitionByRange(slices, *order).sortWithinPartitions(*by, *cluster_by)
    else:
        df = df.repartition(slices)
    write_layer(df, target, by, rebalance=False)
    return slices
