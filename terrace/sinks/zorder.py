"""Z-order clustering: files whose rows lie close together in several columns at once.

Sorted by (a, b) a file holds a narrow range of a and any b. Here each column is cut into cells
that hold about equally many rows, the bits of a row's cell numbers are interleaved, and the rows
are range-shuffled and sorted by that number, so that a file or row group covers a small box and a
filter on any of the columns leaves most of them out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.session import stored_bytes
from terrace.sinks.layers import write_layer

MOST_BITS, CODE_BITS = 8, 24
SAMPLE = 100_000


def cell_edges(df: DataFrame, columns: Sequence[str], bits: int, sample: int = SAMPLE, seed: int = 5) -> dict[str, list]:
    """Ascending values that cut each column into at most 2^bits cells of about equally many
    rows, from a random sample of about `sample` rows, which is what comes to the driver. A
    value that fills several cells is one edge."""
    n = df.count()
    drawn = df.select(*columns).filter(F.rand(seed) < sample / n) if n > sample else df.select(*columns)
    edges: dict[str, list] = {c: [] for c in columns}
    rows = drawn.collect()
    for at, name in enumerate(columns):
        values = sorted(r[at] for r in rows if r[at] is not None and r[at] == r[at])
        picked = [values[len(values) * k >> bits] for k in range(1, 1 << bits)] if values else []
        edges[name] = [v for k, v in enumerate(picked) if (v > picked[k - 1] if k else v > values[0])]
    return edges


def cell_number(name: str, edges: Sequence) -> Column:
    """How many edges are not above the value, found by halving; 0 for NULL."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(name) < F.lit(edges[middle]), within(low, middle)).otherwise(within(middle + 1, high))

    return F.when(F.col(name).isNull(), 0).otherwise(within(0, len(edges)))


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """One long of the numbers' bits, the highest bit of the first number first."""
    code = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for number in numbers:
            code = F.shiftleft(code, 1).bitwiseOR(F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long"))
    return code


def z_code(edges: Mapping[str, Sequence], bits: int) -> Column:
    return interleaved([cell_number(name, own) for name, own in edges.items()], bits)


def zorder(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    columns: Sequence[str],
    by: Sequence[str] = (),
    file_bytes: int = 512 * 1024 * 1024,
) -> int:
    """Rewrite a layer clustered by all `columns` alike and return the number of slices.

    Within a cell rows are sorted by the columns, and a hash of the whole row lets a combination
    that holds a large part of the rows spread over several slices. Partition folders `by` come
    first. Columns of maps or variants cannot be clustered by.
    """
    slices = max(1, -(-stored_bytes(spark, source) // file_bytes))
    df = spark.read.schema(schema).parquet(source).select(*schema.names)
    bits = min(MOST_BITS, CODE_BITS // len(columns))
    coded = df.withColumn("_z", z_code(cell_edges(df, columns, bits), bits))
    order = [*by, "_z", *columns]
    spread = F.xxhash64(*[c for c in schema.names if c not in by])
    rows = coded.repartitionByRange(slices, *order, spread).sortWithinPartitions(*order)
    write_layer(rows.drop("_z"), target, by, rebalance=False)
    return slices
