"""Helpers shared by the operators: stored tables, held-out folds, batches of bounded size."""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import scratch_dir

# Texts are handled in slices of about this many bytes, so that a task's arrays stay small
# however many rows an Arrow batch has. A longer text is a slice of its own.
SLICE_BYTES = 1 << 19
# Rows of numbers and digests, and documents, that are worth a file of their own.
FILE_ROWS, FILE_TEXTS = 50_000, 2_500
ODD = np.uint64(0x9E3779B97F4A7C15)


def few_tasks(df: DataFrame, rows: int, a_task: int = FILE_ROWS) -> DataFrame:
    """The same rows in at most a task for every `a_task` of `rows`, which is about how many there
    are, or more. What follows the last shuffle is done by them. For few rows this saves most of
    their cost: that of tasks and files, and on a local disk the processes that Hadoop starts
    from an executor for each file, which weigh as much as the executor while they start."""
    return df.coalesce(max(1, -(-rows // a_task)))


def stored(df: DataFrame, label: str, rows: int | None = None, a_file: int = FILE_ROWS) -> DataFrame:
    """The rows written to the shared scratch folder and read back: a lost executor costs
    no recomputation of what came before. With `rows`, about how many there are at most,
    there are at most as many files as they fill."""
    path = scratch_dir(df.sparkSession, label)
    (df if rows is None else few_tasks(df, rows, a_file)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds


def held_out(doc_id: str, folds: int, fold_no: int) -> Column:
    """Whether the row lies in the held-out fold; a row without id does not."""
    return F.coalesce(fold(doc_id, folds) == fold_no, F.lit(False))


def row_key(text: str = "text") -> Column:
    """Together with the id this tells rows apart; rows equal in both are interchangeable."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def fresh(names: list[str], wanted: str) -> str:
    """`wanted`, with underscores added until no column has that name."""
    while wanted.lower() in {n.lower() for n in names}:
        wanted += "_"
    return wanted


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column, or with `outer.inner` a field of a struct column."""
    outer, _, inner = name.partition(".")
    column = batch.column(batch.schema.get_field_index(outer))
    return column.field(inner) if inner else column


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `most` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = _column(batch, text)
        sizes = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(sizes, int(sizes[start]) + most, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; NULL is empty."""
    return [t or "" for t in _column(batch, text).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_LARGEST_TABLE = 1 << 21


def power_tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64. One table per base is kept, of
    bounded size; an unusually long text gets its own."""
    if base not in _TABLES or len(_TABLES[base][0]) < size:
        size = max(size, 1 << 16)
        made = powers(base, size), powers(pow(base, -1, 1 << 64), size)
        if size > _LARGEST_TABLE:
            return made
        _TABLES[base] = made
    return _TABLES[base]


@functools.cache
def code_values() -> np.ndarray:
    """A random value for every code point."""
    return mixed(np.arange(sys.maxunicode + 1, dtype=np.uint64) * ODD + ODD)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def span_hashes(values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of parts of `values`."""
    power, inverse = power_tables(base, 1 << int(len(values)).bit_length())
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mixed((sums[stop] - sums[start]) * inverse[start])


def runs_of(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the runs of true flags; the last flag must be false."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    return edges[::2], edges[1::2]
