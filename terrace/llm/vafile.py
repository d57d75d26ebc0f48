"""Exact top-k search by inner product with vector-approximation files.

Candidates are cut into blocks. A block holds, for each vector, one cell number per
component (the approximation) beside the exact components. Each block of queries meets each
block of candidates once: the cells are scanned for an upper bound of every score, the
exact vectors are read in the order of these bounds, and reading stops when the k-th best
exact score is above the next bound. The k best of all blocks are merged.

The stated queries meet all rows, so the work is theirs times the rows'; what is moved is
the queries once per candidate block and the candidates once per query block, packed.

Defined results: vectors that are NULL or hold a NULL or non-finite component, and rows
without an id, take no part. Shorter vectors are filled up with zeros. Rows equal in id and
vector count once; a query never meets rows of its own id. Ties go to the smaller id. An
empty table gives no row. Other columns are not read. Scores beyond 2^63 raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored

RESULT = "query_id long, vec_id long, score long"
CELLS = 16


def quantised(vectors: DataFrame, vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """vec_id and v, floor(scale * component) of the rows that take part."""
    x = F.col(vector)
    whole = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).distinct()


def cell_grid(v: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Lower edge of each cell and last the upper edge, by component (cells + 1, d); the
    cells hold about equally many vectors."""
    return np.quantile(v, np.linspace(0, 1, cells + 1), axis=0, method="lower")


class Block:
    """Exact vectors and their approximations."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        self.ids, self.v = ids, v
        self.grid = cell_grid(v)
        # Component by component: the cell whose edges enclose the value.
        self.cells = np.stack([np.clip(np.searchsorted(self.grid[:, j], v[:, j], "right") - 1, 0, CELLS - 1) for j in range(v.shape[1])], 1).astype(np.uint8) if v.shape[1] else np.zeros(v.shape, np.uint8)

    def scan(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds (queries, vectors) of the scores, from cells only: the middle of
        each cell plus, for either sign of the query's component, half its width."""
        column = np.arange(self.v.shape[1])
        low, high = self.grid[self.cells, column], self.grid[self.cells + 1, column]
        middle, half = (low + high) / 2.0, (high - low) / 2.0
        return queries @ middle.T + np.abs(queries) @ half.T

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, step: int = 64) -> tuple[np.ndarray, ...]:
        """(query row, candidate, score) of each query's k best in this block."""
        bounds = self.scan(queries.astype(float))
        # Exact for integers; the slack covers rounding of the bounds beyond 2^53.
        bounds += np.abs(bounds) * 1e-12 + 1e-9
        own = query_ids[:, None] == self.ids[None, :]
        bounds[own] = -np.inf
        rows, ids, scores = [], [], []
        for q in range(len(queries)):
            row = bounds[q]
            first = min(max(step, k + 1), len(row))
            order = np.argpartition(-row, first - 1)[:first] if first < len(row) else np.arange(len(row))
            order = order[np.isfinite(row[order])]
            exact = self.v[order] @ queries[q]
            if len(exact) > k:
                # The k-th best so far; only vectors whose bound reaches it can change it.
                floor = np.partition(exact, -k)[-k]
                more = np.flatnonzero(row >= floor)
                more = more[np.argsort(-row[more], kind="stable")]
                found, seen = exact, order
                read = np.zeros(len(row), bool)
                read[order] = True
                more = more[~read[more]]
                at = 0
                while at < len(more) and row[more[at]] >= floor:
                    part = more[at : at + step]
                    found = np.concatenate([found, self.v[part] @ queries[q]])
                    seen = np.concatenate([seen, part])
                    floor = np.partition(found, -k)[-k]
                    at += step
                order, exact = seen, found
            top = np.lexsort((self.ids[order], -exact))[:k]
            rows.append(np.full(len(top), q))
            ids.append(self.ids[order[top]])
            scores.append(exact[top])
        return np.concatenate(rows), np.concatenate(ids), np.concatenate(scores)


def _packed(rows: DataFrame, block: str, width: int) -> DataFrame:
    """One row per block: ids and components as little-endian integers."""

    def pack(table: pa.Table) -> pa.Table:
        v = np.zeros((len(table), width), np.int64)
        for k, x in enumerate(table["v"].to_pylist()):
            v[k, : len(x)] = x
        most = int(np.abs(v).max(initial=0))
        if most * most * max(width, 1) >= 1 << 63:
            raise ValueError("components too large for 64-bit scores")
        kind = "<i2" if most < 1 << 15 else "<i8"
        data = [[int(table[block][0].as_py())], [table["vec_id"].to_numpy().astype("<i8").tobytes()], [v.astype(kind).tobytes()], [kind]]
        return pa.Table.from_arrays([pa.array(data[0], pa.int64()), pa.array(data[1], pa.binary()), pa.array(data[2], pa.binary()), pa.array(data[3])], [block, "ids", "data", "kind"])

    return rows.groupBy(block).applyInArrow(pack, f"{block} long, ids binary, data binary, kind string")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", block_rows: int = 8_192, query_rows: int = 1_024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best candidates."""
    rows = stored(quantised(vectors, vector), "vectors")
    n, width, n_queries = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if(is_query)).first()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_rows))

    def cut(part: DataFrame, name: str, count: int) -> DataFrame:
        return _packed(part.withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(count))), name, width)

    candidates = cut(rows, "block", blocks)
    queries = cut(rows.filter(is_query), "query_block", query_blocks)
    # Each block of queries is sent to each block of candidates, as packed rows.
    sent = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "query_block", *(F.col(c).alias(f"query_{c}") for c in ("ids", "data", "kind")))
    # The pairs are spread by both blocks, so that one block is not one task.
    pairs = sent.join(candidates, "block").repartition("block", "query_block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if known[0] != row["block"]:
                    known = row["block"], Block(np.frombuffer(row["ids"], "<i8"), _unpacked(row["data"], row["kind"], len(row["ids"]) // 8))
                query_ids = np.frombuffer(row["query_ids"], "<i8")
                v = _unpacked(row["query_data"], row["query_kind"], len(query_ids))
                for start in range(0, len(query_ids), 256):
                    part = slice(start, start + 256)
                    q, ids, scores = known[1].best(query_ids[part], v[part], k)
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[part][q]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, RESULT)
    # Each query has k rows per block of candidates; they are cut to k before the shuffle.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _unpacked(data: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, -1).astype(np.int64)
