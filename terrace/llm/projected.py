"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square test.

Largest inner product becomes smallest distance: vectors are divided by the largest norm and get
one more component that makes them unit vectors, queries become unit vectors with a zero there.
DIMS Gaussian projections (the 2-stable distribution) of each vector are the index. The ratio of a
projected to a true squared distance has the chi-square distribution of DIMS degrees, so once the
projected distance reached so far is `quantile * (k-th true distance so far)`, each closer vector
has been seen with the stated confidence, and the search ends.

A kd-tree on a sample of at most about SAMPLE rows (drawn at random; documented bound) cuts the
projected space into cells, and every row is stored in its cell. Cells with more than `cell_rows`
rows, as copies of one vector make them, are dealt into parts at random. A query first visits one
part of its own cell, which gives a first k-th distance; then it goes to the parts of all cells
that this distance does not rule out. In a part a kd-tree down to leaves gives the projected
neighbours incrementally, leaf by leaf in the order of their projected distance; a leaf's vectors
are verified with their true products, and the test ends the search of that part. Candidates of a
part stay together in one task; where very many queries visit a part, it is copied for every
QUERY_ROWS of them. The k best of all parts are merged.

Defined results: vectors that are NULL, empty, zero or hold a NULL or non-finite component, and
rows without an id, take no part. Shorter vectors are filled up with zeros. Repeated rows are
candidates of their own; queries equal in id and vector are one. A query never meets rows of its
own id. Scores are products added in the order of the components, in doubles; ties go to the
smaller id. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stored

DIMS, CONFIDENCE, SEED = 8, 0.95, 11
SAMPLE, LEAST_SAMPLED = 65_536, 16
CELL_ROWS, LEAF, QUERY_ROWS, QUERY_BATCH = 2_048, 64, 4_096, 1_024
SLACK = 1e-9
FOUND = "query long, query_id long, vec_ids array<long>, scores array<double>"
MEMBER = "vec_id long, v binary, p binary, cell int, draw long, query boolean"


def chi_square_cdf(x: float, degrees: int = DIMS) -> float:
    """Of an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))


@functools.cache
def chi_square_quantile(share: float, degrees: int = DIMS) -> float:
    low, high = 0.0, 1e3
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < share else (low, middle)
    return high


@functools.cache
def directions(width: int, dims: int = DIMS) -> np.ndarray:
    """Gaussian directions (width + 1, dims), the same for every task."""
    return np.random.default_rng(SEED).normal(size=(width + 1, dims))


def unit_rows(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and norms; components are scaled first, so that squares do not overflow."""
    largest = np.abs(v).max(axis=1, keepdims=True, initial=0)
    largest[largest == 0] = 1
    norms = largest[:, 0] * np.sqrt(((v / largest) ** 2).sum(1))
    return v / largest / np.sqrt(((v / largest) ** 2).sum(1))[:, None], norms


def projected(v: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Projections of vectors as candidates or, without the added component, as queries."""
    unit, norms = unit_rows(v)
    if query:
        return unit @ directions(v.shape[1])[:-1]
    share = np.minimum(norms / longest, 1.0)[:, None]
    return (unit * share) @ directions(v.shape[1])[:-1] + np.sqrt(1 - share**2) * directions(v.shape[1])[-1]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, added in the order of the components."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


class Tree:
    """A kd-tree over points by median splits of the widest side. Nodes are numbered from the
    root; a leaf has no children. `order` has the points leaf by leaf."""

    def __init__(self, points: np.ndarray, most: float):
        self.axis, self.cut, self.child, self.leaf = [], [], [], []
        self.low, self.high, ranges = [], [], []
        order, todo = np.arange(len(points)), [(0, len(points))]
        while todo:
            start, stop = todo.pop(0)
            own = points[order[start:stop]]
            low, high = own.min(0), own.max(0)
            node, axis, middle = len(self.axis), int(np.argmax(high - low)), (stop - start) // 2
            self.low.append(low)
            self.high.append(high)
            part, cut = np.argsort(own[:, axis], kind="stable"), 0.0
            if stop - start > most and high[axis] > low[axis]:
                values = own[part, axis]
                cut = values[middle]
                # Equal values stay on one side.
                middle = int(np.searchsorted(values, cut)) or int(np.searchsorted(values, cut, "right"))
                cut = values[middle]
                order[start:stop] = order[start:stop][part]
                self.child.append(node + len(todo) + 1)
                self.leaf.append(-1)
                todo += [(start, start + middle), (start + middle, stop)]
            else:
                self.child.append(-1)
                self.leaf.append(len(ranges))
                ranges.append((start, stop))
            self.axis.append(axis)
            self.cut.append(cut)
        self.axis, self.cut, self.child, self.leaf = (np.array(x) for x in (self.axis, self.cut, self.child, self.leaf))
        self.low, self.high, self.order, self.ranges = np.array(self.low), np.array(self.high), order, ranges

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point falls into."""
        node = np.zeros(len(points), np.int64)
        while (inner := np.flatnonzero(self.child[node] >= 0)).size:
            at = node[inner]
            node[inner] = self.child[at] + (points[inner, self.axis[at]] >= self.cut[at])
        return self.leaf[node]

    def near(self, points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, leaf, squared distance) of the leaves within each point's squared radius,
        by descent from the root, ordered by point and distance."""
        point, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        found: list[tuple[np.ndarray, ...]] = []
        while len(point):
            gap = box_distance(points[point], self.low[node], self.high[node])
            fits = gap <= radius[point]
            point, node, gap = point[fits], node[fits], gap[fits]
            ends = self.child[node] < 0
            found.append((point[ends], self.leaf[node[ends]], gap[ends]))
            point, node = np.repeat(point[~ends], 2), (self.child[node[~ends]][:, None] + np.arange(2)).ravel()
        point, leaf, gap = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((gap, point))
        return point[order], leaf[order], gap[order]


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of points to boxes; none within."""
    return (np.maximum(np.maximum(low - points, points - high), 0) ** 2).sum(-1)


class Part:
    """Candidates of a part of a cell with their kd-tree."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, p: np.ndarray, longest: float):
        self.tree, self.longest = Tree(p, LEAF), longest
        self.ids, self.v = ids[self.tree.order], v[self.tree.order]

    def search(self, ids: np.ndarray, v: np.ndarray, p: np.ndarray, reach: np.ndarray, k: int, quantile: float) -> tuple[list, np.ndarray]:
        """(candidates, scores) of each query's k best here, and its k-th squared distance,
        not above `reach`, that of its k-th neighbour elsewhere."""
        norms = unit_rows(v)[1]
        scale = norms * self.longest
        reach = reach.copy()
        point, leaf, gap = self.tree.near(p, quantile * (reach + SLACK))
        start = np.searchsorted(point, np.arange(len(ids)))
        stop = np.searchsorted(point, np.arange(len(ids)), "right")
        # The whole leaf is verified at once, so products are those of small matrices.
        scores = np.full((len(ids), len(self.ids)), -np.inf)
        best = np.full((len(ids), k), -np.inf)
        turn = 0
        while (active := np.flatnonzero(start + turn < stop)).size:
            at = start[active] + turn
            open_ = gap[at] <= quantile * (reach[active] + SLACK)
            # Leaves come in order: a query that stops here has seen all that can be near.
            stop[active[~open_]] = 0
            active, at = active[open_], at[open_]
            order = np.argsort(leaf[at], kind="stable")
            active, own = active[order], leaf[at[order]]
            cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])) if len(own) else []
            fresh = np.full((len(active), LEAF), -np.inf)
            for a, b in zip(cuts, cuts[1:]):
                first, last = self.tree.ranges[own[a]]
                for low in range(first, last, LEAF):
                    high = min(low + LEAF, last)
                    block = v[active[a:b]] @ self.v[low:high].T
                    block[ids[active[a:b], None] == self.ids[None, low:high]] = -np.inf
                    scores[active[a:b], low:high] = block
                    if low > first:
                        fresh[a:b] = np.sort(np.concatenate([fresh[a:b], block], 1), 1)[:, -LEAF:]
                    else:
                        fresh[a:b, : high - low] = block
            both = np.concatenate([best[active], fresh], 1)
            best[active] = np.partition(both, both.shape[1] - k, 1)[:, -k:]
            kth = best[active].min(1)
            with np.errstate(invalid="ignore"):
                reach[active] = np.minimum(reach[active], np.maximum(2 - 2 * kth / scale[active], 0))
            turn += 1
        kth = np.minimum(best.min(1), scores.max(1, initial=-np.inf))
        row, column = np.nonzero((scores >= (kth - 1e-12 * scale)[:, None]) & (scores > -np.inf))
        exact = product(v[row], self.v[column])
        order = np.lexsort((self.ids[column], -exact, row))
        row, column, exact = row[order], column[order], exact[order]
        cuts = np.searchsorted(row, np.arange(len(ids) + 1))
        return [(self.ids[column[a : min(b, a + k)]], exact[a : min(b, a + k)]) for a, b in zip(cuts, cuts[1:])], reach


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def usable(vectors: DataFrame, is_query: Column, vector: str = "embedding") -> DataFrame:
    """vec_id, v (doubles) and whether the row is a query, of the rows that take part."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda c: c != 0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))


def _dense(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column(1)
    if (np.diff(column.offsets.to_numpy()) == width).all():
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    out = np.zeros((batch.num_rows, width))
    for k, x in enumerate(column.to_pylist()):
        out[k, : len(x)] = x
    return out


@dataclass(frozen=True)
class Index:
    """Every row with its cell (stored), and of each cell its box, row count and parts."""

    members: DataFrame
    width: int
    longest: float
    tree: Tree | None
    low: np.ndarray
    high: np.ndarray
    parts: np.ndarray


def build(rows: DataFrame, cell_rows: int = CELL_ROWS, sample: int = SAMPLE) -> Index:
    largest = F.array_max(F.transform("v", F.abs))
    square = F.aggregate("v", F.lit(0.0), lambda at, x: at + (x / F.col("largest")) * (x / F.col("largest")))
    norm = F.col("largest") * F.sqrt(square)
    n, width, longest = rows.withColumn("largest", largest).agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
    if not n:
        return Index(rows.sparkSession.createDataFrame([], MEMBER), 0, 0.0, None, *(np.zeros((0, DIMS)),) * 2, np.zeros(0, np.int64))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_binary(projected(_dense(batch, width), longest, False))], ["p"])

    drawn = rows.filter(F.rand(SEED) < sample / n) if n > sample else rows
    points = np.frombuffer(b"".join(bytes(r[0]) for r in drawn.mapInArrow(project, "p binary").collect()), np.float64).reshape(-1, DIMS)
    tree = Tree(points, max(cell_rows * len(points) / n, LEAST_SAMPLED)) if len(points) else Tree(np.zeros((1, DIMS)), 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _dense(batch, width)
            p = projected(v, longest, False)
            arrays = [batch.column(0), _binary(v), _binary(p), pa.array(tree.leaf_of(p).astype(np.int32)), batch.column(3), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "v", "p", "cell", "draw", "query"])

    # The draw deals rows to parts: equal rows too, and for good, as it is stored.
    dealt = rows.withColumn("draw", F.floor(F.rand(SEED) * (1 << 40)))
    members = stored(dealt.mapInArrow(place, MEMBER), "members")

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_cells = len(tree.ranges)
        low, high, count = np.full((n_cells, DIMS), np.inf), np.full((n_cells, DIMS), -np.inf), np.zeros(n_cells, np.int64)
        for batch in batches:
            cell, p = batch.column(0).to_numpy(), _matrix(batch.column(1), DIMS)
            np.minimum.at(low, cell, p)
            np.maximum.at(high, cell, p)
            count += np.bincount(cell, minlength=n_cells)
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(count[seen]), pa.array(list(low[seen]), pa.list_(pa.float64())), pa.array(list(high[seen]), pa.list_(pa.float64()))], ["cell", "n", "low", "high"])

    met = members.select("cell", "p").mapInArrow(boxes, "cell long, n long, low array<double>, high array<double>")
    sides = [F.min(F.col("low")[j]) for j in range(DIMS)] + [F.max(F.col("high")[j]) for j in range(DIMS)]
    low, high = np.full((len(tree.ranges), DIMS), np.inf), np.full((len(tree.ranges), DIMS), -np.inf)
    parts = np.zeros(len(tree.ranges), np.int64)
    for cell, count, *box in met.groupBy("cell").agg(F.sum("n"), *sides).collect():  # at most the sample / LEAST_SAMPLED
        parts[cell], low[cell], high[cell] = -(-count // cell_rows), box[:DIMS], box[DIMS:]
    return Index(members, width, longest, tree, low, high, parts)


def _visited(index: Index, visits: DataFrame, answer: Callable) -> DataFrame:
    """Each part's candidates and then the queries that visit it (query, query_id, v, p, reach,
    cell, part), in one task, through `answer(part, queries)`."""
    parts = index.parts
    width, longest = index.width, index.longest
    spark = index.members.sparkSession
    sizes = spark.createDataFrame([(k, int(n)) for k, n in enumerate(parts)], "cell int, parts long")
    candidates = index.members.join(sizes, "cell").withColumn("part", F.pmod("draw", F.col("parts")))
    copies = visits.groupBy("cell", "part").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("copies"))
    zero = F.lit(0).cast("long")
    met = candidates.join(copies, ["cell", "part"]).select(
        "cell", "part", F.explode(F.sequence(zero, F.col("copies") - 1)).alias("copy"), zero.alias("query"), "vec_id", "v", "p", F.lit(None).cast("double").alias("reach")
    )
    salted = visits.join(copies, ["cell", "part"]).select(
        "cell", "part", F.pmod(F.xxhash64("query"), F.col("copies")).alias("copy"), "query", F.col("query_id").alias("vec_id"), "v", "p", "reach"
    )
    keys = ["cell", "part", "copy"]
    # Candidates have no reach and come first.
    rows = met.unionByName(salted).repartition(*keys).sortWithinPartitions(*keys, F.col("reach").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors, points, part = None, [], [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)], 1)
            asks = np.asarray(batch.column(7).is_valid())
            changed = (key[1:] != key[:-1]).any(1) | (asks[1:] != asks[:-1])
            cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                own = batch.slice(a, b - a)
                if at != tuple(key[a]):
                    at, ids, vectors, points, part = tuple(key[a]), [], [], [], None
                v, p = _matrix(own.column(5), width), _matrix(own.column(6), DIMS)
                if not asks[a]:
                    ids.append(own.column(4).to_numpy())
                    vectors.append(v)
                    points.append(p)
                    continue
                part = part or Part(np.concatenate(ids), np.concatenate(vectors), np.concatenate(points), longest)
                for start in range(0, own.num_rows, QUERY_BATCH):
                    some = slice(start, start + QUERY_BATCH)
                    numbers, query_ids, reach = (own.column(c).to_numpy()[some] for c in (3, 4, 7))
                    found, reach = answer(part, query_ids, v[some], p[some], reach)
                    arrays = [pa.array(numbers), pa.array(query_ids), pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.list_(pa.float64())), pa.array(reach)]
                    yield pa.RecordBatch.from_arrays(arrays, ["query", "query_id", "vec_ids", "scores", "reach"])

    return rows.mapInArrow(run, f"{FOUND}, reach double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", confidence: float = CONFIDENCE, cell_rows: int = CELL_ROWS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's `k` nearest found."""
    index = build(usable(vectors, is_query, vector), cell_rows, sample)
    spark = vectors.sparkSession
    if index.tree is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, quantile, parts = index.width, chi_square_quantile(confidence), index.parts
    low, high = index.low, index.high
    # Queries equal in id and vector are one; they are known by their hash from here on.
    asked = index.members.filter("query").groupBy("vec_id", "v").agg(F.first("cell").alias("cell"), F.first("draw").alias("draw"))
    asked = asked.select(F.xxhash64("vec_id", "v").alias("query"), F.col("vec_id").alias("query_id"), "v", "cell", "draw")

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = projected(_matrix(batch.column(2), width), 1.0, True)
            cell = batch.column(3).to_numpy()
            part = batch.column(4).to_numpy() % parts[cell]
            arrays = [*batch.columns[:3], _binary(p), pa.array(np.full(len(cell), 4.0)), pa.array(cell.astype(np.int32)), pa.array(part)]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "query_id", "v", "p", "reach", "cell", "part"])

    visit = "query long, query_id long, v binary, p binary, reach double, cell int, part long"
    at_home = stored(asked.mapInArrow(home, visit), "queries")
    first = _visited(index, at_home, lambda part, ids, v, p, reach: part.search(ids, v, p, reach, k, quantile))
    reaches = stored(first.select("query", "query_id", "reach"), "reaches")
    known = at_home.drop("reach", "cell", "part").join(reaches, ["query", "query_id"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, reach = _matrix(batch.column(3), DIMS), batch.column(4).to_numpy()
            for start in range(0, batch.num_rows, QUERY_BATCH):
                some = slice(start, start + QUERY_BATCH)
                rows, cells, deal = [], [], []
                for number, (point, far) in enumerate(zip(p[some], reach[some]), start):
                    near = np.flatnonzero((parts > 0) & (box_distance(point, low, high) <= quantile * (far + SLACK)))
                    every = np.repeat(near, parts[near])
                    rows.append(np.full(len(every), number))
                    cells.append(every)
                    deal.append(np.arange(len(every)) - np.repeat(np.cumsum(parts[near]) - parts[near], parts[near]))
                own = batch.take(pa.array(np.concatenate(rows)))
                arrays = [*own.columns, pa.array(np.concatenate(cells).astype(np.int32)), pa.array(np.concatenate(deal))]
                yield pa.RecordBatch.from_arrays(arrays, ["query", "query_id", "v", "p", "reach", "cell", "part"])

    routed = known.select("query", "query_id", "v", "p", "reach").mapInArrow(route, visit)
    found = _visited(index, stored(routed, "visits"), lambda part, ids, v, p, reach: part.search(ids, v, p, reach, k, quantile))
    # One row per query and part; a query's rows are merged as they stream by.
    rows = found.select("query", "query_id", "vec_ids", "scores").repartition("query").sortWithinPartitions("query", "query_id")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, scores = None, np.zeros(0, np.int64), np.zeros(0)

        def result() -> pa.RecordBatch:
            n = len(ids)
            arrays = [pa.array(np.full(n, at[1])), pa.array(np.arange(1, n + 1), pa.int32()), pa.array(ids), pa.array(scores)]
            return pa.RecordBatch.from_arrays(arrays, ["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for *key, new_ids, new_scores in zip(*(c.to_pylist() for c in batch.columns)):
                if at != key:
                    if at is not None:
                        yield result()
                    at, ids, scores = key, np.zeros(0, np.int64), np.zeros(0)
                ids, scores = np.concatenate([ids, np.array(new_ids, np.int64)]), np.concatenate([scores, new_scores])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
        if at is not None:
            yield result()

    return rows.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
