"""Benchmark decontamination by the q-gram lemma.

Texts are compared as lower-case words joined by single blanks. An item of m characters
occurs in a text if some part of it is within k = floor(`budget` * m) edits of the item.
Such a part shares at least (m - q + 1) - k * q of the item's q-grams with it, all of them
on diagonals (place in the text minus place in the item) that differ by at most k. So
shared q-grams are counted in diagonal bands that overlap by k; bands that reach the bound
are retained, and their regions are verified by banded alignment.

For items too short for the bound to be positive, k is lowered until it is; an item shorter
than q is compared as a whole word sequence, and each of its places that do not overlap is
reported. Items are taken in blocks of at most
`block_chars` characters, each block in one pass over the documents with its q-gram index
broadcast; a single item must fit in memory.

Defined results: NULL or empty texts and items, and items without a letter or digit, match
nothing. Rows without an id are reported with a NULL id. Repeated documents and items are
each reported. An empty table gives no row. Other columns are not read by `matches`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from terrace.llm.common import fresh, mixed, powers, slices, texts_of

Q = 12
BUDGET = 0.05
# The index of a block takes some 20 bytes a character.
BLOCK_CHARS = 4 << 20
BASE = 0x2545F4914F6CDD1D
FILTER_BITS = 22
# Pairs of equal q-grams that are listed for a text; beyond, runs of them are counted.
MOST_PAIRS = 1 << 18
GAP = re.compile(r"[\W_]+")


def normalised(text: str) -> str:
    return GAP.sub(" ", text.lower()).strip()


def edits_allowed(m: int, q: int = Q, budget: float = BUDGET) -> int:
    """At most budget * m, and few enough that the q-gram bound stays positive."""
    return max(0, min(int(budget * m), (m - q) // q))


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A mixed hash of every q-gram."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    hashes = np.zeros(n, np.uint64)
    for weight, k in zip(powers(BASE, q), range(q)):
        hashes += codes[k : k + n] * weight
    return mixed(hashes)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


class Index:
    """q-grams of a block of items: a bit filter, sorted hashes and their postings."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q, budget: float = BUDGET):
        self.q, self.items = q, [(item_id, normalised(text or "")) for item_id, text in items]
        self.items = [(item_id, text) for item_id, text in self.items if text]
        sizes = [len(text) for _, text in self.items]
        self.edits = np.array([edits_allowed(m, q, budget) for m in sizes], np.int64)
        self.needed = np.array([m - q + 1 - k * q for m, k in zip(sizes, self.edits)], np.int64)
        hashes = [gram_hashes(codes_of(text), q) for _, text in self.items]
        all_ = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(all_, kind="stable")
        self.hashes = all_[order]
        self.item = np.repeat(np.arange(len(hashes), dtype=np.int32), [len(h) for h in hashes])[order]
        self.place = np.concatenate([np.arange(len(h), dtype=np.int32) for h in hashes])[order] if hashes else np.zeros(0, np.int32)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        # Items without a q-gram can only be found as whole words.
        self.short = [k for k, m in enumerate(sizes) if m < q]

    def candidates(self, text: str) -> list[tuple[int, int, int]]:
        """(item, lowest, highest diagonal) of the bands that reach their bound."""
        grams = gram_hashes(codes_of(text), self.q)
        at = np.flatnonzero(self.filter[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(at) or not len(self.hashes):
            return []
        first = np.searchsorted(self.hashes, grams[at], "left")
        count = np.searchsorted(self.hashes, grams[at], "right") - first
        at, first, count = at[count > 0], first[count > 0], count[count > 0]
        if not len(at):
            return []
        pairs = self.bands(at, first, count) if count.sum() <= MOST_PAIRS else self.bands_of_runs(at, first, count)
        out = []
        for i, b in pairs:
            w = int(self.edits[i]) + 1
            low, high = b * w, (b + 2) * w - 1
            if out and out[-1][0] == i and low <= out[-1][2] + 1:
                out[-1] = (i, out[-1][1], high)
            else:
                out.append((i, low, high))
        return out

    def bands(self, at: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) of the bands that reach their bound, in order; `at` are the places of the
        text's q-grams, `first` and `count` their postings."""
        posting = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        item, diagonal = self.item[posting], np.repeat(at, count) - self.place[posting]
        # Bands of k + 1 diagonals, each with the k next ones: any k + 1 neighbours are
        # together in one band.
        width = self.edits[item] + 1
        band = diagonal // width
        item = np.concatenate([item, item])
        place = np.concatenate([self.place[posting]] * 2)
        band = np.concatenate([band, band - 1])
        # A q-gram of the item counts once per band.
        keys = np.unique(np.stack([item, band, place]), axis=1)
        cut = np.flatnonzero(np.concatenate([[True], (keys[:2, 1:] != keys[:2, :-1]).any(0)]))
        shared = np.diff(np.append(cut, keys.shape[1]))
        return [tuple(x) for x in keys[:2, cut[shared >= self.needed[keys[0, cut]]]].T.tolist()]

    def bands_of_runs(self, at: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[tuple[int, int]]:
        """As `bands`, for texts that repeat q-grams which an item repeats too, without a row for
        each pair of places. Where a q-gram's next place in the text is at most a band's step
        away it lies in every band between, so a run of such places is one range of bands."""
        order = np.argsort(first, kind="stable")
        at, first, count = at[order], first[order], count[order]
        starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        shared: dict[int, tuple[int, np.ndarray]] = {}
        longest = int(at.max()) + 1
        for a, b in zip(starts, np.append(starts[1:], len(at))):
            places = slice(first[a], first[a] + count[a])
            own, text_places = self.item[places], np.sort(at[a:b])
            for item in np.unique(own).tolist():
                step = int(self.edits[item]) + 1
                edges = np.flatnonzero(np.diff(text_places) > step)
                low = text_places[np.concatenate([[0], edges + 1])]
                high = text_places[np.concatenate([edges, [len(text_places) - 1]])]
                if item not in shared:
                    least = -len(self.items[item][1]) // step - 2
                    shared[item] = least, np.zeros(longest // step - least + 3, np.int64)
                least, change = shared[item]
                for place in self.place[places][own == item].tolist():
                    start, stop = (low - place) // step - 1, (high - place) // step
                    # Runs next to each other may share a band; it counts once.
                    start[1:] = np.maximum(start[1:], stop[:-1] + 1)
                    kept = start <= stop
                    np.add.at(change, start[kept] - least, 1)
                    np.add.at(change, stop[kept] + 1 - least, -1)
        out = []
        for item in sorted(shared):
            least, change = shared[item]
            out += [(item, int(b) + least) for b in np.flatnonzero(np.cumsum(change) >= self.needed[item])]
        return out

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, edits, start, end) of the best part of the text in each retained region."""
        found = []
        for i, low, high in self.candidates(text):
            item, k = self.items[i][1], int(self.edits[i])
            start, stop = max(0, low - k), min(len(text), high + len(item) + k)
            best = aligned(item, text[start:stop], k, low - k - start, high + k - start)
            if best:
                found.append((i, best[0], start + best[1], start + best[2]))
        padded = f" {text} "
        for i in self.short:
            item = self.items[i][1]
            at = padded.find(f" {item} ")
            while at >= 0:
                found.append((i, 0, at, at + len(item)))
                at = padded.find(f" {item} ", at + len(item) + 1)
        return found


def aligned(item: str, region: str, k: int, low: int | None = None, high: int | None = None) -> tuple[int, int, int] | None:
    """(edits, start, end) of the region's part with the fewest edits to the item, the
    first among equals; None beyond k. Only cells on the diagonals from `low` to `high` (place in
    the region minus place in the item) are filled, so the work is the item's length times
    their number; all diagonals unless they are given."""
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    if not k or not region:
        return None
    text, codes = codes_of(region), codes_of(item)
    m, n = len(codes), len(text)
    low, high = -m if low is None else max(low, -m), n if high is None else min(high, n)
    if low > high:
        return None
    width, unit, far = high - low + 1, n + 1, (m + n + 2) * (n + 1)
    # Row i holds the columns i + low to i + high. Cost first and the start of the part in the
    # low bits, so that one minimum moves both. The text is padded to slice every row alike.
    padded = np.concatenate([np.full(max(0, -low), 1 << 40, np.uint64), text, np.full(m + width, 1 << 40, np.uint64)])
    offset = low + max(0, -low)
    steps = np.arange(width) * unit
    column = low + np.arange(width)
    key = np.where((column >= 0) & (column <= n), column, far)
    for row, code in enumerate(codes, 1):
        # One row down on the same diagonal is the next letter of both.
        window = padded[row + offset - 1 : row + offset - 1 + width]
        new = key + np.where(window == code, 0, unit)
        new[:-1] = np.minimum(new[:-1], key[1:] + unit)
        # Steps along the text cost one each: a running minimum of cost minus column.
        new = np.minimum.accumulate(new - steps) + steps
        column = row + low + np.arange(width)
        key = np.where((column >= 0) & (column <= n), np.minimum(new, far), far)
        if key.min() // unit > k:
            return None
    best = key // unit
    end = int(best.argmin())
    return (int(best[end]), int(key[end] % unit), m + low + end) if best[end] <= k else None


def indexes(benchmark: DataFrame, block_chars: int) -> Iterator[Broadcast]:
    """The broadcast index of each block of items: about `block_chars` characters, or one
    item. Sizes are counted first and the driver holds one block at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = items.filter(part == block).orderBy("item_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in rows], Q, BUDGET))


def with_matches(docs: DataFrame, index: Broadcast, name: str) -> DataFrame:
    """All columns of the documents, and as column `name` the matches with the items of
    one block."""
    fields = ("item_id", "edits", "start", "end")
    match = StructType([StructField(field, LongType()) for field in fields])
    arrow_type = pa.list_(pa.struct([(field, pa.int64()) for field in fields]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index.value.items
        for batch in slices(batches):
            found = [index.value.matches(normalised(text)) for text in texts_of(batch)]
            out = [[dict(zip(fields, (items[i][0], *m))) for i, *m in own] for own in found]
            yield batch.append_column(name, pa.array(out, arrow_type))

    return docs.mapInArrow(find, StructType([*docs.schema, StructField(name, ArrayType(match))]))


def matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, edits, start, end of every retained and verified region; places
    are those in the normalised text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = [with_matches(docs, index, "found").select("doc_id", F.explode("found").alias("m")) for index in indexes(benchmark, block_chars)]
    return reduce(DataFrame.unionByName, parts).select("doc_id", "m.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all columns, that hold no item. Each block of items filters what the
    earlier ones left."""
    found = fresh(docs.columns, "found")
    for index in indexes(benchmark, block_chars):
        docs = with_matches(docs, index, found).filter(F.size(found) == 0).drop(found)
    return docs
