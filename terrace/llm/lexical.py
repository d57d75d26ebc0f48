"""Ranked lexical search by dense blocked multiplication.

Items are taken in blocks of bounded bytes of terms. For a block one pass over the documents
cuts each whole text into terms and keeps its length and the counts of the terms that the block's
items hold (the postings, a stored table). The document counts of these terms are added up from
it, and with them the weights, the only thing that a task gets beside its documents.

A task then multiplies matrices. Items are cut into tiles, each with a compact vocabulary of the
terms that its items hold; this is cut into tiles so narrow that a sum of weight times impact
stays below 2^53. An item tile's weights (items x terms) times the impacts of a tile of documents
(terms x documents), both float64, give sums that are exact, whatever order BLAS adds in; they are
added up in 64-bit integers. The best `k` of each item are kept by (score, id), so that ties are
cut at the smaller id. Each task returns at most `k` rows an item, and these are merged.

Defined results: a NULL or empty text has no term, and a document without a term is not counted.
Every row is a document of its own, also a repeated one. Documents without an id count and are
ranked, behind equal scores (the largest long stands for them, so that id is returned as NULL).
Items equal in id and text are one; rows of one id with other texts are ranked each for itself.
An item without a term, or with terms that no document has, gives no row. An empty table gives
no row. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import slices, stored

ITEM_TILE, TERM_TILE, DOC_TILE = 256, 4_096, 512
BLOCK_BYTES = 8 << 20
CHUNK = 4 << 20
EXACT = 1 << 53
IMPACT_UNIT = 1_000_000_000
MOST_IMPACT = IMPACT_UNIT // 1_000
NO_ID = np.iinfo(np.int64).max
# Bytes between terms become blanks and A-Z lower case; bytes of other characters stay.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_BLANK = re.compile(rb" ")


def term_counts(text: bytes) -> Counter:
    """The terms of a UTF-8 text with their counts. A long text is cut at blanks between terms."""
    data, counts, start = text.translate(_BYTES), Counter(), 0
    while start < len(data):
        stop = start + CHUNK
        edge = _BLANK.search(data, stop) if stop < len(data) else None
        stop = edge.start() if edge else len(data)
        counts.update(data[start:stop].split())
        start = stop
    return counts


def term_weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of a term that occurs `tf` times in a document of `n` terms."""
    m = 50 + 50 * n * n_docs // n_terms
    return IMPACT_UNIT * tf // (1000 * tf + 20 * m)


class Items:
    """A block of items: `ids`, the vocabulary, and each item's terms as numbers in it."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        own = [sorted(term_counts(text)) for _, text in rows]
        self.ids = [item_id for item_id, _ in rows]
        self.vocabulary = {term: k for k, term in enumerate(sorted({t for terms in own for t in terms}))}
        self.terms = [np.array([self.vocabulary[t] for t in terms], np.int64) for terms in own]


class Tile:
    """Some items with their compact vocabulary, cut into tiles of terms."""

    def __init__(self, first: int, terms: list[np.ndarray], weights: np.ndarray):
        self.first, self.size = first, len(terms)
        vocabulary = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.int64)
        heaviest = int(weights[vocabulary].max(initial=1)) or 1
        width = max(1, min(TERM_TILE, (EXACT - 1) // (heaviest * MOST_IMPACT)))
        self.parts = []
        for start in range(0, len(vocabulary), width):
            part = vocabulary[start : start + width]
            dense = np.zeros((len(terms), len(part)))
            for row, own in enumerate(terms):
                own = own[(own >= part[0]) & (own <= part[-1])]
                dense[row, np.searchsorted(part, own)] = weights[own]
            place = np.full(len(weights), -1, np.int32)
            place[part] = np.arange(len(part))
            self.parts.append((place, dense))

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores (items, documents) of a tile of documents, given by its postings."""
        total = np.zeros((self.size, n_docs), np.int64)
        for place, dense in self.parts:
            column = place[term]
            mine = column >= 0
            present, column = np.unique(column[mine], return_inverse=True)
            if len(present):
                tile = np.zeros((len(present), n_docs))
                tile[column, doc[mine]] = impact[mine]
                total += (dense[:, present] @ tile).astype(np.int64)
        return total


class Best:
    """The `k` best (score, id) of each item so far, larger scores and then smaller ids first."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.zeros(n_items, np.int64)
        self.floor_id = np.full(n_items, NO_ID)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        floor, floor_id = (x[first : first + len(scores), None] for x in (self.floor, self.floor_id))
        row, column = np.nonzero((scores > floor) | ((scores == floor) & (ids < floor_id) & (scores > 0)))
        if not len(row):
            return
        item = np.concatenate([self.item, row + first])
        score = np.concatenate([self.score, scores[row, column]])
        id_ = np.concatenate([self.id, ids[column]])
        order = np.lexsort((id_, -score, item))
        item, score, id_ = item[order], score[order], id_[order]
        start = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        nth = np.arange(len(item)) - np.repeat(start, np.diff(np.append(start, len(item))))
        kept = nth < self.k
        last = nth == self.k - 1
        self.floor[item[last]], self.floor_id[item[last]] = score[last], id_[last]
        self.item, self.score, self.id = item[kept], score[kept], id_[kept]


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The distinct items (item_id, text) in blocks of about `block_bytes`, one item at least."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = stored(rows.filter("text <> ''").distinct(), "items")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes)
    if blocks > 1:
        rows = stored(rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "item-blocks")
    for block in range(blocks):
        part = rows if blocks == 1 else rows.filter(F.col("block") == block)
        found = part.select("item_id", F.col("text").cast("binary").alias("text")).orderBy("item_id", "text").collect()
        if found:
            yield Items([(r["item_id"], bytes(r["text"])) for r in found])


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms and counts (of the vocabulary) of each document with a term."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value
        for batch in slices(batches):
            ids, sizes, terms, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = term_counts(text.as_py()) if text.is_valid else {}
                if not counts:
                    continue
                pairs = [(words[t], c) for t, c in counts.items() if t in words]
                ids.append(doc_id)
                sizes.append(counts.total())
                terms.append(np.array([p[0] for p in pairs], "<i4").tobytes())
                tfs.append(np.array([p[1] for p in pairs], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], ["doc_id", "n", "terms", "counts"])

    return rows.mapInArrow(cut, "doc_id long, n long, terms binary, counts binary")


def frequencies(kept: DataFrame, width: int) -> np.ndarray:
    """In how many documents each term is. A task sends each of its terms once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")
            total += np.bincount(found, minlength=width)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(total[term])], ["term", "n"])

    added = kept.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(width, np.int64)
    for term, n in added.collect():  # at most the vocabulary of a block
        out[term] = n
    return out


def ranked_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """item_id, rank, doc_id, score for a block of items."""
    kept = stored(postings(docs, items.vocabulary), "postings")
    n_docs, n_terms = kept.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = frequencies(kept, len(items.vocabulary))
    weights = np.array([term_weight(n_docs, int(x)) for x in df], np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((items.terms, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weight = shared.value
        tiles = [Tile(at, terms[at : at + ITEM_TILE], weight) for at in range(0, len(terms), ITEM_TILE)]
        best = Best(len(terms), k)
        for whole in batches:
            for start in range(0, whole.num_rows, DOC_TILE):
                batch = whole.slice(start, DOC_TILE)
                ids = batch.column(0).fill_null(int(NO_ID)).to_numpy()
                own = [np.frombuffer(x, "<i4") for x in batch.column(2).to_pylist()]
                doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
                tf = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i4").astype(np.int64)
                impact = impacts(tf, batch.column(1).to_numpy()[doc], n_docs, n_terms)
                term = np.concatenate(own)
                for tile in tiles:
                    best.add(tile.first, tile.scores(doc, term, impact, len(own)), ids)
        if len(best.item):
            doc_ids = pa.array(best.id, mask=best.id == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(best.item), doc_ids, pa.array(best.score)], ["item", "doc_id", "score"])

    found = kept.mapInArrow(score, "item long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    # A task's rows are cut to k an item again before the shuffle.
    first = found.withColumn("rank", place).filter(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), "item long, item_id long")
    return first.join(names, "item").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's `k` best documents."""
    out = None
    for block in item_blocks(items, block_bytes):
        rows = stored(ranked_block(docs, block, k), "ranked")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
