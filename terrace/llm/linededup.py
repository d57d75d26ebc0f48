"""Line dedup: documents probe a sharded minimal perfect hash of all long lines.

Every line of at least `min_chars` becomes a 128-bit hash of its key. All distinct hashes are
indexed: each shard holds a minimal perfect hash over its hashes (levels of bit arrays; a hash
that is alone on its bit is placed, the others go to the next level) and, in the order of that
hash, arrays of 64-bit fingerprints, document counts and largest ids. The line hashes of the
documents are routed to the shards' arrays, where the stored count says whether a line is repeated
and the stored id whether this document keeps it; texts are not moved. A shard is copied so
often that no task gets more than about `probes_per_task` probes: a hot line costs copies of its
own shard only.

Defined results: a NULL or empty text is one empty line and becomes the empty text. Rows of one
id are one document: they count once, and all of them keep a line if theirs is the largest id.
A row without id counts as no document; it loses a repeated line unless no holder has an id.
Other columns are passed on as they are. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from terrace.llm.common import FILE_TEXTS, ODD, few_tasks, mixed, row_key, slices, stored, texts_of

BLANKS = " \t\n\v\f\r"
NO_ID = -(1 << 63)
LINES = "id long, key long, line int, first boolean, h1 long, h2 long"
INDEX = "shard int, sizes binary, bits binary, prints binary, counts binary, last binary"


def line_key(line: str) -> str:
    """Blanks stripped at both ends, A-Z lower-cased."""
    line = line.strip(BLANKS)
    return line.encode().lower().decode() if not line.isascii() else line.lower()


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per long line; `first` marks a key's first line within its document."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, keys, lines, first, digests = [], [], [], [], []
            for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch)):
                seen = set()
                for k, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(own := line_key(line)) >= min_chars:
                        digest = xxhash.xxh3_128_digest(own.encode())
                        ids.append(doc_id)
                        keys.append(key)
                        lines.append(k)
                        first.append(digest not in seen)
                        seen.add(digest)
                        digests.append(digest)
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(lines, pa.int32()),
                    pa.array(first, pa.bool_()),
                    pa.array(both[:, 0].copy()),
                    pa.array(both[:, 1].copy()),
                ],
                ["id", "key", "line", "first", "h1", "h2"],
            )

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), row_key().alias("key"), "text")
    return rows.mapInArrow(hashes, LINES)


class PerfectHash:
    """Places of distinct 128-bit hashes, 0 to n - 1; arrays only."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.ranks = np.cumsum(bits) - 1

    @staticmethod
    def spots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * int(ODD) % (1 << 64))
        return (mixed(h1 ^ mixed(h2 + salt)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray, spread: float = 1.5) -> PerfectHash:
        sizes, bits = [], []
        while len(h1):
            size = max(int(len(h1) * spread), 8)
            spot = cls.spots(h1, h2, len(sizes), size)
            alone = np.bincount(spot, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = ~alone[spot]
            h1, h2 = h1[left], h2[left]
        return cls(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool))

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The place of a hash of the set; of any other hash some place, or -1."""
        out = np.full(len(h1), -1, np.int64)
        open_ = np.arange(len(h1))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            spot = self.starts[level] + self.spots(h1[open_], h2[open_], level, size)
            hit = self.bits[spot]
            out[open_[hit]] = self.ranks[spot[hit]]
            open_ = open_[~hit]
        return out


def index_shard(rows: pa.Table) -> pa.Table:
    """The arrays of one shard."""
    h1, h2 = (rows[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    table = PerfectHash.of(h1, h2)
    place = np.argsort(table.places(h1, h2))
    arrays = [
        table.sizes.tobytes(),
        np.packbits(table.bits).tobytes(),
        h2[place].tobytes(),
        rows["n_docs"].to_numpy()[place].tobytes(),
        rows["last"].to_numpy()[place].tobytes(),
    ]
    names = ["shard", "sizes", "bits", "prints", "counts", "last"]
    return pa.Table.from_arrays([rows["shard"][:1].combine_chunks(), *(pa.array([a], pa.binary()) for a in arrays)], names)


def answers(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Each shard's arrays, followed by the probes sent to it; yields the lines that go."""
    at, table = None, None
    for batch in batches:
        shards, salts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        probe = ~np.asarray(batch.column(2).is_valid())
        cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(salts) != 0) | (np.diff(probe) != 0)) + 1
        out = []
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if start == stop:
                continue
            part = batch.slice(start, stop - start)
            if not probe[start]:
                sizes, bits, prints, counts, last = (np.frombuffer(part.column(k)[0].as_py(), t) for k, t in zip(range(2, 7), ("i8", "u1", "u8", "i8", "i8")))
                table = PerfectHash(sizes, np.unpackbits(bits, count=int(sizes.sum())).astype(bool))
                at = (shards[start], salts[start])
            elif at == (shards[start], salts[start]):
                h1, h2 = (part.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in (10, 11))
                place = table.places(h1, h2)
                hit = place >= 0
                hit[hit] = prints[place[hit]] == h2[hit]
                hit[hit] = counts[place[hit]] >= min_docs
                hit[hit] = last[place[hit]] != part.column(7).to_numpy(zero_copy_only=False)[hit]
                out.append(part.select([7, 8, 9]).filter(pa.array(hit)))
        yield from out


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, keys_per_shard: int = 50_000, probes_per_task: int = 100_000) -> DataFrame:
    """id, key, lines: the numbers of the lines that each document loses."""
    lines = stored(line_hashes(docs, min_chars), "lines")
    documents = F.count_distinct(F.when(F.col("id") != NO_ID, F.col("id"))).alias("n_docs")
    keys = stored(lines.filter("first").groupBy("h1", "h2").agg(documents, F.max("id").alias("last")), "line-keys", lines.count())
    shards = max(1, -(-keys.count() // keys_per_shard))
    shard = F.pmod(F.xxhash64("h1"), F.lit(shards)).cast("int").alias("shard")
    copies = lines.groupBy(shard).agg(F.ceil(F.count("*") / probes_per_task).cast("int").alias("copies"))
    copies = stored(copies, "shard-copies", shards)
    index = keys.withColumn("shard", shard).groupBy("shard").applyInArrow(index_shard, INDEX).join(copies, "shard")
    index = index.select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), "sizes", "bits", "prints", "counts", "last")
    # The salt goes by the row number of the line, its document and its hash, so it spreads
    # one hot line over all copies.
    probes = lines.withColumn("shard", shard).join(copies, "shard")
    probes = probes.select("shard", F.pmod(F.xxhash64("id", "key", "line"), F.col("copies")).cast("int").alias("salt"), "id", "key", "line", "h1", "h2")
    routed = index.unionByName(probes, allowMissingColumns=True).repartition("shard", "salt")
    routed = routed.sortWithinPartitions("shard", "salt", F.col("sizes").isNull())
    gone = routed.mapInArrow(lambda batches: answers(batches, min_docs), "id long, key long, line int")
    return gone.groupBy("id", "key").agg(F.collect_set("line").alias("lines"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with the text that stays, and `n_lines` (before) and `n_dropped`.

    A key of at least `min_chars` found in at least `min_docs` documents stays only in the
    document with the largest id that holds it."""
    names = docs.columns
    gone = repeated_lines(docs, min_chars, min_docs)
    # Own names, as the input may have columns of any name.
    own = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    rows = docs.select(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), row_key().alias("key"))
    joined = rows.join(gone, ["id", "key"], "left").select("row", "lines")
    joined = few_tasks(joined, docs.count(), FILE_TEXTS)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "row.text"):
            texts, n_lines, n_dropped = [], [], []
            for text, lost in zip(texts_of(batch, "row.text"), batch.column(1).to_pylist()):
                lines = text.split("\n")
                lost = set(lost or ())
                n_lines.append(len(lines))
                n_dropped.append(len(lost))
                texts.append("\n".join(x for k, x in enumerate(lines) if k not in lost) if lost else text)
            row = batch.column(0)
            columns = [pa.array(texts, pa.string()) if c == "text" else row.field(c) for c in names]
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, names), pa.array(n_lines), pa.array(n_dropped)], ["row", "n_lines", "n_dropped"])

    schema = StructType().add("row", docs.schema).add("n_lines", LongType()).add("n_dropped", LongType())
    done = joined.mapInArrow(kept, schema)
    taken = {"n_lines", "n_dropped"}
    return done.select(*(F.col(f"row.`{c}`").alias(c) for c in names if c not in taken), "n_lines", "n_dropped")
