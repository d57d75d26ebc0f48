"""Removal of every byte covered by a long string that occurs elsewhere, by hash-compared
suffix sorting.

1. Every window of `length` bytes picks one of its `GRAM`-byte strings, the one with the
   smallest hash, as its anchor. Equal windows pick equal anchors at equal places, so only
   windows whose anchor occurs elsewhere can repeat. The windows of one anchor are a
   segment of neighbouring starts; about one anchor per 85 bytes is shuffled, as hashes.
2. Segments whose bytes repeat as a whole repeat window by window. One segment stands for
   all equal ones from here on, so that groups of copies weigh no more than one.
3. Where an anchor has different segments, their windows are compared as suffixes: those
   that agree in their first bytes are merge-sorted, each comparison finding the common
   extension by binary search over prefix polynomial hashes. Equal neighbours repeat and
   are verified byte by byte.
4. An anchor with more than `GROUP` different segments would not fit one task. Its windows
   are grouped by their bytes by Spark instead, which splits them over all tasks.

Segments are equal by 128 bits of hash (anchor and bytes); windows by their bytes.

Defined results: a NULL text is empty. Rows without an id are documents like others.
Repeated rows repeat each other. Matches never cross documents. An empty table gives no
row. Other columns are not read. A document must fit in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import mixed, power_tables, row_key, slices, stored

LENGTH = 200
GRAM = 32
GROUP = 20_000
# Bytes of text handled at a time; the arrays made of them take some hundred times as much.
CHUNK = 1 << 18
BASES = (0x9E6C63D0676A9A99, 0xD1342543DE82EF95)
NO_ID = -(1 << 63)
ANCHORS = "id long, key long, start int, n int, anchor long, segment long"
SPANS = "id long, key long, start long, stop long"


class PrefixHash:
    """Polynomial hashes of all parts of a buffer. `place` numbers the bytes from 0 anew
    in every part that hashes stay within, so that few powers are needed."""

    def __init__(self, data: np.ndarray, base: int = BASES[0], place: np.ndarray | None = None):
        most = len(data) if place is None else int(place.max(initial=0)) + 1
        power, self.inverse = power_tables(base, 1 << most.bit_length())
        self.place = place
        values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))[data]
        values *= power[: len(data)] if place is None else power[place]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values, out=self.sums[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        place = start if self.place is None else self.place[start]
        return (self.sums[start + size] - self.sums[start]) * self.inverse[place]


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[p : p + width] for every p that has one."""
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def segments_of(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document, start, windows, anchor hash, segment hash) of the documents that lie
    between `bounds` in `data`."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(data) < length:
        return none
    grams = mixed(PrefixHash(data).of(np.arange(len(data) - GRAM + 1), GRAM))
    # The place in the low half makes the first of equal hashes the smallest.
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    chosen = (sliding_minimum(ranked, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Windows must not reach into the next document.
    sizes = np.diff(bounds)
    last = np.repeat(bounds[1:], sizes)[: len(chosen)]
    start = np.flatnonzero(np.arange(len(chosen)) + length <= last)
    if not len(start):
        return none
    chosen = chosen[start]
    # A segment ends where the anchor or the document changes; anchors lie inside windows.
    first = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)]))
    n = np.diff(np.append(first, len(start)))
    start, at = start[first], chosen[first]
    layout = ((at - start) << 32 | n).astype(np.uint64)
    whole = mixed(PrefixHash(data, BASES[1]).of(start, n - 1 + length) ^ mixed(layout))
    document = np.searchsorted(bounds, start, "right") - 1
    return document, start - bounds[document], n, grams[at].view(np.int64), whole.view(np.int64)


def _buffer(batch: pa.RecordBatch, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the bounds of its rows; NULL is empty."""
    column = batch.column(place).fill_null("") if batch.column(place).null_count else batch.column(place)
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def anchors(docs: DataFrame, length: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=CHUNK):
            data, bounds = _buffer(batch, 2)
            document, start, n, anchor, segment = segments_of(data, bounds, length)
            take = pa.array(document)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(anchor), pa.array(segment)],
                ["id", "key", "start", "n", "anchor", "segment"],
            )

    return docs.mapInArrow(find, ANCHORS)


class SuffixSorter:
    """Sorts windows of a buffer that agree in their first bytes, by hashed comparison."""

    def __init__(self, data: np.ndarray, length: int, place: np.ndarray | None = None):
        self.data, self.length, self.hashes = data, length, PrefixHash(data, place=place)

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether window a sorts before window b (or is equal to it, where asked for)."""
        out = or_equal.copy()
        differ = np.flatnonzero(self.hashes.of(a, self.length) != self.hashes.of(b, self.length))
        if len(differ):
            a, b = a[differ], b[differ]
            # Common extension: the largest size at which the hashes agree.
            low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length)
            while (high - low > 1).any():
                middle = (low + high) // 2
                same = self.hashes.of(a, middle) == self.hashes.of(b, middle)
                low, high = np.where(same, middle, low), np.where(same, high, middle)
            out[differ] = self.data[a + low] < self.data[b + low]
        return out

    def merge_sorted(self, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The windows sorted within their buckets, which are neighbours in the input.
        Runs of 1, 2, 4, ... are merged in all buckets at once: a window's place is its
        place in its run plus the number of the other run's windows before it, which
        binary search finds."""
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        size = np.diff(np.append(first, len(bucket)))
        base, total = np.repeat(first, size), np.repeat(size, size)
        inside = np.arange(len(starts)) - base
        width = 1
        while width < size.max(initial=0):
            run = inside // width
            right = run % 2 == 1
            other = np.where(right, run - 1, run + 1) * width
            low = np.minimum(other, total)
            high = np.minimum(other + width, total)
            origin = low.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                before = self.less(starts[base[open_] + middle], starts[open_], right[open_])
                low[open_[before]] = middle[before] + 1
                high[open_[~before]] = middle[~before]
            place = np.where(right, inside - width, inside) + low - origin
            merged = np.empty_like(starts)
            merged[base + place] = starts
            starts, width = merged, width * 2
        return starts

    def _key(self, starts: np.ndarray, offset: int) -> np.ndarray:
        """Eight bytes from an offset, as a number that sorts like them."""
        out = np.zeros(len(starts), np.uint64)
        for k in range(offset, offset + 8):
            out = (out << np.uint64(8)) | self.data[starts + k]
        return out

    def repeated(self, starts: np.ndarray, most: int = 200_000) -> np.ndarray:
        """Which windows are equal to another one of them. Windows that agree in their first
        24 bytes are a bucket; buckets are sorted together up to `most` windows."""
        keys = [self._key(starts, k) for k in (0, 8, 16)]
        order = np.lexsort(keys[::-1])
        new = np.concatenate([[True], np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)])
        del keys
        bucket = np.cumsum(new)
        alone = np.bincount(bucket)[bucket] == 1
        order, bucket = order[~alone], bucket[~alone]
        out = np.zeros(len(starts), bool)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else bucket
        ends = np.append(first[1:], len(bucket))
        k = 0
        while k < len(first):
            stop = max(k + 1, int(np.searchsorted(ends, first[k] + most, "right")))
            part = slice(first[k], ends[stop - 1])
            out[order[part]] = self._repeated_in(starts[order[part]], bucket[part])
            k = stop
        return out

    def _repeated_in(self, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The same for whole buckets that are neighbours in the input."""
        suffixes = self.merge_sorted(starts, bucket)
        same = (bucket[1:] == bucket[:-1]) & (self.hashes.of(suffixes[1:], self.length) == self.hashes.of(suffixes[:-1], self.length))
        pairs = np.flatnonzero(same)
        window = np.arange(self.length)
        broken = set()
        for k in range(0, len(pairs), 8_192):
            part = pairs[k : k + 8_192]
            equal = (self.data[suffixes[part, None] + window] == self.data[suffixes[part + 1, None] + window]).all(1)
            broken.update(bucket[part[~equal]].tolist())
        hit = np.zeros(len(suffixes), bool)
        hit[1:] |= same
        hit[:-1] |= same
        for b in broken:
            # Two different windows with one hash: this bucket is compared by its bytes.
            own = np.flatnonzero(bucket == b)
            texts = [self.data[s : s + self.length].tobytes() for s in suffixes[own]]
            hit[own] = [texts.count(t) > 1 for t in texts]
        # Back to the order of the input: starts are unique.
        ordered = np.argsort(starts)
        out = np.zeros(len(starts), bool)
        out[ordered[np.searchsorted(starts[ordered], suffixes)]] = hit
        return out


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def compared(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows; rows (anchor, id, key, start, n, single, bytes) come
    sorted by anchor and are handled some whole anchors at a time."""

    def handled(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        rows = part["bytes"].to_pylist()
        data = np.frombuffer(b"".join(rows), np.uint8)
        begin = np.cumsum([0, *map(len, rows)])[:-1]
        n = part["n"].to_numpy().astype(np.int64)
        starts = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = np.arange(len(data)) - np.repeat(begin, n - 1 + length)
        flags = SuffixSorter(data, length, place).repeated(starts)
        # Neighbouring segments must not run together: a false flag between them.
        spaced = np.zeros(len(flags) + len(n), bool)
        owner = np.repeat(np.arange(len(n)), n)
        spaced[np.arange(len(flags)) + owner] = flags & np.repeat(part["single"].to_numpy(zero_copy_only=False), n)
        first, stop = spans_of(spaced)
        row = np.searchsorted(np.cumsum(n + 1), first, "right")
        shift = part["start"].to_numpy()[row] - (np.cumsum(n + 1) - n - 1)[row]
        take = pa.array(row)
        return pa.RecordBatch.from_arrays([part["id"].combine_chunks().take(take), part["key"].combine_chunks().take(take), pa.array(first + shift), pa.array(stop + shift - 1 + length)], ["id", "key", "start", "stop"])

    kept, size = [], 0
    for batch in batches:
        kept.append(batch)
        size += batch.column(6).nbytes
        while size >= CHUNK:
            table = pa.Table.from_batches(kept)
            anchor = table["anchor"].to_numpy()
            whole = int(np.searchsorted(anchor, anchor[-1])) if (np.diff(anchor) >= 0).all() else 0
            if not whole:
                break
            # Whole anchors of about CHUNK bytes at a time; the last one may go on.
            total = np.cumsum(pa.compute.binary_length(table["bytes"]).to_numpy())
            cut = min(int(np.searchsorted(total, CHUNK)) + 1, whole)
            cut = int(np.searchsorted(anchor, anchor[cut - 1], "right"))
            cut = min(cut, whole)
            yield handled(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks()
            kept, size = rest.to_batches(), int(total[-1] - total[cut - 1])
    if kept and sum(b.num_rows for b in kept):
        yield handled(pa.Table.from_batches(kept))


def _hot_spans(segments: DataFrame, length: int) -> DataFrame:
    """The same for anchors with many segments: windows grouped by their bytes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                n = part.column(4).to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(n)), n)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                texts = part.column(6).to_pylist()
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([texts[r][p : p + length] for r, p in zip(row.tolist(), place.tolist())], pa.binary()),
                        part.column(1).take(take),
                        part.column(2).take(take),
                        pa.array(part.column(3).to_numpy()[row] + place),
                        part.column(5).take(take),
                    ],
                    ["window", "id", "key", "start", "single"],
                )

    rows = segments.mapInArrow(windows, "window binary, id long, key long, start long, single boolean")
    again = rows.groupBy("window").agg(F.count("*").alias("copies")).filter("copies > 1").select("window")
    hit = rows.filter("single").join(again, "window", "left_semi")
    return hit.select("id", "key", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """id, key, start, stop of parts of `docs` (id, key, text) that occur elsewhere; parts
    may overlap."""
    found = stored(anchors(docs, length), "anchors")
    # A row per anchor and task at most is shuffled, however hot the anchor.
    met = found.groupBy("anchor").agg(F.count("*").alias("times"), F.min("segment").alias("least"), F.max("segment").alias("most"))
    met = met.filter("times > 1").select("anchor", (F.col("least") != F.col("most")).alias("differ"))
    shared = stored(found.join(met, "anchor"), "shared-anchors")
    stop = (F.col("start") + F.col("n") - 1 + length).cast("long").alias("stop")
    span = ("id", "key", F.col("start").cast("long").alias("start"), stop)
    same = shared.filter("NOT differ").select(*span)
    mixed_ = shared.filter("differ")
    kinds = mixed_.groupBy("anchor", "segment").agg(F.count("*").alias("times"), F.min(F.struct("id", "key", "start", "n")).alias("one"))
    kinds = stored(kinds, "segments")
    copies = mixed_.join(kinds.filter("times > 1").select("anchor", "segment"), ["anchor", "segment"], "left_semi").select(*span)
    # The bytes of one segment of each kind, cut from the documents.
    sizes = kinds.groupBy("anchor").agg(F.count("*").alias("group_size"))
    wanted = kinds.join(sizes, "anchor").select("one.*", "anchor", (F.col("times") == 1).alias("single"), (F.col("group_size") > group).alias("hot"))
    wanted = wanted.groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "start", "n", "single", "hot")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=CHUNK):
            data, bounds = _buffer(batch, 2)
            asked = batch.column(3)
            flat, owner = asked.flatten(), np.repeat(np.arange(batch.num_rows), asked.value_lengths().to_numpy(zero_copy_only=False))
            start, n = flat.field(1).to_numpy(), flat.field(2).to_numpy()
            first = bounds[owner] + start
            texts = [data[a : a + s].tobytes() for a, s in zip(first.tolist(), (n - 1 + length).tolist())]
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [flat.field(0), batch.column(0).take(take), batch.column(1).take(take), flat.field(1), flat.field(2), flat.field(3), pa.array(texts, pa.binary()), flat.field(4)],
                ["anchor", "id", "key", "start", "n", "single", "bytes", "hot"],
            )

    # Rows equal in id and text give their segments twice, but no segment of theirs is single.
    schema = "anchor long, id long, key long, start int, n int, single boolean, bytes binary, hot boolean"
    segments = docs.join(wanted, ["id", "key"]).select("id", "key", "text", "wanted").mapInArrow(cut, schema)
    parts = segments.filter("NOT hot").drop("hot").repartition("anchor").sortWithinPartitions("anchor")
    spans = same.unionByName(copies).unionByName(parts.mapInArrow(lambda batches: compared(batches, length), SPANS))
    if sizes.filter(F.col("group_size") > group).limit(1).count():
        spans = spans.unionByName(_hot_spans(segments.filter("hot").drop("hot"), length))
    return spans


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, spans (start, stop of the maximal removed parts) and kept, the
    remaining bytes concatenated."""
    # The same rows are shuffled by id for their segments and for their spans: Spark reuses
    # the one exchange, as both joins stand in one plan.
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), row_key().alias("key"), "text")
    spans = repeated_spans(rows, length).groupBy("id", "key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = rows.join(spans, ["id", "key"], "left").select("id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=CHUNK):
            data, bounds = _buffer(batch, 1)
            kept, spans = [], []
            for k, own in enumerate(batch.column(2)):
                text = data[bounds[k] : bounds[k + 1]]
                change = np.zeros(len(text) + 1, np.int64)
                if own.is_valid:
                    np.add.at(change, own.values.field(0).to_numpy(), 1)
                    np.add.at(change, own.values.field(1).to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                first, stop = spans_of(gone)
                spans.append([{"start": a, "stop": b} for a, b in zip(first.tolist(), stop.tolist())])
                kept.append(text[~gone].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), pa.array(spans, kind), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    out = joined.mapInArrow(cut, "id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_bytes", "spans", "kept")
