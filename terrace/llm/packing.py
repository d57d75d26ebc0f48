"""Packing of token sequences: pattern packing by non-negative least squares.

Only the histogram of piece lengths (at most `limit` counts) comes to the driver. There
few-piece patterns are enumerated, their repeat counts are fitted to the histogram by
non-negative least squares and rounded down, and what is left over is packed best-fit by
length. The plan says for each length which sequences take its first, second, ... piece;
the pieces find their place by their rank among the pieces of their length.

Defined results: a NULL or empty text is one piece, the single end id. Repeated rows are
packed each for itself. A NULL id stays NULL. An empty table gives no row. Other columns
of the input are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import few_tasks, slices, stored, texts_of

LIMIT = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@functools.cache
def encoding(path: str):
    """The byte-level BPE of a rank file, with the added tokens of the JSON file of the same
    name, if there is one: `ids_of` gives the ids that the JSON file as loaded gives."""
    import base64
    import json
    import os

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    added = {}
    if os.path.exists(whole := f"{os.path.splitext(path)[0]}.json"):
        with open(whole, encoding="utf-8") as file:
            added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


@functools.cache
def json_encoding(path: str):
    """The tokenizer of the JSON file beside a rank file, as loaded; None if there is none."""
    import os

    from tokenizers import Tokenizer

    whole = f"{os.path.splitext(path)[0]}.json"
    return Tokenizer.from_file(whole) if os.path.exists(whole) else None


def ids_of(encoder, text: str, path: str | None = None) -> list[int]:
    """The text's ids; an added token that stands in the text is one id. The rank encoder gives
    up on runs of a million blanks; the JSON vocabulary beside `path` then takes the text."""
    try:
        return encoder.encode(text, allowed_special="all")
    except ValueError:
        whole = json_encoding(path) if path else None
        if whole is None:
            raise
        return whole.encode(text, add_special_tokens=False).ids


def default_vocabulary() -> str:
    """The ranks of byte_bpe_50k.json; a test checks that both give the same ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(n_ids: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all full but the first."""
    first = (n_ids - 1) % limit + 1
    return [(0, first), *((start, limit) for start in range(first, n_ids, limit))]


def token_pieces(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per piece of each document's ids and the end id."""
    path = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                ids = np.array([*ids_of(encoder, text, path), END_ID], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), limit)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [field.split()[0] for field in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, PIECES)


def patterns_of(counts: np.ndarray, limit: int, partners: int = 24) -> list[tuple[int, ...]]:
    """Combinations of two to four present lengths that nearly fill a sequence.

    Each length is completed by the best fitting length, directly and after one or two of
    `partners` lengths that stand for the histogram's quantiles."""
    present = np.flatnonzero(counts)
    present = present[(present > 0) & (present < limit)]
    if not len(present):
        return []
    weight = np.cumsum(counts[present])
    steps = np.searchsorted(weight, np.linspace(0, weight[-1], partners, endpoint=False), "right")
    chosen = sorted({int(present[min(s, len(present) - 1)]) for s in steps})
    found = set()
    for a in present.tolist():
        heads = [(a,), *((a, b) for b in chosen if a + b < limit)]
        heads += [(a, b, c) for i, b in enumerate(chosen[::3]) for c in chosen[::3][i:] if a + b + c < limit]
        for head in heads:
            room = limit - sum(head)
            k = int(np.searchsorted(present, room, "right")) - 1
            if k >= 0 and (len(head) == 1 or room - present[k] <= limit // 512):
                found.add(tuple(sorted((*head, int(present[k])), reverse=True)))
    return sorted(found, reverse=True)


def fitted_repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, sweeps: int = 12) -> list[int]:
    """Non-negative least squares of the patterns' lengths against the histogram by
    coordinate descent, rounded down so that no length is used more often than it occurs."""
    uses = [tuple((a, p.count(a)) for a in sorted(set(p))) for p in patterns]
    norms = [sum(n * n for _, n in use) for use in uses]
    left, repeats = counts.astype(float).tolist(), [0.0] * len(patterns)
    for _ in range(sweeps):
        for j, use in enumerate(uses):
            step = sum(n * left[a] for a, n in use) / norms[j]
            step = max(step, -repeats[j])
            if step:
                repeats[j] += step
                for a, n in use:
                    left[a] -= n * step
    free, whole = counts.astype(np.int64).tolist(), []
    for j in sorted(range(len(patterns)), key=lambda j: -repeats[j]):
        most = min(int(repeats[j] + 1e-6), min(free[a] // n for a, n in uses[j]))
        whole.append((j, most))
        for a, n in uses[j]:
            free[a] -= n * most
    return [n for _, n in sorted(whole)]


def best_fit(counts: np.ndarray, limit: int, open_bins: list[tuple[tuple[int, ...], int]]) -> list:
    """Best-fit decreasing by length. Sequences with equal contents are handled together."""
    by_room: dict[int, list[list]] = {}
    for pattern, n in open_bins:
        by_room.setdefault(limit - sum(pattern), []).append([pattern, n])
    for a in range(limit, 0, -1):
        left = int(counts[a]) if a < len(counts) else 0
        for room in sorted(r for r in by_room if r >= a):
            # Bins that take several pieces of this length take them at once.
            groups, by_room[room] = by_room[room], []
            for pattern, n in groups:
                fit = room // a
                full = min(n, left // fit)
                if full:
                    by_room.setdefault(room - fit * a, []).append([pattern + (a,) * fit, full])
                    left -= full * fit
                if full < n and left:
                    part = min(left, fit)
                    by_room.setdefault(room - part * a, []).append([pattern + (a,) * part, 1])
                    left -= part
                    full += 1
                if full < n:
                    by_room[room].append([pattern, n - full])
            if not left:
                break
        if left:
            fit = limit // a
            for n, k in ((left // fit, fit), (1, left % fit)):
                if n and k:
                    by_room.setdefault(limit - k * a, []).append([(a,) * k, n])
    return [(p, n) for groups in by_room.values() for p, n in groups if n]


def packing_plan(counts: np.ndarray, limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences); `counts` holds pieces by length."""
    counts = np.asarray(counts, np.int64).copy()
    full = [((limit,), int(counts[limit]))] if counts[limit] else []
    counts[limit] = 0
    patterns = patterns_of(counts, limit)
    repeats = fitted_repeats(patterns, counts)
    bins = [(p, n) for p, n in zip(patterns, repeats) if n]
    for pattern, n in bins:
        for a in pattern:
            counts[a] -= n
    return full + best_fit(counts, limit, bins)


def slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence and offset of each run of places."""
    runs: dict[int, list] = {}
    first = 0
    for pattern, n in plan:
        offset = 0
        for a in pattern:
            own = runs.setdefault(a, [])
            own.append((own[-1][3] if own else 0, first, offset, (own[-1][3] if own else 0) + n))
            offset += a
        first += n
    return {a: tuple(np.array(c, np.int64) for c in list(zip(*own))[:3]) for a, own in runs.items()}


def with_rank(pieces: DataFrame, n_rows: int, rows_per_bucket: int = 100_000) -> DataFrame:
    """`rank` from 0 within each length. A length may hold most rows, so it is numbered in
    buckets that start where the earlier ones end."""
    buckets = max(1, -(-n_rows // rows_per_bucket))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = rows.withColumn("rank", F.row_number().over(own) - 1)
    return numbered.join(starts, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("earlier"))


def pack(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Pieces with `sequence_id` and `offset`: gapless sequences of at most `limit` ids."""
    pieces = stored(token_pieces(docs, vocabulary, limit), "pieces")
    histogram = pieces.groupBy("length").count().collect()  # at most `limit` rows
    counts = np.zeros(limit + 1, np.int64)
    for length, n in histogram:
        counts[length] = n
    places = docs.sparkSession.sparkContext.broadcast(slots(packing_plan(counts, limit)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for a in np.unique(lengths).tolist():
                own = lengths == a
                first_rank, first_sequence, at = places.value[a]
                run = np.searchsorted(first_rank, ranks[own], "right") - 1
                sequence[own] = first_sequence[run] + ranks[own] - first_rank[run]
                offset[own] = at[run]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    ranked = with_rank(pieces, int(counts.sum())).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank")
    )
    return few_tasks(ranked, int(counts.sum())).mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
