"""MinHash near-dedup by improved consistent weighted sampling over TF-IDF shingles.

A text's words are `\\w+` runs, lower-cased; its shingles are five words in a row (all its
words, if fewer). A shingle weighs its count times 1 + IDF_SHARE * idf, idf being
log((1 + N) / (1 + df)) / log(1 + N). Document frequencies are counted over all texts in a
hashed table of fixed width; shingles that share an entry share the sum of their counts, in
sampling and in verification alike.

Texts with equal words are one class from the start. Each class draws BANDS * ROWS
consistent weighted samples; classes that agree in all samples of a band meet in a bucket.
In a bucket every member is paired with a leader, the one that meets most classes of other
groups over all bands. A pair counts if its weighted Jaccard similarity, computed from both
texts, is at least the threshold. Classes linked directly or over others are one group;
of the links a round finds only a spanning part is kept, and only that is labelled.
Further rounds take new leaders where a bucket still holds several groups. After them all
pairs of classes of different groups that are left in a bucket are looked at, block against
block, so every pair that meets in a bucket is in one group or has been tried: by its weights,
by its samples (a pair at the threshold has fewer agreeing ones than asked for once in 10^9),
and else by its texts.

Defined results: a text without a word is a group of its own. Repeated rows and equal texts
are one group. Rows without an id take part; a group's id is its smallest doc_id, NULL if
none has one. An empty table gives no row. Other columns are not read. A pair of texts must
fit in memory.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import FILE_TEXTS, ODD, code_points, code_values, few_tasks, mixed, powers, row_key, runs_of, slices, span_hashes, stored, texts_of
from terrace.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, LEADERS, ROUNDS = 12, 3, 1, 3
TABLE_BITS, IDF_SHARE = 20, 0.3
WORD_BASE, SHINGLE_BASE = 0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407
TEXT_BASES = (0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25)
NO_ID = -(1 << 63)
PAIRS_PER_TASK = 2_000
BLOCK, BLOCK_BYTES, MISSED = 1_024, 1 << 20, 1e-9


@functools.cache
def _in_word() -> np.ndarray:
    """Whether a code point belongs to a word, as `\\w` has it."""
    return np.fromiter((c == 95 or chr(c).isalnum() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


class Shingles:
    """Distinct shingles of many texts: owner (text number), hash and count, sorted; and a
    128-bit digest of each text's words, empty without a word."""

    def __init__(self, texts: list[str], with_digests: bool = True):
        lowered = [t.lower() for t in texts]
        codes = code_points("".join(f"{t}\n" for t in lowered))
        start, stop = runs_of(_in_word()[codes])
        hashes = span_hashes(code_values()[codes], start, stop, WORD_BASE)
        ends = np.cumsum([len(t) + 1 for t in lowered])
        last = np.searchsorted(start, ends)
        first = np.concatenate([[0], last[:-1]])
        sizes = last - first
        if with_digests:
            both = np.stack([span_hashes(hashes, first, last, base) ^ mixed(sizes.astype(np.uint64)) for base in TEXT_BASES], 1)
            data = both.astype("<u8").tobytes()
            self.digests = [data[16 * k : 16 * k + 16] if n else b"" for k, n in enumerate(sizes.tolist())]
        # Texts shorter than a shingle are filled up with a word that no text has.
        fill = np.maximum(SHINGLE - sizes, 0) * (sizes > 0)
        if fill.any():
            hashes = np.insert(hashes, np.repeat(last, fill), ODD)
            sizes = sizes + fill
        n = len(hashes) - SHINGLE + 1
        owner = np.repeat(np.arange(len(texts)), sizes)
        if n <= 0:
            self.owner, self.hash, self.count = (np.zeros(0, t) for t in (np.int64, np.uint64, np.int64))
            return
        rolled = np.zeros(n, np.uint64)
        for k, weight in enumerate(powers(SHINGLE_BASE, SHINGLE)):
            rolled += hashes[k : k + n] * weight
        whole = owner[:n] == owner[SHINGLE - 1 :]
        owner, rolled = owner[:n][whole], mixed(rolled[whole])
        order = np.argsort(rolled)
        # Owners are small numbers, which a stable radix sort puts in order.
        by_owner = owner[order].astype(np.uint16) if len(texts) <= 1 << 16 else owner[order]
        order = order[np.argsort(by_owner, kind="stable")]
        owner, rolled = owner[order], rolled[order]
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (rolled[1:] != rolled[:-1])]) if len(owner) else np.zeros(0, bool))
        self.owner, self.hash = owner[first], rolled[first]
        self.count = np.diff(np.append(first, len(owner)))

    def weights(self, idf: np.ndarray) -> np.ndarray:
        return self.count * idf[(self.hash >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]


def idf_table(frequency: np.ndarray, n_docs: int) -> np.ndarray:
    """Factor of each table entry, between 1 and 1 + IDF_SHARE."""
    if not n_docs:
        return np.ones(len(frequency))
    idf = np.log((1 + n_docs) / (1 + np.minimum(frequency, n_docs))) / np.log(1 + n_docs)
    return 1 + IDF_SHARE * idf


def document_frequencies(docs: DataFrame, parts: int = 64) -> tuple[np.ndarray, int]:
    """Counts per table entry over all texts, and the number of texts with a word. Each
    task sends its table once, cut into parts that are added up apart."""
    width = 1 << TABLE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = np.zeros(width, np.int64), 0
        for batch in slices(batches):
            own = Shingles(texts_of(batch), with_digests=False)
            table += np.bincount((own.hash >> np.uint64(64 - TABLE_BITS)).astype(np.int64), minlength=width)
            n += len(np.unique(own.owner))
        if n:
            rows = [(k, n if not k else 0, part.astype("<i8").tobytes()) for k, part in enumerate(np.split(table, parts))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], ["part", "n", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            for part, n, counts in zip(*(c.to_pylist() for c in batch.columns)):
                total[part] = total.get(part, 0) + np.frombuffer(counts, "<i8")
                sizes[part] = sizes.get(part, 0) + n
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([sizes[p] for p in total]), pa.array([total[p].astype("<i8").tobytes() for p in total], pa.binary())], ["part", "n", "counts"])

    schema = "part long, n long, counts binary"
    counted = docs.select("text").mapInArrow(count, schema)
    # First few tasks' tables together, then all of them: no task gets every table.
    half = counted.repartition("part", F.spark_partition_id() % 16).mapInArrow(add, schema)
    out, n = np.zeros((parts, width // parts), np.int64), 0
    # A few parts a task, however many partitions a shuffle has.
    for part, size, counts in half.repartition("part").coalesce(parts // 4).mapInArrow(add, schema).collect():
        out[part] += np.frombuffer(counts, "<i8")
        n += size
    return out.ravel(), n


@functools.cache
def _gamma_quantiles() -> tuple[np.ndarray, np.ndarray]:
    """65,536 quantiles of Gamma(2, 1), whose distribution is 1 - (1 + x) exp(-x), by
    bisection; and their logarithms."""
    share = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(1 << 16), np.full(1 << 16, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < share
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return low.astype(np.float32), np.log(low).astype(np.float32)


def samples(shingles: Shingles, weights: np.ndarray, n_texts: int) -> np.ndarray:
    """Sample hashes (texts, BANDS * ROWS) by improved consistent weighted sampling: of the
    shingles the one with the smallest ln a, together with its step t. r and c are drawn
    from Gamma(2, 1) by quantile, beta is uniform; all three from one hash."""
    out = np.zeros((n_texts, BANDS * ROWS), np.uint64)
    if not len(weights):
        return out
    first = np.flatnonzero(np.concatenate([[True], shingles.owner[1:] != shingles.owner[:-1]]))
    texts, sizes = shingles.owner[first], np.diff(np.append(first, len(weights)))
    log_weight = np.log(weights).astype(np.float32)
    gamma, log_gamma = _gamma_quantiles()
    for k in range(BANDS * ROWS):
        h = mixed(shingles.hash ^ np.uint64((2 * k + 1) * int(ODD) % (1 << 64)))
        r = gamma[h.astype(np.uint16)]
        log_c = log_gamma[(h >> np.uint64(16)).astype(np.uint16)]
        beta = (h >> np.uint64(40)).astype(np.float32)
        beta *= np.float32(2.0**-24)
        t = np.floor(log_weight / r + beta)
        # ln a = ln c - ln y - r, where ln y = r * (t - beta).
        log_c -= r * (t - beta + np.float32(1))
        hit = np.flatnonzero(log_c == np.repeat(np.minimum.reduceat(log_c, first), sizes))
        owner = shingles.owner[hit]
        hit = hit[np.concatenate([[True], owner[1:] != owner[:-1]])]
        out[texts, k] = mixed(shingles.hash[hit] ^ mixed(t[hit].astype(np.int64).view(np.uint64) + np.uint64(k)))
    return out


def signatures(docs: DataFrame, idf: Broadcast) -> DataFrame:
    """id, key, node (digest of the words; empty without a word), weight, bands, samples (16
    bits of each)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = Shingles(texts_of(batch))
            weights = own.weights(idf.value)
            drawn = samples(own, weights, batch.num_rows)
            data, size = drawn.astype("<u2").tobytes(), 2 * BANDS * ROWS
            short = [data[size * k : size * (k + 1)] for k in range(batch.num_rows)]
            drawn = drawn.reshape(-1, BANDS, ROWS)
            bands = np.zeros(drawn.shape[:2], np.uint64)
            for row in range(ROWS):
                bands = mixed(bands * ODD + drawn[:, :, row])
            starts = pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32())
            total = np.bincount(own.owner, weights, batch.num_rows).astype(float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own.digests, pa.binary()), pa.array(total), pa.ListArray.from_arrays(starts, pa.array(bands.view(np.int64).ravel())), pa.array(short, pa.binary())],
                ["id", "key", "node", "weight", "bands", "samples"],
            )

    return docs.mapInArrow(sign, "id long, key long, node binary, weight double, bands array<long>, samples binary")


def still_open(members: DataFrame) -> DataFrame:
    """The members (band, value, node, weight, label) of buckets with several labels, and how
    many `others` of other labels each meets there."""
    kinds = members.groupBy("band", "value", "label").agg(F.count("*").alias("own"))
    sizes = kinds.groupBy("band", "value").agg(F.sum("own").alias("size"), F.count("*").alias("labels")).filter("labels > 1")
    others = kinds.join(sizes, ["band", "value"]).select("band", "value", "label", (F.col("size") - F.col("own")).alias("others"))
    return members.join(others, ["band", "value", "label"]).select("band", "value", "node", "weight", "label", "others")


def leaders_of(members: DataFrame, turn: int) -> DataFrame:
    """band, value, leaders: the bucket is dealt into LEADERS parts, anew each turn, and of
    each part that member leads which meets most classes of other labels over all bands. The
    text that others were made from agrees with more of them than they do with each other."""
    nodes = members.groupBy("node").agg(
        F.any_value("weight").alias("weight"), F.any_value("label").alias("label"), F.sum("others").alias("met"), F.collect_list(F.struct("band", "value", "others")).alias("buckets")
    )
    scored = nodes.select("node", "weight", "label", "met", F.explode("buckets").alias("bucket")).select("bucket.*", "node", "weight", "label", "met")
    draw = F.xxhash64("node", "band", "value", F.lit(turn))
    best = F.struct("met", draw.alias("draw"), "node", "weight", "label", "others")
    drawn = [F.max(F.when(F.pmod(draw, F.lit(LEADERS)) == k, best)) for k in range(LEADERS)]
    return scored.groupBy("band", "value").agg(F.array_compact(F.array(*drawn)).alias("leaders"))


def leader_pairs(members: DataFrame, leaders: DataFrame, threshold: float) -> DataFrame:
    """(a, b, low, high, salt): each member b with the bucket's leaders a of other labels whose weight
    allows the threshold; low and high are the same two in order, which occur once. The others of
    a bucket are dealt out by salt so that over all bands about PAIRS_PER_TASK pairs at most have
    the same a and salt."""
    # A bucket may hold most classes: AQE splits that side of the join.
    pairs = members.join(leaders, ["band", "value"]).select("node", "weight", "label", F.explode("leaders").alias("leader"))
    near = F.least("weight", "leader.weight") >= F.lit(threshold - 1e-9) * F.greatest("weight", "leader.weight")
    pairs = pairs.filter((F.col("label") != F.col("leader.label")) & near)
    both = pairs.groupBy(F.least("node", "leader.node").alias("low"), F.greatest("node", "leader.node").alias("high"))
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("leader.others") * BANDS / PAIRS_PER_TASK)).cast("int")
    one = both.agg(F.min(F.struct("leader.node", salt.alias("salt"))).alias("one")).select(F.col("one.node").alias("a"), "low", "high", "one.salt")
    return one.select("a", F.when(F.col("a") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("b"), "low", "high", "salt")


def spanning(links: DataFrame, rows: int | None = None) -> DataFrame:
    """Links (a, b) that join what the given ones join, but fewer: each b is linked to the first
    of its a only, and that to the others. A b has at most a leader for each part of each of its
    buckets, and many b share them, so the links are about as many as the b, of which there are at most `rows`."""
    own = links.groupBy("b").agg(F.sort_array(F.collect_set("a")).alias("leaders"))
    # Both parts below read it: stored, the texts behind the links are compared once.
    own = stored(own, "linked", rows)
    first = F.element_at("leaders", 1)
    members = own.select(first.alias("a"), "b")
    leaders = own.filter(F.size("leaders") > 1).select(first.alias("a"), F.explode(F.slice("leaders", 2, BANDS * LEADERS)).alias("b")).distinct()
    # Leaders of one group are linked to each other in many ways; the same once more among them.
    leaders = stored(leaders, "leader-links", rows)
    least = leaders.groupBy("b").agg(F.min("a").alias("least"))
    others = leaders.join(least, "b").filter("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return members.unionByName(least.select(F.col("least").alias("a"), "b")).unionByName(others.distinct())


def relabelled(labels: DataFrame | None, links: DataFrame, rows: int | None = None) -> DataFrame:
    """node, label after further links: only they are looked at, between the groups so far. There
    are at most `rows` nodes, and links of about that number."""
    if labels is None:
        return components(links)
    for side in ("a", "b"):
        known = labels.select(F.col("node").alias(side), F.col("label").alias("group"))
        links = links.join(known, side, "left").withColumn(side, F.coalesce("group", side)).drop("group")
    merged = components(stored(links.filter("a <> b").distinct(), "group-links", rows))
    new = merged.select(F.col("node").alias("label"), F.col("label").alias("group"))
    moved = labels.join(new, "label", "left").select("node", F.coalesce("group", "label").alias("label"))
    return stored(moved.unionByName(merged.join(labels, "node", "left_anti")), "labels", rows)


def fewest_agreeing(threshold: float, n: int = BANDS * ROWS) -> int:
    """The most agreeing samples that can be asked for, so that a pair at the threshold has
    fewer with a probability of at most MISSED."""
    below = np.cumsum([math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in range(n + 1)])
    return int(np.searchsorted(below, MISSED, "right"))


def remaining_links(members: DataFrame, signed: DataFrame, texts: DataFrame, idf: Broadcast, threshold: float, n_rows: int | None = None) -> DataFrame:
    """Links (a, b) that join what all pairs of members of a bucket with different labels
    join. A large bucket is cut into blocks and each block meets each: no task gets a whole
    bucket, and pairs are compared where they meet instead of becoming rows. There are at most
    `n_rows` members."""
    least = fewest_agreeing(threshold)
    own = signed.select("node", "samples").join(members.select("node").distinct(), "node").dropDuplicates(["node"]).join(texts, "node")
    rows = members.select("band", "value", "node", "label").join(own, "node")
    rows = stored(rows, "remaining", n_rows, FILE_TEXTS)
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int")
    sizes = rows.groupBy("band", "value").agg(blocks.alias("blocks"))
    rows = rows.join(sizes, ["band", "value"]).withColumn("mine", F.pmod(F.xxhash64("node", "band"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("band", "value", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node", "label", "samples", "text")
    rows = rows.repartition("band", "value", "low", "high").sortWithinPartitions("band", "value", "low", "high")

    def linked(table: pa.Table) -> pa.RecordBatch:
        low, high, mine = (table[c].to_numpy() for c in ("low", "high", "mine"))
        left, right = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        # Classes of one group so far have one number; links join numbers.
        group = table["label"].combine_chunks().dictionary_encode().indices.to_numpy().copy()
        drawn = np.frombuffer(b"".join(table["samples"].to_pylist()), "<u2").reshape(len(table), -1).T.copy()
        shingles = Shingles(table["text"].to_pylist(), with_digests=False)
        weights = shingles.weights(idf.value)
        cuts = np.searchsorted(shingles.owner, np.arange(len(table) + 1))
        total = np.bincount(shingles.owner, weights, len(table))
        kinds, code = np.unique(shingles.hash, return_inverse=True)
        dense, a, b = np.zeros(len(kinds)), [], []
        for row in left.tolist():
            with_row = right[right > row] if low[0] == high[0] else right
            fits = group[with_row] != group[row]
            fits &= np.minimum(total[with_row], total[row]) >= (threshold - 1e-9) * np.maximum(total[with_row], total[row])
            with_row = with_row[fits]
            with_row = with_row[(drawn[:, with_row] == drawn[:, row, None]).sum(0) >= least]
            if not len(with_row):
                continue
            sizes = cuts[with_row + 1] - cuts[with_row]
            first = np.cumsum(sizes) - sizes
            entry = np.repeat(cuts[with_row] - first, sizes) + np.arange(sizes.sum())
            part = slice(cuts[row], cuts[row + 1])
            dense[code[part]] = weights[part]
            shared = np.add.reduceat(np.minimum(dense[code[entry]], weights[entry]), first)
            dense[code[part]] = 0
            near = shared >= (threshold - 1e-9) * (total[row] + total[with_row] - shared)
            for k in with_row[near].tolist():
                if group[k] != group[row]:
                    group[group == group[k]] = group[row]
                    a.append(row)
                    b.append(k)
        node = table["node"].combine_chunks()
        return pa.RecordBatch.from_arrays([node.take(pa.array(x, pa.int64())) for x in (a, b)], ["a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(4)], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for start, stop in zip(cuts, cuts[1:]):
                if held and at != tuple(key[start]):
                    yield linked(pa.Table.from_batches(held))
                    held = []
                at = tuple(key[start])
                held.append(batch.slice(start, stop - start))
        if held:
            yield linked(pa.Table.from_batches(held))

    return rows.mapInArrow(link, "a binary, b binary")


def verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast, threshold: float) -> DataFrame:
    """The pairs (a, b, salt) that reach the threshold, as (a, b). Texts (node, text) of all b of an
    a go to a's text, which is copied for each salt of its pairs."""
    own = pairs.select("a", "salt").distinct().select("a", "salt", F.col("a").alias("node"))
    rows = pairs.select("a", "salt", F.col("b").alias("node")).unionByName(own).join(texts, "node").select("a", "salt", "node", "text")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("node") != F.col("a"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, at = None, None
        for batch in slices(batches, most=1 << 19):
            shingles = Shingles(texts_of(batch), with_digests=False)
            weights = shingles.weights(idf.value)
            cuts = np.searchsorted(shingles.owner, np.arange(batch.num_rows + 1))
            found = []
            for k, (a, salt, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                part = slice(cuts[k], cuts[k + 1])
                hashes, own = shingles.hash[part], weights[part]
                if a == node:
                    leader, at = (hashes.copy(), own.copy(), own.sum()), (a, salt)
                elif at == (a, salt) and len(hashes):
                    place = np.minimum(np.searchsorted(leader[0], hashes), len(leader[0]) - 1)
                    both = leader[0][place] == hashes
                    shared = np.minimum(leader[1][place[both]], own[both]).sum()
                    if shared >= (threshold - 1e-9) * (leader[2] + own.sum() - shared):
                        found.append((a, node))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return rows.mapInArrow(compare, "a binary, b binary")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), row_key().alias("key"), "text")


def groups(docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """id, key, group of every row of `docs` (id, key, text); `group` is the digest of a
    text of the group, NULL for a text without a word."""
    frequency, n_docs = document_frequencies(docs)
    idf = docs.sparkSession.sparkContext.broadcast(idf_table(frequency, n_docs))
    signed = stored(signatures(docs, idf), "signatures")
    nodes = signed.filter(F.octet_length("node") > 0).groupBy("node").agg(
        F.min(F.struct("id", "key")).alias("one"), F.any_value("weight").alias("weight"), F.any_value("bands").alias("bands")
    )
    members = nodes.select("node", "one", "weight", F.posexplode("bands").alias("band", "value"))
    shared = members.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1").select("band", "value", (F.col("n") - 1).alias("others"))
    members = stored(members.join(shared, ["band", "value"]), "buckets", n_docs * BANDS)
    # All that follows is about these members: their leaders, pairs, links and labels are no more.
    n_rows = members.count()
    # The text of one document of each class that meets another one.
    ones = members.groupBy("node").agg(F.any_value("one").alias("one")).select("node", "one.*")
    texts = stored(docs.join(ones, ["id", "key"]).select("node", "text").dropDuplicates(["node"]), "class-texts", min(n_rows, n_docs), FILE_TEXTS)
    rest, tested, labels = members.drop("one").withColumn("label", F.col("node")), None, None
    for turn in range(rounds + 1):
        if not rest.limit(1).count():
            break
        if turn == rounds:
            left = rest.count()
            found = stored(remaining_links(rest, signed, texts, idf, threshold, left).distinct(), "verified", left)
        else:
            leaders = stored(leaders_of(rest, turn), "leaders", n_rows)
            pairs = leader_pairs(rest, leaders, threshold)
            pairs = stored(pairs.join(tested, ["low", "high"], "left_anti") if tested is not None else pairs, "pairs", n_rows)
            met = pairs.select("low", "high")
            tested = met if tested is None else tested.unionByName(met)
            found = stored(spanning(verified(pairs.select("a", "b", "salt"), texts, idf, threshold), n_rows), "links", n_rows)
        if found.limit(1).count():
            labels = relabelled(labels, found, n_rows)
        if turn < rounds:
            # Leaders have met their whole bucket.
            led = leaders.select("band", "value", F.explode("leaders.node").alias("node"))
            rest = rest.join(led, ["band", "value", "node"], "left_anti").drop("others")
            if labels is not None:
                rest = rest.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            rest = stored(still_open(stored(rest, "unled", n_rows)), "buckets", n_rows)
    node = F.when(F.octet_length("node") > 0, F.col("node"))
    rows = signed.select("id", "key", node.alias("node"))
    if labels is None:
        return rows.withColumnRenamed("node", "group")
    return rows.join(labels, "node", "left").select("id", "key", F.coalesce("label", "node").alias("group"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the group) of every document."""
    found = stored(groups(keyed(docs), threshold), "groups")
    rows = found.withColumn("doc_id", F.when(F.col("id") != NO_ID, F.col("id")))
    least = rows.filter("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("class_id"))
    joined = rows.join(least, "group", "left")
    joined = joined.select("doc_id", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return few_tasks(joined, found.count())


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, with one of each group: that with the smallest id."""
    found = stored(groups(keyed(docs), threshold), "groups")
    # Rows without an id stay behind those that have one.
    order = F.struct((F.col("id") == NO_ID).alias("none"), "id", "key")
    kept = found.filter("group IS NOT NULL").groupBy("group").agg(F.min(order).alias("one")).select("one.id", "one.key", F.lit(True).alias("grouped"))
    wordless = found.filter("group IS NULL").select("id", "key", F.lit(False).alias("grouped")).distinct()
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), row_key().alias("key"))
    joined = rows.join(kept.unionByName(wordless), ["id", "key"])
    # Rows equal in id and text are copies; texts without a word are not grouped.
    one = joined.filter("grouped").dropDuplicates(["id", "key"])
    rows = one.unionByName(joined.filter("NOT grouped")).select("row.*")
    return few_tasks(rows, found.count(), FILE_TEXTS)
