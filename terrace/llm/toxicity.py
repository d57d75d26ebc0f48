"""Toxicity: non-negative positive-unlabelled learning with numpy.

Training takes at most `max_toxic` confirmed toxic documents and at most `max_unlabelled`
documents whose labels are not looked at, all outside the held-out fold and chosen by a
hash of the id; of an id's rows one is taken. Features are words and their prefixes, hashed. Those frequent in the toxic
sample are candidates; those whose share there leads that in the unlabelled sample by some
standard errors are kept. A
linear model is trained on the class-prior-corrected risk

    prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic))

with the sigmoid loss; a batch whose second part falls below zero takes a step that raises
it. Two parameters then turn the margin into a probability by the unbiased logistic risk.
The class prior is the toxic share of the labelled training rows unless it is given.

Defined results: a NULL or empty text has no feature and gets the model's score for that.
Without a toxic training document every score is the prior (0 without labels). Repeated
rows are scored alike. Labels that are NULL or neither 0 nor 1 are not used. An empty table
gives no row. Other columns are not read by the scorer.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from terrace.llm.common import FILE_TEXTS, fresh, held_out, row_key, slices, stored, texts_of

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7, 8)
MAX_TOXIC, MAX_UNLABELLED = 8_000, 12_000
CACHED_WORDS = 400_000


def word_features(word: str) -> set[int]:
    """The word itself and its prefixes; a full word differs from an equal prefix."""
    return {zlib.crc32(f"{word}$".encode())} | {zlib.crc32(word[:n].encode()) for n in PREFIXES if len(word) >= n}


def text_words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


class Lookup:
    """Places of the wanted features in a text; the words met last are remembered."""

    def __init__(self, wanted: np.ndarray):
        self.place = {int(f): k for k, f in enumerate(wanted)}
        self.words: dict[str, tuple[int, ...]] = {}

    def places(self, text: str) -> list[int]:
        found: set[int] = set()
        for word in text_words(text):
            known = self.words.get(word)
            if known is None:
                if len(self.words) >= CACHED_WORDS:
                    self.words.clear()
                known = self.words[word] = tuple(self.place[f] for f in word_features(word) if f in self.place)
            if known:
                found.update(known)
        return sorted(found)


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))


def nnpu_weights(toxic: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 2_000, rate: float = 0.02, decay: float = 1e-4) -> np.ndarray:
    """Weights and, last, the bias. Rows are dense feature vectors. Every step takes the
    next 300 toxic and 500 unlabelled rows of shuffled rounds; the rate falls to zero."""
    random = np.random.default_rng(7)
    n = toxic.shape[1]
    weights, m1, m2 = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)

    def shuffled(rows: np.ndarray, size: int) -> Iterator[np.ndarray]:
        while True:
            order = random.permutation(len(rows))
            for k in range(0, len(rows), size):
                yield rows[order[k : k + size]]

    def slope(margin: np.ndarray, rows: np.ndarray, sign: int) -> np.ndarray:
        """Gradient of the mean sigmoid(sign * margin)."""
        s = sigmoid(margin)
        s = sign * s * (1 - s)
        return np.append(s @ rows, s.sum()) / len(rows)

    for step, xp, xu in zip(range(1, steps + 1), shuffled(toxic, 300), shuffled(unlabelled, 500)):
        mp, mu = xp @ weights[:-1] + weights[-1], xu @ weights[:-1] + weights[-1]
        negative = slope(mu, xu, 1) - prior * slope(mp, xp, 1)
        # R- of the non-toxic rows, as the difference of two means, must not be negative.
        if sigmoid(mu).mean() - prior * sigmoid(mp).mean() >= 0:
            gradient = prior * slope(mp, xp, -1) + negative
        else:
            gradient = -negative
        gradient[:-1] += decay * weights[:-1]
        m1 = 0.9 * m1 + 0.1 * gradient
        m2 = 0.999 * m2 + 0.001 * gradient**2
        weights -= rate * (1 - step / steps) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return weights


def calibration(toxic: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 300) -> tuple[float, float]:
    """Scale and shift of the margins by the unbiased logistic risk, which is convex:
    mean softplus(a * u + b) - prior * mean(a * p + b)."""
    spread = float(np.std(unlabelled)) or 1.0
    p, u = np.stack([toxic / spread, np.ones(len(toxic))]), np.stack([unlabelled / spread, np.ones(len(unlabelled))])
    w = np.zeros(2)
    for _ in range(rounds):
        s = 1 / (1 + np.exp(-np.clip(w @ u, -60, 60)))
        gradient = u @ s / u.shape[1] - prior * p.mean(1) + 1e-3 * w
        hessian = (u * (s * (1 - s))) @ u.T / u.shape[1] + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, np.abs(step).max())
    return max(w[0] / spread, 1e-6), w[1]


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, lookup: Lookup, texts: list[str]) -> np.ndarray:
        margin = np.array([self.weights[lookup.places(t)].sum() for t in texts]) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _sample(docs: DataFrame, labels: DataFrame, label: str, max_toxic: int, max_unlabelled: int) -> DataFrame:
    """doc_id, toxic: both samples' ids, at most max_toxic + max_unlabelled rows."""
    by_hash = (F.xxhash64("doc_id"), "doc_id")
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out("doc_id", FOLDS, HELD_OUT)).distinct()
    confirmed = labels.filter(F.col(label) == 1).select(F.col("doc_id").cast("long").alias("doc_id")).join(ids, "doc_id", "left_semi").distinct()
    toxic = confirmed.orderBy(*by_hash).limit(max_toxic).withColumn("toxic", F.lit(True))
    # Another hash, so that the unlabelled sample is drawn independently of the toxic one.
    unlabelled = ids.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(max_unlabelled).withColumn("toxic", F.lit(False))
    return toxic.unionByName(unlabelled)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", prior: float | None = None, max_toxic: int = MAX_TOXIC, max_unlabelled: int = MAX_UNLABELLED, candidates: int = 20_000, kept: int = 1_024, least_lead: float = 2.0) -> Model:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if prior is None:
        known = labels.filter(F.col(label).isin(0, 1) & ~held_out("doc_id", FOLDS, HELD_OUT))
        prior = known.agg(F.avg(F.col(label).cast("double"))).first()[0]
    flat = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(max(prior or 0, 1e-9) / max(1 - (prior or 0), 1e-9))))
    if not prior or prior >= 1:
        return flat
    # Bounded by the two sample sizes, so it may be broadcast.
    sample = F.broadcast(_sample(docs, labels, label, max_toxic, max_unlabelled))
    # An id may have many rows; the first by content stands for it, so that a sample has as
    # many rows as ids.
    one = F.min_by("text", row_key()).alias("text")
    sampled = stored(docs.join(sample, "doc_id").groupBy("doc_id", "toxic").agg(one).select("toxic", "text"), "toxicity-sample", max_toxic + max_unlabelled, FILE_TEXTS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in texts_of(batch):
                counts.update(set().union(*map(word_features, text_words(text))))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["feature", "n"])

    frequent = sampled.filter("toxic").mapInArrow(counted, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    frequent = frequent.filter("n >= 5").orderBy(F.desc("n"), "feature").limit(candidates).collect()
    if not frequent:
        return flat
    wanted = np.array([r[0] for r in frequent], np.int64)
    shared = spark.sparkContext.broadcast(wanted)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value)
        total, n = np.zeros((2, len(shared.value)), np.int64), np.zeros(2, np.int64)
        for batch in slices(batches):
            for toxic, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                total[int(toxic), lookup.places(text)] += 1
                n[int(toxic)] += 1
        rows = [(bool(c), int(n[c]), total[c].astype("<i8").tobytes()) for c in (0, 1) if n[c]]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.bool_(), pa.int64(), pa.binary()))], ["toxic", "n", "counts"])

    n, counts = {True: 0, False: 0}, {c: np.zeros(len(wanted), np.int64) for c in (True, False)}
    for toxic, own, held_by in sampled.mapInArrow(held, "toxic boolean, n long, counts binary").collect():  # two rows a task
        n[toxic] += own
        counts[toxic] += np.frombuffer(bytes(held_by), "<i8")
    if not n[True] or not n[False]:
        return flat
    shares = {c: counts[c] / n[c] for c in n}
    error = sum(np.maximum(shares[c] * (1 - shares[c]), 1 / n[c]) / n[c] for c in (True, False))
    lead = (shares[True] - shares[False]) / np.sqrt(error)
    order = np.argsort(-lead, kind="stable")[:kept]
    best = np.sort(order[lead[order] >= least_lead])
    if not len(best):
        return flat
    chosen = wanted[best]

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(chosen)
        for batch in slices(batches):
            places = [np.array(lookup.places(t), "<u2").tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, pa.binary())], ["toxic", "places"])

    # A row is two bytes for each of the kept features that it has. Sorted, as the training
    # takes them in turn.
    rows = sorted(sampled.mapInArrow(present, "toxic boolean, places binary").collect(), key=lambda r: bytes(r[1]))

    def dense(toxic: bool) -> np.ndarray:
        own = [np.frombuffer(bytes(r[1]), "<u2") for r in rows if r[0] is toxic]
        out = np.zeros((len(own), len(best)), np.float32)
        for k, x in enumerate(own):
            out[k, x] = 1
        return out

    toxic, unlabelled = dense(True), dense(False)
    weights = nnpu_weights(toxic, unlabelled, prior)
    scale, shift = calibration(toxic @ weights[:-1] + weights[-1], unlabelled @ weights[:-1] + weights[-1], prior)
    return Model(chosen, weights[:-1] * scale, float(weights[-1] * scale + shift))


def with_scores(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """All columns of the documents, and their score as column `name`."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.features)
        for batch in slices(batches):
            yield batch.append_column(name, pa.array(model.scores(lookup, texts_of(batch))))

    return docs.mapInArrow(score, StructType([*docs.schema, StructField(name, DoubleType())]))


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = with_scores(rows, train(docs, labels, label), "score").drop("text")
    return scored.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, label: str = "toxic") -> DataFrame:
    """The documents, all columns, whose score is below the threshold."""
    score = fresh(docs.columns, "score")
    return with_scores(docs, train(docs, labels, label), score).filter(F.col(score) < threshold).drop(score)
