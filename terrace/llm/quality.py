"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a short vector of transformed statistics. Labelled rows outside the
held-out fold give the count, sum and cross products of each class, added up by Spark.
Each class covariance is shrunk towards the pooled one and its diagonal; its Cholesky
factor is computed once and shipped. The score is the logistic of the prior log odds plus
the difference of the two log densities, the Mahalanobis terms by triangular solving.

Defined results: a NULL text has the statistics of an empty one. Repeated rows are scored
alike; repeated label rows count each. Labels that are NULL or neither 0 nor 1 are not
used. With fewer than two labelled rows of a class every score is the smoothed share of
label 1. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import held_out, slices, stored, texts_of

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
NAMES = (
    "words word_length word_spread upper digit mark symbol line_break repeat distinct short lines_distinct "
    "line_length capital"
).split()
UPPER, LOWER, DIGIT, SPACE, BREAK, MARK, SYMBOL = range(7)


def _classes() -> np.ndarray:
    """Class of each code point below 0x300; those above count as lower-case letters."""
    out = np.full(0x300, LOWER, np.uint8)
    for code in range(0x300):
        char = chr(code)
        if char == "\n":
            out[code] = BREAK
        elif char.isspace() or code < 32:
            out[code] = SPACE
        elif char.isdigit():
            out[code] = DIGIT
        elif char in ".,;:?'\"()-":
            out[code] = MARK
        elif char.isupper():
            out[code] = UPPER
        elif not char.isalpha():
            out[code] = SYMBOL
    return out


CLASSES = _classes()


def statistics(texts: list[str]) -> np.ndarray:
    """One row of transformed statistics per text."""
    sizes = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    kinds = np.where(codes < len(CLASSES), CLASSES[np.minimum(codes, len(CLASSES) - 1)], LOWER)
    counts = np.bincount(owner * 7 + kinds, minlength=7 * len(texts)).reshape(-1, 7)
    same = np.flatnonzero((codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1]) & (kinds[1:] != SPACE))
    repeats = np.bincount(owner[same], minlength=len(texts))
    out = np.empty((len(texts), len(NAMES)))
    for k, text in enumerate(texts):
        words, lines = text.split(), text.split("\n")
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1)
        out[k, 0] = np.log1p(n)
        out[k, 1] = np.log1p(lengths.mean())
        out[k, 2] = np.log1p(lengths.std())
        out[k, 9] = np.log1p(len(set(words))) / np.log(n + 2)
        out[k, 10] = (lengths <= 3).mean()
        out[k, 11] = len(set(lines)) / len(lines)
        out[k, 12] = np.log1p(n / len(lines))
        out[k, 13] = np.sqrt(sum(map(str.istitle, words)) / max(n, 1))
    share = counts / np.maximum(sizes, 1)[:, None]
    out[:, 3:8] = np.sqrt(share[:, [UPPER, DIGIT, MARK, SYMBOL, BREAK]])
    out[:, 8] = np.sqrt(repeats / np.maximum(sizes, 1))
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of the whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = statistics(texts_of(batch))
            starts = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(starts, pa.array(x.ravel()))], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Prior log odds and, per class, mean, inverse Cholesky factor and log determinant."""

    log_odds: float
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray

    @classmethod
    def of(cls, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = 0.1, ridge: float = 0.02):
        """`moments`: by class the count, sum and sum of outer products."""
        n = np.array([moments[c][0] if c in moments else 0.0 for c in (0, 1)])
        odds = float(np.log((n[1] + 1) / (n[0] + 1)))
        d = len(NAMES)
        if n.min() < 2:
            return cls(odds, np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2))
        means = np.stack([moments[c][1] / n[c] for c in (0, 1)])
        covariances = np.stack([moments[c][2] / n[c] - np.outer(means[c], means[c]) for c in (0, 1)])
        pooled = (n[:, None, None] * covariances).sum(0) / n.sum()
        # A statistic that never varies gets a small floor.
        floor = np.diag(np.maximum(np.diag(pooled), 1e-6))
        shrunk = (1 - shrinkage - ridge) * covariances + shrinkage * pooled + ridge * floor
        factors = np.linalg.cholesky(shrunk)
        log_dets = 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(1)
        return cls(odds, means, np.linalg.inv(factors), log_dets)

    def score(self, x: np.ndarray) -> np.ndarray:
        distance = [(((x - self.means[c]) @ self.factors[c].T) ** 2).sum(1) + self.log_dets[c] for c in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(self.log_odds + (distance[0] - distance[1]) / 2, -500, 500)))


def class_moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Of the rows (label, x): two small matrices, whatever the number of rows."""
    d = len(NAMES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            if batch.num_rows:
                labels = batch.column(0).to_numpy()
                x = batch.column(1).flatten().to_numpy().reshape(-1, d)
                for c in (0, 1):
                    own = x[labels == c]
                    total[c] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        label, entry = np.divmod(np.arange(total.size), total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(entry), pa.array(total.ravel())], ["label", "entry", "v"])

    parts = labelled.mapInArrow(partial, "label long, entry long, v double")
    total = np.zeros((2, 1 + d + d * d))
    for label, entry, v in parts.groupBy("label", "entry").agg(F.sum("v")).collect():
        total[label, entry] = v
    return {c: (total[c, 0], total[c, 1 : d + 1], total[c, d + 1 :].reshape(d, d)) for c in (0, 1) if total[c, 0]}


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = stored(with_statistics(docs), "quality").withColumn("held_out", held_out("doc_id", FOLDS, HELD_OUT))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1)")
    train = rows.filter("NOT held_out").join(known, "doc_id").select("label", "x")
    model = Discriminant.of(class_moments(train))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(model.score(x))], ["doc_id", "held_out", "score"])

    scored = rows.select("doc_id", "x", "held_out").mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
