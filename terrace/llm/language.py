"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, found by the forward
algorithm; a text's is the product over its words, which share no piece. The probabilities
are fitted by expectation-maximisation over the counts of all words of the training texts:
the forward-backward algorithm spreads each word's count over its segmentations.

Words are runs of letters, lower-cased; runs of over `LONGEST` letters are scored as
consecutive parts. Words are found and told apart by 64-bit hashes, a slice of texts at a
time. A letter that no piece covers is one unknown piece.

Defined results: a NULL text or one without a letter is `und` with score 0, as is every
text when nothing could be learned. Rows without a language or id are scored but not
learned from. Repeated rows count each. An empty table gives no row. Other columns are not
read. The number of languages times the vocabulary must fit the driver.
"""

from __future__ import annotations

import functools
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import code_points, code_values, held_out, mixed, runs_of, slices, span_hashes, stored, texts_of

FOLDS, HELD_OUT = 4, 2
WORD_BASE = 0xB5297A4D3C2F1E67
LONGEST = 24
FLOOR = 1e-12
CACHED = 400_000
START = "▁"
CODE_BITS = 21


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Trie:
    """The vocabulary's lower-case letter pieces. `keys` are the sorted transitions
    (node << CODE_BITS | code point) to `nodes`; `piece` is a node's piece or -1. The number
    of pieces also stands for the unknown one."""

    keys: np.ndarray
    nodes: np.ndarray
    piece: np.ndarray
    unknown: int

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next node, or -1."""
        key = node << CODE_BITS | code
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nodes[at], -1)


@functools.cache
def pieces(path: str) -> Trie:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    known = [p for p in known if p == START or (p.removeprefix(START).isalpha() and p == p.lower())]
    node_of, piece = {"": 0}, [-1]
    moves = {}
    for number, text in enumerate(known):
        for n in range(1, len(text) + 1):
            if text[:n] not in node_of:
                node_of[text[:n]] = len(piece)
                piece.append(-1)
                moves[node_of[text[: n - 1]] << CODE_BITS | ord(text[n - 1])] = node_of[text[:n]]
        piece[node_of[text]] = number
    keys = np.array(sorted(moves), np.int64)
    return Trie(keys, np.array([moves[k] for k in keys.tolist()]), np.array(piece), len(known))


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@dataclass
class Words:
    """The words of many texts: owner (text number), start, stop and hash, in order."""

    joined: str
    codes: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        lowered = [f"{t.lower()}\n" for t in texts]
        joined = "".join(lowered)
        codes = code_points(joined)
        start, stop = runs_of(_letters()[codes])
        owner = np.searchsorted(np.cumsum([len(t) for t in lowered]), start, "right")
        parts = -(-(stop - start) // LONGEST)
        if (parts > 1).any():
            inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            owner = np.repeat(owner, parts)
            start = np.repeat(start, parts) + inside * LONGEST
            stop = np.minimum(start + LONGEST, np.repeat(stop, parts))
        return cls(joined, codes, owner, start, stop, span_hashes(code_values()[codes], start, stop, WORD_BASE))

    def letters(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code points of some words one after another, and their lengths."""
        sizes = (self.stop - self.start)[which]
        at = np.repeat(self.start[which] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return self.codes[at], sizes


class Lattice:
    """All segmentations of many words: arcs (word, start, end, piece). The places of all
    words walk the trie together, one letter at a time. Words are given by their letters,
    one after another, and sizes."""

    @classmethod
    def of(cls, words: list[str], trie: Trie) -> Lattice:
        return cls(code_points("".join(words)), np.fromiter(map(len, words), np.int64, len(words)), trie)

    def __init__(self, letters: np.ndarray, sizes: np.ndarray, trie: Trie):
        self.n_words = len(sizes)
        self.lengths = sizes + 1
        word = np.repeat(np.arange(self.n_words), self.lengths)
        inside = np.arange(len(word)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        codes = np.full(len(word), ord(START), np.int64)
        codes[inside > 0] = letters
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        starts, ends, found = [], [], []
        for size in range(1, LONGEST + 2):
            node = trie.step(node, codes[at + size - 1])
            piece = trie.piece[node]
            piece[node < 0] = -1
            if size == 1:
                # Every letter is at least the unknown piece.
                piece[piece < 0] = trie.unknown
            hit = piece >= 0
            starts.append(at[hit])
            ends.append(inside[at[hit]] + size)
            found.append(piece[hit])
            go = (node >= 0) & (inside[at] + size < self.lengths[word[at]])
            at, node = at[go], node[go]
            if not len(at):
                break
        at = np.concatenate(starts)
        # Sorted by word; the sorts by position below keep that order.
        word = word[at]
        order = np.argsort(word.astype(np.uint16) if self.n_words <= 1 << 16 else word, kind="stable")
        at, self.word = at[order], word[order]
        self.start = inside[at]
        self.end, self.piece = np.concatenate(ends)[order], np.concatenate(found)[order]

    def _sums(self, near: np.ndarray, far: np.ndarray, out: np.ndarray, p: np.ndarray, backward: bool = False) -> np.ndarray:
        """Adds up `out` (positions * words, k) over the arcs, from place `far` to `near`."""
        order = np.argsort(near.astype(np.uint8), kind="stable")
        cuts = np.searchsorted(near[order], np.arange(LONGEST + 3))
        groups = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:]) if a < b]
        for arcs in groups[::-1] if backward else groups:
            words = self.word[arcs]
            first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            values = out.take(far[arcs] * self.n_words + words, axis=0) * p.take(arcs, axis=0)
            out[near[arcs[0]] * self.n_words + words[first]] = np.add.reduceat(values, first, axis=0)
        return out

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums (positions * words, k) over the ways from the start; `p` is (arcs, k)."""
        alpha = np.zeros(((LONGEST + 2) * self.n_words, p.shape[1]))
        alpha[: self.n_words] = 1
        return self._sums(self.end, self.start, alpha, p)

    def backward(self, p: np.ndarray) -> np.ndarray:
        beta = np.zeros(((LONGEST + 2) * self.n_words, p.shape[1]))
        beta[self._last()] = 1
        return self._sums(self.start, self.end, beta, p, backward=True)

    def _last(self) -> np.ndarray:
        return self.lengths * self.n_words + np.arange(self.n_words)

    def log_totals(self, probabilities: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language; `probabilities` is (languages, pieces)."""
        return np.log(self.forward(probabilities.T.take(self.piece, axis=0))[self._last()])

    def expected(self, probabilities: np.ndarray, language: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses (languages, pieces) when word w occurs counts[w] times in language[w]."""
        p = probabilities[language[self.word], self.piece][:, None]
        alpha, beta = self.forward(p)[:, 0], self.backward(p)[:, 0]
        total = alpha[self._last()]
        use = alpha[self.start * self.n_words + self.word] * p[:, 0] * beta[self.end * self.n_words + self.word]
        use *= (counts / total)[self.word]
        width = probabilities.shape[1]
        return np.bincount(language[self.word] * width + self.piece, use, probabilities.size).reshape(probabilities.shape)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over whole texts; tasks add up what they have read before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            langs, words = zip(*counts) if counts else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])

        for batch in slices(batches):
            words = Words.of(texts_of(batch))
            langs, of_text = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
            own = of_text[words.owner]
            apart = words.hash ^ mixed(own.astype(np.uint64))
            _, first, n = np.unique(apart, return_index=True, return_counts=True)
            for lang, a, b, times in zip(own[first].tolist(), words.start[first].tolist(), words.stop[first].tolist(), n.tolist()):
                counts[langs[lang], words.joined[a:b]] += times
            if len(counts) > CACHED:
                yield rows()
                counts.clear()
        yield rows()

    return docs.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    vocabulary: str
    languages: list[str]
    log_prior: np.ndarray
    probabilities: np.ndarray


def train(docs: DataFrame, vocabulary: str | None = None, rounds: int = 2, smoothing: float = 0.1) -> Model:
    """Learns from doc_id, text and lang of the rows outside the held-out fold."""
    path = vocabulary or default_vocabulary()
    unknown = pieces(path).unknown
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", FOLDS, HELD_OUT))
    languages, sizes = zip(*known.groupBy("lang").count().orderBy("lang").collect()) if known.limit(1).count() else ((), ())
    place = {lang: k for k, lang in enumerate(languages)}
    probabilities = np.full((len(languages), unknown + 1), 1 / (unknown + 1))
    if languages:
        words = stored(word_counts(known), "words")
    for _ in range(rounds if languages else 0):
        shared = docs.sparkSession.sparkContext.broadcast(probabilities)

        def expected(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shared.value.shape)
            for batch in batches:
                for start in range(0, batch.num_rows, 20_000):
                    part = batch.slice(start, 20_000)
                    language = np.array([place[x] for x in part.column(0).to_pylist()])
                    total += Lattice.of(part.column(1).to_pylist(), pieces(path)).expected(shared.value, language, part.column(2).to_numpy())
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "n"])

        total = np.zeros(probabilities.size)
        for at, n in words.mapInArrow(expected, "at long, n double").groupBy("at").agg(F.sum("n")).collect():
            total[at] = n
        total = total.reshape(probabilities.shape) + smoothing
        probabilities = np.maximum(total / total.sum(1, keepdims=True), FLOOR)
    sizes = np.array(sizes, float)
    return Model(path, list(languages), np.log(sizes / sizes.sum()), probabilities)


class Scorer:
    """Log probabilities of words by language; the words met last are remembered, as sorted
    hashes and a row for each."""

    def __init__(self, model: Model):
        self.model, self.trie = model, pieces(model.vocabulary)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.table = np.zeros((0, len(self.model.languages)))

    def _rows(self, words: Words, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The table's rows of distinct words, each with a place where it occurs."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if len(self.known) + new.sum() > max(20_000, CACHED * 4 // max(4, len(self.model.languages))):
            self._forget()
            new = np.ones(len(hashes), bool)
        places, totals = first[new], [self.table]
        for k in range(0, len(places), 20_000):
            lattice = Lattice(*words.letters(places[k : k + 20_000]), self.trie)
            totals.append(lattice.log_totals(self.model.probabilities))
        known = np.concatenate([self.known, hashes[new]])
        order = np.argsort(known, kind="stable")
        self.known, self.table = known[order], np.concatenate(totals)[order]
        return np.searchsorted(self.known, hashes)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        languages, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.model.languages:
            return languages, scores
        words = Words.of(texts)
        hashes, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        if not len(hashes):
            return languages, scores
        rows = self._rows(words, hashes, first)[inverse]
        begin = np.flatnonzero(np.concatenate([[True], words.owner[1:] != words.owner[:-1]]))
        total = np.add.reduceat(self.table[rows], begin, axis=0) + self.model.log_prior
        best = total.argmax(1)
        for text, k, row in zip(words.owner[begin].tolist(), best.tolist(), total):
            languages[text] = self.model.languages[k]
            scores[text] = 1 / np.exp(row - row[k]).sum()
        return languages, scores


def identify(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = train(docs, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            languages, scores = scorer.predict(texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score")
