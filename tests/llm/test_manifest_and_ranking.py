"""Nearest neighbours, ranked lexical search and Merkle proofs against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import lexical, merkle, projected, registry

# --- Merkle manifest ------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([H(*below[k : k + 16]) for k in range(0, len(below), 16)])
    return out


def siblings_of(levels, place):
    """(before, after) of each level below the root."""
    for nodes in levels[:-1]:
        first = place // 16 * 16
        yield nodes[first:place], nodes[place + 1 : first + 16]
        place //= 16


def merkle_rows(rows):
    """Plain rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    by_source = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        now = re.sub("[A-Z]", lambda m: m[0].lower(), text) if hit and text is not None else text
        by_source[source].append((doc_id is not None, doc_id or 0, leaf_of(doc_id, source, lang, n_chars, text), leaf_of(doc_id, source, lang, n_chars, now)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([r[2] for r in sorted(by_source[s])]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    for at, s in enumerate(order):
        for place, (has_id, doc_id, leaf, claimed) in enumerate(sorted(by_source[s])):
            proof = [*siblings_of(trees[s], place), *siblings_of(top, at)]
            folded = claimed
            for left, right in proof:
                folded = H(*left, folded, *right)
            seen = H(*(d for left, right in proof for d in (*left, *right)))
            yield doc_id if has_id else None, leaf, trees[s][-1][0], top[-1][0], seen, folded, folded == top[-1][0]


def merkle_query(docs):
    rows = merkle.verified(docs, {"text": merkle.tampered_text()})
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, None: 17, "": 1}, {"b": 300, "é": 257, "a": 256, "Z": 2}, {f"s{k}": 1 + k % 3 for k in range(40)}])
def test_proofs_match_plain_trees(spark, sizes):
    rows, number = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            number += 7
            rows.append((number % 1009, source, "en" if number % 3 else None, number, f"Some TEXT {number}"))
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = sorted(map(tuple, merkle_query(docs).collect()), key=repr)
    assert got == sorted(merkle_rows(rows), key=repr)
    assert {r[-1] for r in got} == ({True, False} if len(rows) > 20 else {r[-1] for r in got})


def test_proofs_of_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd.collect()]
    clashing = odd.withColumns({"leaf": F.lit("x"), "tree": F.lit(1), "path": F.lit(2)})
    assert sorted(map(tuple, merkle_query(clashing).collect()), key=repr) == sorted(merkle_rows(rows), key=repr)
    assert merkle_query(none).collect() == []


def test_equal_subtrees_are_one_record_and_some_leaves_can_be_asked(spark):
    row = (1, "s", "en", 4, "same")
    rows = [row] * 600 + [(k, "t", "en", 1, str(k)) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    manifest = merkle.build(docs)
    # 37 full runs of 16 equal leaves and one of 8 are two records.
    assert manifest.subtrees[1].count() == 2 + 4
    asked = manifest.leaves.filter("rank % 100 = 3").select("tree", "rank", "leaf")
    found = merkle.proofs(manifest, asked).withColumn("root_again", merkle.folded(F.col("leaf"), F.col("proof")))
    assert found.count() == 7
    assert found.filter("found = leaf AND root_again = root").count() == 7


# --- ranked lexical search ------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def lexical_rows(docs, items, k):
    counted = [(doc_id, terms_of(text)) for doc_id, text in docs]
    counted = [(doc_id, c) for doc_id, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, c in counted:
            m = 100 - 50 + 50 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms_of(text) if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if no_id else doc_id, -score) for rank, (score, no_id, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def test_ranks_of_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK", 1_000)
    texts = [None, "", "?!", "the same row WITH words", "A line of more than 東京 zwölf", "own line number 3", "word", "7 8", "nowhere-at-all"]
    items = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (3, "another text"), (None, "a row without an id")]
    df = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, score string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    for block_bytes in (1 << 20, 40):
        got = lexical.ranked(odd, df, k=5, block_bytes=block_bytes)
        assert sorted(map(tuple, got.collect()), key=repr) == lexical_rows(docs, [i for i in items], 5)
    assert lexical.ranked(none, df).collect() == [] and lexical.ranked(odd, df.limit(0)).collect() == []


def test_ties_are_cut_at_the_smaller_id_and_tiles_agree(spark, monkeypatch):
    monkeypatch.setattr(lexical, "DOC_TILE", 7)
    monkeypatch.setattr(lexical, "ITEM_TILE", 2)
    monkeypatch.setattr(lexical, "TERM_TILE", 3)
    random = np.random.default_rng(3)
    words = [f"w{k}" for k in range(30)]
    docs = [(int(i), " ".join(random.choice(words, random.integers(1, 9)))) for i in random.permutation(400)]
    items = [(k, " ".join(random.choice(words, 8))) for k in range(7)]
    got = lexical.ranked(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), k=20
    )
    assert sorted(map(tuple, got.collect()), key=repr) == lexical_rows(docs, items, 20)


def test_sums_stay_exact():
    weights = np.full(5_000, 44_000, np.int64)
    tile = lexical.Tile(0, [np.arange(5_000)], weights)
    assert all(int(dense.max()) * dense.shape[1] * lexical.MOST_IMPACT < lexical.EXACT for _, dense in tile.parts)
    doc, term = np.zeros(5_000, np.int64), np.arange(5_000)
    assert tile.scores(doc, term, np.full(5_000, 999_983), 1)[0, 0] == 5_000 * 44_000 * 999_983


# --- nearest neighbours ---------------------------------------------------------------


def dot(a, b):
    """Added in the order of the components; sum() would round otherwise."""
    total = 0.0
    for x, y in zip(a.tolist(), b.tolist()):
        total += x * y
    return total


def nearest_rows(rows, k):
    kept = [(i, np.array([*v, *[0.0] * (6 - len(v))], float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in kept:
        if i % 20 == 0:
            scored = [(-dot(v, w), j) for j, w in kept if j != i]
            out[i, tuple(v)] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def test_neighbours_with_ties_gaps_and_ragged_rows(spark):
    random = np.random.default_rng(5)
    rows = [(k, [float(x) for x in random.choice([-0.5, 0.0, 0.25, 3.0], 6)]) for k in range(400)]
    rows = [(i, v if any(v) else [1.0] * 6) for i, v in rows]
    rows += [(None, [1.0] * 6), (500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (506, [0.0] * 6)]
    rows += [(503, [float("inf")] * 6), (504, []), (505, [1.0, 1.0]), rows[20], rows[21], (520, [0.5] * 6)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cell string, query int").repartition(3)
    # At this confidence the test never ends a search early.
    got = projected.nearest(df, F.col("vec_id") % 20 == 0, k=7, confidence=1 - 1e-13, cell_rows=40).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r.vec_id, r.score))
    want = nearest_rows(rows, 7)
    assert {q: found[q] for q, _ in want} == {q: rows_ for (q, _), rows_ in want.items()}
    assert projected.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    few = projected.nearest(df.filter("vec_id IN (0, 1, 2)"), F.col("vec_id") % 20 == 0)
    assert [(r.query_id, r["rank"]) for r in few.orderBy("rank").collect()] == [(0, 1), (0, 2)]


def test_hot_vector_and_norms_that_differ(spark):
    random = np.random.default_rng(9)
    v = random.normal(size=(3_000, 12)) * random.lognormal(0, 0.3, size=(3_000, 1))
    v[1_000:2_000] = v[7]
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    got = projected.nearest(df, F.col("vec_id") % 20 == 0, k=20, cell_rows=200, sample=1_000).collect()
    hits = defaultdict(set)
    for r in got:
        hits[r.query_id].add(r.vec_id)
        assert r.score == dot(v[r.query_id], v[r.vec_id])
    assert all(len(h) == 20 for h in hits.values()) and len(hits) == 150
    scores = v[::20] @ v.T
    scores[np.arange(150), np.arange(0, 3_000, 20)] = -np.inf
    best = np.lexsort((np.broadcast_to(np.arange(3_000), scores.shape), -np.round(scores, 9)), axis=1)[:, :20]
    assert np.mean([len(hits[20 * k] & set(b.tolist())) / 20 for k, b in enumerate(best)]) >= 0.9


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = defaultdict(set)
    for r in registry.QUERIES["op11_nearest"](spark, "/root/testdata/sf0.1").collect():
        got[r.query_id].add(r.vec_id)
    recall = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = v @ v[q]
        score[q] = -np.inf
        recall.append(len(got[ids[q]] & set(ids[np.argsort(-score)[:20]].tolist())) / 20)
    assert np.mean(recall) >= 0.9


def test_few_leaves_are_opened_where_vectors_lie_in_groups():
    random = np.random.default_rng(2)
    centres = random.normal(size=(50, 32))
    v = centres[random.integers(0, 50, 8_000)] + random.normal(0, 0.05, (8_000, 32))
    v /= np.sqrt((v**2).sum(1))[:, None]
    longest = np.sqrt((v**2).sum(1)).max()
    part = projected.Part(np.arange(8_000), v, projected.projected(v, longest, False), longest)
    p = projected.projected(v[:100], 1.0, True)
    found, reach = part.search(np.arange(100), v[:100], p, np.full(100, 4.0), 20, projected.chi_square_quantile(0.95))
    opened = part.tree.near(p, projected.chi_square_quantile(0.95) * reach)[0]
    assert len(opened) < 0.3 * 100 * len(part.tree.ranges)
    scores = v[:100] @ v.T
    scores[np.arange(100), np.arange(100)] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    assert np.mean([len(set(ids.tolist()) & set(b.tolist())) / 20 for (ids, _), b in zip(found, best)]) >= 0.9


def test_quantiles():
    for share in (0.1, 0.5, 0.95):
        assert projected.chi_square_cdf(projected.chi_square_quantile(share)) == pytest.approx(share)
