"""Quality, toxicity and language: held-out accuracy, the numerical core, odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import language, quality, registry, toxicity

SF = "/root/testdata/sf0.1"


def area(labels, scores):
    """Share of (positive, negative) pairs in the right order."""
    order = np.argsort(scores, kind="stable")
    values, inverse, counts = np.unique(np.asarray(scores)[order], return_inverse=True, return_counts=True)
    ranks = np.empty(len(scores))
    ranks[order] = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    y = np.asarray(labels, bool)
    return (ranks[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


@pytest.mark.parametrize(("name", "label", "least"), [("op1_quality", "quality", 0.98), ("op8_toxicity", "toxic", 0.95)])
def test_held_out_rows_are_ranked_well(spark, name, label, least):
    rows = registry.QUERIES[name](spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    known = rows.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert area(known[label], known.score) > least
    assert ((known.score >= 0.3) == known.predicted).all() and known.score.between(0, 1).all()
    assert (known.predicted == known[label]).mean() > 0.95


def test_folds_follow_the_crc(spark):
    import zlib

    got = spark.range(200).select("id", quality.held_out("id", 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_discriminant_is_the_difference_of_the_log_densities():
    random = np.random.default_rng(1)
    d = len(quality.NAMES)
    x = {c: random.normal(c, 1 + c, (50 + 30 * c, d)) for c in (0, 1)}
    moments = {c: (float(len(v)), v.sum(0), v.T @ v) for c, v in x.items()}
    model = quality.Discriminant.of(moments)
    cov = {c: np.cov(v.T, bias=True) for c, v in x.items()}
    pooled = (50 * cov[0] + 80 * cov[1]) / 130
    point = random.normal(0.5, 1, d)
    logs = []
    for c in (0, 1):
        s = 0.88 * cov[c] + 0.1 * pooled + 0.02 * np.diag(np.diag(pooled))
        e = point - x[c].mean(0)
        logs.append(-0.5 * (e @ np.linalg.solve(s, e) + np.linalg.slogdet(s)[1]))
    expected = 1 / (1 + np.exp(-(np.log(81 / 51) + logs[1] - logs[0])))
    assert model.score(point[None])[0] == pytest.approx(expected, rel=1e-9)


def test_statistics_do_not_depend_on_the_batch():
    texts = ["", "One two, three!", "UP up 12\nUP up 12", "ñandú ∑ 東京"]
    whole = quality.statistics(texts)
    assert np.allclose(whole, np.concatenate([quality.statistics([t]) for t in texts]))
    assert np.isfinite(whole).all()


def test_nnpu_separates_and_stays_non_negative():
    random = np.random.default_rng(2)
    toxic = (random.random((300, 20)) < 0.2).astype(np.float32)
    toxic[:, 0] = 1
    plain = (random.random((2000, 20)) < 0.2).astype(np.float32)
    plain[:, 0] = random.random(2000) < 0.1
    weights = toxicity.nnpu_weights(toxic, plain, 0.1)
    assert weights[0] == weights[:-1].max() > 1
    margins = plain @ weights[:-1] + weights[-1]
    scale, shift = toxicity.calibration(toxic @ weights[:-1] + weights[-1], margins, 0.1)
    p = 1 / (1 + np.exp(-(scale * margins + shift)))
    assert p.mean() == pytest.approx(0.1, abs=0.03)
    assert area(plain[:, 0] == 1, p) > 0.95


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_odd_rows_and_labels(spark, odd, none):
    some = labels_of(spark, [(1, 1, 1, "t"), (4, 0, 0, None), (10, 1, 0, ""), (11, 0, None, ""), (12, 1, 1, ""), (13, 7, 7, ""), (None, 1, 1, ""), (10, 1, 0, ""), (14, 0, 1, "")])
    for score, columns in ((quality.score_quality, 4), (toxicity.score_toxicity, 4)):
        for labels in (some, some.limit(0), some.filter("quality = 1")):
            rows = score(odd, labels).collect()
            assert len(rows) == odd.count() and len(rows[0]) == columns
            assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out is not None for r in rows)
        assert score(none, some).collect() == []
    rows = language.identify(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert {k for k, r in by_id.items() if r.lang_pred == "und"} == {1, 2, 3, 7}
    assert by_id[6].lang_pred in ("en", "de", "fr") and all(0 <= r.score <= 1 for r in rows)
    assert language.identify(none).collect() == []
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify(unlabelled).collect()} == {("und", 0.0)}


def test_toxic_documents_are_dropped_with_all_columns(spark, odd):
    kept = toxicity.drop_toxic(odd, labels_of(spark, []))
    assert kept.columns == odd.columns and kept.count() == odd.count()


# --- language -------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    rows = language.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    known = rows.join(lang, "doc_id").filter("held_out").toPandas()
    assert (known.lang == known.lang_pred).mean() > 0.97


def segmentations(text, trie):
    """All lists of pieces of a text; a letter that is no piece is the unknown one."""
    if not text:
        return [[]]
    out, node, single = [], 0, False
    for n in range(1, len(text) + 1):
        node = int(trie.step(np.array([node]), np.array([ord(text[n - 1])]))[0])
        if node < 0:
            break
        if trie.piece[node] >= 0:
            single |= n == 1
            out += [[int(trie.piece[node]), *rest] for rest in segmentations(text[n:], trie)]
    if not single:
        out += [[trie.unknown, *rest] for rest in segmentations(text[1:], trie)]
    return out


def test_forward_sums_all_segmentations_and_backward_their_uses():
    trie = language.pieces(language.default_vocabulary())
    words = ["hello", "der", "ñandú", "東京", "x", "segment"]
    random = np.random.default_rng(3)
    p = random.dirichlet(np.ones(trie.unknown + 1), size=2)
    lattice = language.Lattice.of(words, trie)
    totals = lattice.log_totals(p)
    language_of, counts = np.array([0, 1, 0, 1, 0, 1]), np.arange(1.0, 7.0)
    expected = np.zeros_like(p)
    for w, word in enumerate(words):
        ways = segmentations(language.START + word, trie)
        for k in (0, 1):
            total = sum(np.prod(p[k, way]) for way in ways)
            assert totals[w, k] == pytest.approx(np.log(total), rel=1e-9)
        for way in ways:
            share = np.prod(p[language_of[w], way]) / np.exp(totals[w, language_of[w]])
            for piece in way:
                expected[language_of[w], piece] += counts[w] * share
    assert np.allclose(lattice.expected(p, language_of, counts), expected)


def test_scores_do_not_depend_on_what_was_met_before():
    trie = language.pieces(language.default_vocabulary())
    p = np.random.default_rng(4).dirichlet(np.ones(trie.unknown + 1), size=2)
    model = language.Model(language.default_vocabulary(), ["a", "b"], np.log([0.5, 0.5]), p)
    texts = ["one two two", "½ ²", "", "x" * 100, "Three THREE one", "7" * 10]
    together = language.Scorer(model).predict(texts)
    scorer = language.Scorer(model)
    apart = [scorer.predict([t]) for t in texts]
    assert together[0] == [a[0][0] for a in apart] and np.allclose(together[1], [a[1][0] for a in apart])
    assert [k for k, lang in enumerate(together[0]) if lang == "und"] == [1, 2, 5]


def test_words_are_runs_of_letters_in_bounded_parts():
    words = language.Words.of(["Ab1c_d", "", "²", "é" * 50 + " x"])
    found = [(int(o), words.joined[a:b]) for o, a, b in zip(words.owner, words.start, words.stop)]
    assert found == [(0, "ab"), (0, "c"), (0, "d"), (3, "é" * 24), (3, "é" * 24), (3, "éé"), (3, "x")]
    assert words.hash[3] == words.hash[4] != words.hash[5]
