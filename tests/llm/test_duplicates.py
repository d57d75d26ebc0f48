"""Line dedup, suffix dedup, near-dedup and decontamination against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import common, decontam, linededup, neardup, registry, suffix
from terrace.llm.components import components
from terrace.session import setting

SF = "/root/testdata/sf0.01"


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- lines ----------------------------------------------------------------------------


def kept_lines(rows, min_chars=40, min_docs=5):
    holders = defaultdict(list)
    for doc_id, text in rows:
        for key in {linededup.line_key(x) for x in (text or "").split("\n")}:
            holders[key].append(-(1 << 63) if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        own = -(1 << 63) if doc_id is None else doc_id
        lines = (text or "").split("\n")
        stay = []
        for x in lines:
            key = linededup.line_key(x)
            if len(key) < min_chars or len(set(holders[key]) - {-(1 << 63)}) < min_docs or max(holders[key]) == own:
                stay.append(x)
        out.append((doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def test_lines_of_odd_rows(spark, odd, none):
    got = linededup.drop_repeated_lines(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"]
    rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=repr)
    assert rows == kept_lines(texts_of(odd))
    assert sum(r[2] for r in rows) == 10
    assert linededup.drop_repeated_lines(none).count() == 0
    own = got.filter("doc_id = 6").first()
    assert (own.lang, own.score, own.row, own.key) == ("de", 0.5, "x", 7)


def test_rows_of_one_id_are_one_document(spark):
    """As the DuckDB text has it: four ids with each row twice are four documents."""
    import duckdb

    line = "a line of more than forty characters, as the contract asks for"
    four = [(k, f"{line}\nown {k}") for k in range(4)] * 2
    for rows in (four, four + [(9, line)], four + [(9, f"x\n{line}\n{line}")] * 2):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = linededup.drop_repeated_lines(docs)
        con = duckdb.connect()
        con.register("documents", docs.toPandas())
        lost = con.execute(registry.SQL["op9_line_dedup"]).fetchdf()["n_dropped"].sum()
        assert sum(r.n_dropped for r in got.collect()) == (0 if len(rows) == 8 else 8) and (lost == 0) == (len(rows) == 8)


def test_small_shards_and_many_copies_give_the_same(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    rows = texts_of(docs)
    lost = {(i, k): n for i, n, k, _ in kept_lines(rows, 10, 3)}
    gone = linededup.repeated_lines(docs, 10, 3, keys_per_shard=4, probes_per_task=50)
    assert sum(len(r.lines) for r in gone.collect()) == sum(k for _, k in lost) > 50


def test_perfect_hash_places_every_key_alone():
    random = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        h1, h2 = (random.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
        table = linededup.PerfectHash.of(h1, h2)
        assert sorted(table.places(h1, h2)) == list(range(n))
        other = table.places(h2, h1)
        assert ((other >= -1) & (other < max(n, 1))).all()


def test_keys():
    assert linededup.line_key(" \t\x0b\x0c\rÄB c  ") == "Äb c "


# --- repeated bytes -------------------------------------------------------------------


def kept_bytes(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, texts):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=repr)


def removed(df, length):
    rows = suffix.remove_repeats(df, length).collect()
    return sorted(((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def overlapping(spark):
    """Passages that share parts of all sizes around the length, in documents and within."""
    random = np.random.default_rng(2)
    words = ["".join(chr(97 + c) for c in random.integers(0, 5, 3)) for _ in range(40)]
    base = [" ".join(random.choice(words, 150)) for _ in range(6)]
    rows = []
    for k in range(60):
        parts = []
        for _ in range(random.integers(1, 4)):
            text, size = base[random.integers(0, 6)], int(random.integers(150, 420))
            start = int(random.integers(0, len(text) - size))
            parts.append(text[start : start + size])
            parts.append("".join(chr(c) for c in random.integers(200, 900, 5)))
        rows.append((k, "".join(parts)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_repeats_match_brute_force(odd, none, overlapping):
    # The very long periodic text is compared at the shorter lengths only.
    plain = odd.filter("doc_id IS NULL OR doc_id NOT IN (4, 21)")
    both = plain.select("doc_id", "text").unionByName(overlapping)
    assert removed(both, 200) == kept_bytes(texts_of(both), 200)
    assert removed(none, 200) == []


def test_long_periodic_texts(odd):
    got = {r[0]: r for r in removed(odd.filter("doc_id IN (4, 21)"), 200)}
    assert got[4][1:4] == (150_000, 150_000, 1) and got[21][1:4] == (5_000, 5_000, 1)


def test_hot_anchors_give_the_same(monkeypatch, overlapping):
    rows = texts_of(overlapping)
    keyed = overlapping.select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("key"), "text")
    for group in (0, 2, suffix.GROUP):
        spans = suffix.repeated_spans(keyed, 200, group)
        gone = defaultdict(set)
        for r in spans.collect():
            gone[r.id].update(range(r.start, r.stop))
        assert {k: len(v) for k, v in gone.items()} == {i: n for i, _, n, _, _ in kept_bytes(rows, 200) if n}


def test_suffixes_are_sorted_and_collisions_are_found(monkeypatch):
    random = np.random.default_rng(3)
    data = random.integers(97, 99, 4000).astype(np.uint8)
    data[1000:1600] = data[3000:3600]
    data = np.concatenate([data, data[:300]])
    starts = np.arange(len(data) - 40 + 1)
    windows = [bytes(data[s : s + 40]) for s in starts]
    counts = Counter(windows)
    expected = [counts[w] > 1 for w in windows]
    sorter = suffix.SuffixSorter(data, 40)
    assert sorter.repeated(starts).tolist() == expected
    order = sorter.merge_sorted(starts.copy(), np.zeros(len(starts), np.int64))
    assert [windows[s] for s in order] == sorted(windows)
    # With a hash that says nothing, verification still gets it right.
    monkeypatch.setattr(suffix.PrefixHash, "of", lambda self, start, size: np.zeros(len(start), np.uint64))
    assert suffix.SuffixSorter(data, 40).repeated(starts).tolist() == expected


def test_anchors_of_equal_windows_are_equal():
    random = np.random.default_rng(4)
    passage = random.integers(97, 123, 230).astype(np.uint8)
    texts = [np.concatenate([random.integers(97, 123, n).astype(np.uint8), passage, random.integers(97, 123, 50).astype(np.uint8)]) for n in (0, 7, 400)]
    bounds = np.cumsum([0, *map(len, texts)])
    document, start, n, anchor, _ = suffix.segments_of(np.concatenate(texts), bounds, 200)
    covered = [set() for _ in texts]
    for d, s, m in zip(document, start, n):
        covered[d].update(range(s, s + m))
    assert [len(c) for c in covered] == [len(t) - 199 for t in texts]
    owner = [{p: a for dd, s, m, a in zip(document, start, n, anchor) if dd == d for p in range(s, s + m)} for d in range(3)]
    for p in range(31):
        assert owner[0][p] == owner[1][7 + p] == owner[2][400 + p]


# --- near copies ----------------------------------------------------------------------


def brute_groups(rows):
    shingles = neardup.Shingles([t or "" for _, t in rows])
    entry = (shingles.hash >> np.uint64(64 - neardup.TABLE_BITS)).astype(np.int64)
    table = np.bincount(entry, minlength=1 << neardup.TABLE_BITS)
    weights = shingles.weights(neardup.idf_table(table, len(np.unique(shingles.owner))))
    sets = [{} for _ in rows]
    for o, h, w in zip(shingles.owner.tolist(), shingles.hash.tolist(), weights.tolist()):
        sets[o][h] = w
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for o, own in enumerate(sets):
        for h in own:
            holders[h].append(o)
    pairs = {(a, b) for own in holders.values() for i, a in enumerate(own) for b in own[i + 1 :]}
    for a, b in pairs:
        shared = sum(min(w, sets[b][h]) for h, w in sets[a].items() if h in sets[b])
        if shared >= (0.8 - 1e-9) * (sum(sets[a].values()) + sum(sets[b].values()) - shared):
            parent[root(a)] = root(b)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[root(k)].append(k)
    out = [None] * len(rows)
    for own in members.values():
        ids = [rows[k][0] for k in own if rows[k][0] is not None]
        for k in own:
            out[k] = min(ids) if ids else None
    return out


def test_classes_match_brute_force(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select(F.col("doc_id") + 100_000, "text").toDF("doc_id", "text"))
    rows = texts_of(docs)
    got = Counter((r.doc_id, r.class_id) for r in neardup.classes(docs).collect())
    assert got == Counter((d, c) for (d, _), c in zip(rows, brute_groups(rows)))


def test_a_large_group_of_near_copies_is_one_class(spark):
    random = np.random.default_rng(5)
    words = [f"w{k}" for k in range(5000)]
    base = list(random.choice(words, 300))
    rows = []
    for k in range(400):
        own = list(base)
        for _ in range(2):
            own[random.integers(0, 300)] = f"new{random.integers(0, 10**9)}"
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, " ".join(random.choice(words, 200))) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(map(tuple, neardup.classes(docs).collect()))
    assert all(got[k] == 0 for k in range(400)) and all(got[1000 + k] == 1000 + k for k in range(100))


def star(random, n, edits, name):
    """A text of 300 words and copies of it, each with words of its own in `edits` places."""
    base = [f"{name}{k}" for k in random.integers(0, 5000, 300)]
    out = [" ".join(base)]
    for k in range(n):
        own = list(base)
        for at in random.choice(300, edits, replace=False):
            own[at] = f"{name}new{k}x{at}"
        out.append(" ".join(own))
    return out


def test_copies_that_are_close_to_their_original_only(spark):
    random = np.random.default_rng(11)
    rows = list(enumerate(star(random, 1000, 5, "w")))
    random.shuffle(rows)
    docs = spark.createDataFrame([(int(k), t) for k, t in rows], "doc_id long, text string")
    got = dict(map(tuple, neardup.classes(docs).collect()))
    want = dict(zip((k for k, _ in rows), brute_groups(rows)))
    assert sum(got[k] != want[k] for k in want) <= 1  # none of the bands meets: 0.02 % of the pairs


@pytest.mark.parametrize("n", [200, 800])
def test_links_grow_with_the_copies(spark, monkeypatch, n):
    """Of all pairs that reach the threshold under two links a copy are labelled."""
    random = np.random.default_rng(13)
    rows = list(enumerate(star(random, n, 3, "w")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counted, plain = [], neardup.components

    def counting(links):
        counted.append(links.count())
        return plain(links)

    monkeypatch.setattr(neardup, "components", counting)
    got = dict(map(tuple, neardup.classes(docs).collect()))
    assert sum(v != 0 for v in got.values()) <= 1
    assert sum(counted) < 2 * n


def test_every_pair_of_a_bucket_is_tried(spark, monkeypatch):
    """Without leaders, and with buckets of many blocks, the groups are those of brute force."""
    random = np.random.default_rng(12)
    rows = list(enumerate(t for k in range(4) for t in star(random, 60, 4, f"s{k}_")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((d, c) for (d, _), c in zip(rows, brute_groups(rows)))
    for block in (neardup.BLOCK, 8):
        monkeypatch.setattr(neardup, "BLOCK", block)
        found = neardup.groups(neardup.keyed(docs), rounds=0).collect()
        least = {}
        for r in found:
            least[r.group] = min(least.get(r.group, r.id), r.id)
        assert Counter((r.id, least[r.group]) for r in found) == want


def test_texts_of_a_pair_are_compared_once(spark, monkeypatch):
    """The links of a round are read in several places; a leader's pairs are dealt to many tasks."""
    random = np.random.default_rng(15)
    rows = list(enumerate(t for k in range(2) for t in star(random, 80, 4, f"s{k}_")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made, linked, dealt, plain = spark.sparkContext.accumulator(0), [], [], neardup.verified

    def counting(pairs, *rest):
        dealt.append(pairs.groupBy("a", "salt").count().agg(F.max("count")).first()[0])
        linked.append(plain(pairs, *rest).count())

        def noted(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        return plain(pairs, *rest).mapInArrow(noted, "a binary, b binary")

    monkeypatch.setattr(neardup, "verified", counting)
    monkeypatch.setattr(neardup, "PAIRS_PER_TASK", 8)
    got = Counter(map(tuple, neardup.classes(docs).collect()))
    assert got == Counter((d, c) for (d, _), c in zip(rows, brute_groups(rows)))
    assert made.value == sum(linked) > 150
    assert max(dealt) <= 3 * neardup.PAIRS_PER_TASK


def test_classes_of_few_rows_come_of_one_task(spark):
    docs = spark.createDataFrame([(k, f"one {k // 2} two three four five six") for k in range(40)], "doc_id long, text string")
    with setting(spark, "spark.sql.shuffle.partitions", "64"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        assert neardup.classes(docs).rdd.getNumPartitions() == 1


def test_few_rows_go_to_few_files(spark, monkeypatch, tmp_path):
    """However many partitions the shuffles have; only what scans or compares texts writes more."""
    random = np.random.default_rng(14)
    rows = list(enumerate(t for k in range(3) for t in star(random, 60, 4, f"s{k}_")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((d, c) for (d, _), c in zip(rows, brute_groups(rows)))
    made = []

    def scratch(_, label):
        made.append((label, tmp_path / f"{len(made)}-{label}"))
        return str(made[-1][1])

    monkeypatch.setattr(common, "scratch_dir", scratch)
    with setting(spark, "spark.sql.shuffle.partitions", "64"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        assert Counter(map(tuple, neardup.classes(docs).collect())) == want
        assert neardup.keep_one(docs).rdd.getNumPartitions() == 1
        assert linededup.drop_repeated_lines(docs).rdd.getNumPartitions() == 1
    files = {(label, len(list(path.glob("part-*")))) for label, path in made if label not in ("signatures", "verified", "groups", "lines")}
    assert {"buckets", "leaders", "pairs", "links", "labels"} <= {label for label, _ in files}
    assert max(n for _, n in files) == 1


def test_one_of_each_group_stays(spark, odd, none):
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    # Wordless texts stay one by one; the repeated row is one.
    assert sum(not (r.text or "").strip() for r in rows) == 4
    assert sum((r.text or "").startswith("the same row") for r in rows) == 1
    assert sum((r.text or "").startswith("the same id") for r in rows) == 1
    assert neardup.keep_one(none).count() == 0 and neardup.classes(none).count() == 0


def test_samples_agree_as_often_as_the_weighted_similarity():
    random = np.random.default_rng(6)
    words = [f"w{k}" for k in range(400)]
    hits = want = 0
    for _ in range(60):
        a = list(random.choice(words, 80))
        b = a[: int(random.integers(20, 80))] + list(random.choice(words, 20))
        shingles = neardup.Shingles([" ".join(a), " ".join(b)])
        weights = shingles.count * random.uniform(1, 3, len(shingles.hash))
        # Equal shingles weigh the same in both.
        by_hash = dict(zip(shingles.hash.tolist(), weights.tolist()))
        weights = np.array([by_hash[h] for h in shingles.hash.tolist()])
        drawn = neardup.samples(shingles, weights, 2)
        hits += (drawn[0] == drawn[1]).sum()
        left, right = ({h: w for h, w, o in zip(shingles.hash.tolist(), weights.tolist(), shingles.owner) if o == k} for k in (0, 1))
        shared = sum(min(w, right[h]) for h, w in left.items() if h in right)
        want += shared / (sum(left.values()) + sum(right.values()) - shared) * drawn.shape[1]
    assert hits / (60 * 36) == pytest.approx(want / (60 * 36), abs=0.03)


def test_components(spark):
    chain = [(k, k + 1) for k in range(50)] + [(100, 101), (102, 101), (200, 200)]
    links = spark.createDataFrame([(f"{a:04}", f"{b:04}") for a, b in chain], "a string, b string")
    got = dict(map(tuple, components(links).collect()))
    assert got == {f"{k:04}": "0000" for k in range(51)} | {f"{k:04}": "0100" for k in (100, 101, 102)}


# --- benchmark passages ---------------------------------------------------------------


def least_edits(item, text):
    """Fewest edits between the item and any part of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def planted(spark):
    random = np.random.default_rng(7)
    letters = np.array(list("abcdefghij      "))
    noise = lambda n: " ".join("".join(random.choice(letters, n)).split())
    items = [(k, noise(int(random.integers(60, 250)))) for k in range(12)]
    items += [(50, "tiny one"), (51, None), (52, ""), (53, "!!!"), (54, items[0][1]), (None, noise(100))]
    rows = []
    for k in range(40):
        item = items[k % 12][1]
        text = list(item)
        for _ in range(int(random.integers(0, 2 * max(1, int(0.05 * len(item))) + 1))):
            at, kind = int(random.integers(0, len(text))), random.integers(0, 3)
            text[at : at + (kind < 2)] = ["x"] if kind else []
        rows.append((k, f"{noise(80)} {''.join(text).upper()}, {noise(60)}"))
    rows += [(100, None), (101, ""), (None, items[3][1]), (102, "here is a Tiny, one here"), (103, "tiny ones"), (104, items[1][1]), (104, items[1][1])]
    return items, spark.createDataFrame(items, "item_id long, text string"), rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_passages_within_the_budget_are_found(planted):
    items, benchmark, rows, docs = planted
    expected = {}
    for d, (doc_id, text) in enumerate(rows):
        text = decontam.normalised(text or "")
        for item_id, item in items:
            item = decontam.normalised(item or "")
            if not item or not text:
                continue
            if len(item) < decontam.Q:
                best, k = (0 if f" {item} " in f" {text} " else 1), 0
            else:
                best, k = least_edits(item, text), decontam.edits_allowed(len(item))
            if best <= k:
                expected[d, doc_id, item_id] = best
    got = decontam.matches(docs, benchmark).collect()
    found = {}
    for r in got:
        found[r.doc_id, r.item_id] = min(r.edits, found.get((r.doc_id, r.item_id), 99))
    assert found == {(doc, item): n for (_, doc, item), n in expected.items()}
    assert 0 < max(found.values()) and len(found) < 40 + 20
    # Small blocks of items give the same.
    again = decontam.matches(docs, benchmark, block_chars=300).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_places_are_those_of_the_alignment(planted):
    items, benchmark, rows, docs = planted
    by_item, by_doc = dict(items), dict(rows)
    for r in decontam.matches(docs, benchmark).filter("doc_id < 100 AND item_id < 12").collect():
        part = decontam.normalised(by_doc[r.doc_id])[r.start : r.end]
        item = decontam.normalised(by_item[r.item_id])
        whole = list(range(len(part) + 1))
        for i, a in enumerate(item, 1):
            new = [i]
            for j, b in enumerate(part, 1):
                new.append(min(whole[j - 1] + (a != b), whole[j] + 1, new[-1] + 1))
            whole = new
        assert whole[-1] == r.edits


def test_contaminated_documents_go(spark, odd, none, planted):
    items, benchmark, rows, docs = planted
    hit = {r.doc_id for r in decontam.matches(docs, benchmark).collect()}
    kept = decontam.drop_contaminated(docs.filter("doc_id IS NOT NULL"), benchmark, block_chars=500)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if i is not None and i not in hit)
    assert decontam.drop_contaminated(odd, benchmark).columns == odd.columns
    assert decontam.drop_contaminated(odd, benchmark.limit(0)).count() == odd.count()
    assert decontam.matches(none, benchmark).count() == 0


def test_given_tables_exactly_contained_items(spark):
    got = {(r.doc_id, r.item_id) for r in registry.QUERIES["op4_decontamination"](spark, SF).collect()}
    items = [(r.item_id, decontam.normalised(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r.doc_id, decontam.normalised(r.text or "")) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    contained = {(d, i) for d, t in docs for i, item in items if item in t}
    assert contained <= got and len(got) <= len(contained) * 1.1


def test_digest_of_the_op5_query(spark):
    got = registry.QUERIES["op5_suffix_dedup"](spark, "/root/testdata/sf0.001")
    rows = texts_of(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    expected = [(i, n, g, r, hashlib.sha256(k).hexdigest()) for i, n, g, r, k in kept_bytes(rows, 200)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_runs_of_equal_grams_count_like_pairs():
    random = np.random.default_rng(8)
    for letters, n in (("ab", 400), ("a", 300), ("abcd ", 500)):
        unit = "".join(random.choice(list(letters), 7))
        items = [(k, unit * int(random.integers(8, 30)) + "".join(random.choice(list(letters), 20))) for k in range(4)]
        index = decontam.Index(items)
        text = decontam.normalised(unit * (n // 7) + "".join(random.choice(list("abcdef"), 60)) + unit * 5)
        grams = decontam.gram_hashes(decontam.codes_of(text), index.q)
        first = np.searchsorted(index.hashes, grams, "left")
        count = np.searchsorted(index.hashes, grams, "right") - first
        at = np.flatnonzero(count)
        assert index.bands_of_runs(at, first[at], count[at]) == index.bands(at, first[at], count[at]) != []


def test_repetitive_texts_and_long_items_take_little():
    import resource
    import time

    used = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    start = time.perf_counter()
    index = decontam.Index([(1, "ab " * 667), (2, "a" * 2_000)])
    assert {m[0] for m in index.matches(decontam.normalised("ab " * 6_667))} == {0}
    assert {m[0] for m in index.matches("a" * 20_000)} == {1}
    assert time.perf_counter() - start < 10
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - used < 200_000
    random = np.random.default_rng(9)
    seconds = []
    for m in (5_000, 40_000):
        item = "".join(random.choice(list("abcdefgh "), m))
        region = item[:100] + "x" + item[101 : m // 2] + item[m // 2 + 1 :]
        start = time.perf_counter()
        assert decontam.aligned(item, f"{'q' * 30}{region}{'z' * 30}", 20, 0, 60) == (2, 30, 30 + len(region))
        seconds.append(time.perf_counter() - start)
    # Eight times the item, not sixty-four times the work.
    assert seconds[1] < 25 * seconds[0]


def test_banded_alignment_equals_the_whole_table():
    random = np.random.default_rng(10)
    for _ in range(200):
        item = "".join(random.choice(list("abc "), int(random.integers(1, 30))))
        text = "".join(random.choice(list("abc "), int(random.integers(0, 40))))
        k = int(random.integers(0, 8))
        best = least_edits(item, text) if text else len(item)
        got = decontam.aligned(item, text, k)
        assert (got is None) == (best > k or not text)
        if got:
            assert got[0] == best and least_edits(item, text[got[1] : got[2]]) == best
        # A part that starts on a diagonal of the band is found there.
        if got:
            assert decontam.aligned(item, text, k, got[1] - k, got[1] + k)[0] == best


def test_every_place_of_a_short_item():
    index = decontam.Index([(1, "fox"), (2, "a a")])
    assert index.matches("a fox b fox c") == [(0, 0, 2, 5), (0, 0, 8, 11)]
    assert index.matches("fox fox") == [(0, 0, 0, 3), (0, 0, 4, 7)]
    assert index.matches("a a a a a") == [(1, 0, 0, 3), (1, 0, 4, 7)]
    assert index.matches("foxes") == []
