"""Exact top-k, WARC archives and packing."""

import glob
import gzip
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import packing, vafile, warc

# --- top-k ----------------------------------------------------------------------------


def brute(rows, k):
    whole = {}
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[vec_id, tuple(int(np.floor(64 * float(np.float32(x)))) for x in v)] = None
    out = []
    for q, a in whole:
        if q % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), c) for c, b in whole if c != q]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_top_k_with_ties_gaps_and_ragged_rows(spark):
    random = np.random.default_rng(5)
    # Few distinct components, so that many scores tie.
    rows = [(k, [float(x) for x in random.choice([-0.5, 0.0, 0.25, 0.9], 6)]) for k in range(400)]
    rows += [(None, [1.0] * 6), (500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6)]
    rows += [(503, [float("inf")] * 6), (504, []), (505, [1.0, 1.0]), rows[20], rows[21], (520, [0.1] * 6)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, block int")
    for blocks in (8_192, 50):
        got = vafile.top_k(df, F.col("vec_id") % 20 == 0, k=7, block_rows=blocks, query_rows=6)
        assert sorted(map(tuple, got.collect())) == brute(rows, 7)
    assert vafile.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    few = vafile.top_k(df.filter("vec_id IN (0, 1, 2)"), F.col("vec_id") % 20 == 0)
    assert [(r.query_id, r.rank) for r in few.orderBy("rank").collect()] == [(0, 1), (0, 2)]


def test_bounds_hold_and_most_vectors_are_not_read(spark):
    random = np.random.default_rng(6)
    v = np.floor(64 * random.normal(0, 0.15, (4000, 16))).astype(np.int64)
    block = vafile.Block(np.arange(4000), v)
    q = v[:50]
    bounds = block.scan(q.astype(float))
    exact = q @ v.T
    assert (bounds >= exact).all()
    tenth = np.sort(exact, axis=1)[:, -10]
    assert (bounds >= tenth[:, None]).mean() < 0.2


@pytest.mark.parametrize("k", [20, 63, 64, 200, 1999, 3000])
def test_a_block_gives_the_best_scores_for_any_k(k):
    random = np.random.default_rng(7)
    v = np.floor(64 * random.normal(0, 0.15, (2000, 16))).astype(np.int64)
    rows, ids, scores = vafile.Block(np.arange(2000), v).best(np.arange(5), v[:5], k)
    for q in range(5):
        exact = v @ v[q]
        want = [c for c in np.lexsort((np.arange(2000), -exact)) if c != q][:k]
        assert ids[rows == q].tolist() == want and scores[rows == q].tolist() == exact[want].tolist()


def test_large_components(spark):
    rows = [(0, [1e6, -1e6]), (1, [1e6, 1e6]), (2, [-1e6, 1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vafile.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 0), (2, -2 * (64 * 10**6) ** 2)]
    with pytest.raises(Exception, match="too large"):
        vafile.top_k(spark.createDataFrame([(0, [1e12]), (1, [1e12])], df.schema), F.col("vec_id") == 0).collect()


# --- WARC -----------------------------------------------------------------------------

BIG = "<p>" + "payload " * 40 + "</p>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://x/{k}", f"<p>{k}</p>" * (k % 50 + 1)) for k in range(120)]
    rows += [(300 + 7 * k, f"http://copy/{k}", BIG) for k in range(30)]
    rows += [(None, "http://none", BIG), (None, None, None), (200, None, ""), (201, "http://a b\n\tc", "é" * 60)]
    rows += [(202, "u", "short"), (203, "v", "short"), (300, "http://again", BIG), (5, "http://other", BIG * 2), (204, "", "é" * 60)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, shard string").repartition(4)


def test_archives_read_back(spark, pages, tmp_path):
    root = str(tmp_path / "a")
    manifest = warc.write_warc(pages, root, roll_bytes=4_000, shard_bytes=20_000, spans=64)
    got = warc.read_warc(spark, root, with_payload=True)
    source = [(r.page_id, r.url, (r.html or "").encode()) for r in pages.collect()]
    first = {}
    for page_id, _, payload in source:
        if len(payload) >= 100 and page_id is not None:
            first[payload] = min(first.get(payload, page_id), page_id)
    expected = []
    for page_id, _, payload in source:
        own = first.get(payload)
        revisit = own is not None and own != page_id
        expected.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", own if revisit else None, None if revisit else payload))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    rows = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got.select(columns).collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    assert got.filter("page_id = 201").first().url == "http://a%20b%0A%09c"
    assert got.filter("payload_bytes = 0 AND page_id = 200").first().url is None
    files = manifest.collect()
    assert len(files) > 5 and sum(f.records for f in files) == len(source)
    for f in files:
        data = open(f"{root}/{f.file}", "rb").read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (f.bytes, f.sha256)
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert not glob.glob(f"{root}/_tmp*")


def test_archives_are_the_same_bytes_however_pages_are_stored(spark, pages, tmp_path):
    for name, rows in (("a", pages), ("b", pages.repartition(7, "url")), ("c", pages.coalesce(1))):
        warc.write_warc(rows, str(tmp_path / name), roll_bytes=4_000, shard_bytes=20_000, spans=64)
    names = [sorted(p.rsplit("/", 1)[1] for p in glob.glob(f"{tmp_path}/{d}/part-*.warc.gz")) for d in "abc"]
    assert names[0] == names[1] == names[2]
    for name in names[0]:
        assert len({open(f"{tmp_path}/{d}/{name}", "rb").read() for d in "abc"}) == 1


def test_uncommitted_files_do_not_count_and_broken_ones_are_found(spark, pages, tmp_path):
    root = str(tmp_path / "a")
    warc.write_warc(pages.filter("page_id < 10"), root)
    (tmp_path / "a" / "part-000099-00000.warc.gz").write_bytes(b"left by a lost attempt")
    assert warc.read_warc(spark, root).count() == pages.filter("page_id < 10").count()
    good = warc.page_record(1, "http://x", b"payload", hashlib.sha256(b"payload").hexdigest(), None, warc.DATE, 4)
    for bad in (good[:-5], gzip.compress(gzip.decompress(good).replace(b"payload\r\n", b"qayload\r\n"))):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.parse_records(bad))


def test_empty_archive(spark, pages, tmp_path):
    root = str(tmp_path / "a")
    assert warc.write_warc(pages.limit(0), root).count() == 0
    assert warc.read_warc(spark, root).count() == 0


# --- packing --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out.encode_special_tokens = True
    return out


def test_ids_are_those_of_the_json_vocabulary(spark, tokenizer, odd):
    encoder = packing.encoding(packing.default_vocabulary())
    texts = [r.text or "" for r in odd.select("text").collect()]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["<|endoftext|> it's  two   spaces\t\n\n x", "   ́é퟿", "'s'T've 1234567 ٣٤", "👩‍👩‍👧‍👦 नमस्ते", "\x00\x7f"]
    for text in texts:
        assert encoder.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_those_of_the_json_vocabulary_as_loaded(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end + end, f"two  {end}\n x", f"it's{end}'s", "<|endoftext|", f"<|{end}|> <|other|>", "no such token", f"{end} word" * 900]
    rows = packing.token_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    want = []
    for k, text in enumerate(texts):
        ids = [*loaded.encode(text, add_special_tokens=False).ids, 0]
        assert (50256 in ids) == (end in text)
        want += [(k, n, start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())) for n, (start, size) in enumerate(packing.cut(len(ids)))]
    assert sorted(map(tuple, rows)) == want


def test_long_runs_of_blanks_have_the_ids_of_the_json_vocabulary(spark):
    """One letter, a blank, a break or a tab a million times and more, and a text of 5 MB."""
    import public_tokenizers
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"a{c * n}b" for c in " \n\t" for n in (1_000_000, 2_000_000)] + ["x" * 200_000, " \n" * 600_000, "word " * 1_000_000]
    rows = packing.token_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    want = []
    for k, text in enumerate(texts):
        ids = [*loaded.encode(text, add_special_tokens=False).ids, 0]
        want += [(k, n, start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())) for n, (start, size) in enumerate(packing.cut(len(ids)))]
    assert sorted(map(tuple, rows)) == want


def test_pieces_and_places(spark, tokenizer, odd, none):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for docs in (odd, texts):
        rows = packing.pack(docs).toPandas()
        expected = []
        for doc_id, text in docs.select("doc_id", "text").collect():
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
            start = 0
            for piece, end in enumerate(range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)):
                crc = zlib.crc32(np.array(ids[start:end], "<u4").tobytes())
                expected.append((-1 if doc_id is None else doc_id, piece, start, end - start, crc))
                start = end
            assert start == len(ids)
        got = rows.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(int)
        assert sorted(got.itertuples(index=False, name=None)) == sorted(expected)
        placed = rows.sort_values(["sequence_id", "offset"])
        before = placed.groupby("sequence_id").length.cumsum() - placed.length
        assert (before == placed.offset).all() and (before + placed.length <= 2048).all()
    assert rows.sequence_id.nunique() <= np.ceil(rows.length.sum() / 2048) * 1.01 + 1
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_every_piece_once(seed):
    random = np.random.default_rng(seed)
    limit = 64
    counts = np.zeros(limit + 1, np.int64)
    lengths = random.integers(1, limit + 1, 5 if seed == 0 else 3000) if seed != 2 else np.full(999, 40)
    counts += np.bincount(lengths, minlength=limit + 1)
    plan = packing.packing_plan(counts, limit)
    used = np.zeros(limit + 1, np.int64)
    for pattern, n in plan:
        assert n > 0 and sum(pattern) <= limit
        for a in pattern:
            used[a] += n
    assert (used == counts).all()
    total = sum(n for _, n in plan)
    # Lengths over half the limit need a sequence each.
    least = max(-(-int((counts * np.arange(limit + 1)).sum()) // limit), int(counts[limit // 2 + 1 :].sum()))
    assert total <= least * 1.02 + 2
    assert packing.packing_plan(np.zeros(limit + 1), limit) == []


def test_ranks_split_a_hot_length(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).alias("start"), F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 7).alias("length"), F.col("id").alias("ids_crc32"))
    got = packing.with_rank(rows, 1000, rows_per_bucket=40).toPandas()
    for _, own in got.groupby("length"):
        assert sorted(own["rank"]) == list(range(len(own)))
