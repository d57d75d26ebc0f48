"""The stages one by one against plain Python, and the registered DuckDB texts."""

import os
import sys

import duckdb
import pytest

import corpus_pipeline
from terrace.llm import decontam, registry, toxicity

sys.path.insert(0, os.path.dirname(__file__))

from test_duplicates import brute_groups, kept_lines  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, by name."""
    out, rows = {}, spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, rows, SF).write.parquet(path)
        out[name] = rows, spark.read.parquet(path)
        rows = out[name][1]
    return out


def plain(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_order_and_columns(stages, spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "packing")


def test_toxicity_drops_what_its_model_rejects(stages, spark):
    before, after = stages["toxicity"]
    model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = plain(before)
    scores = model.scores(toxicity.Lookup(model.features), [t or "" for _, t in rows])
    assert plain(after) == [r for r, s in zip(rows, scores) if s < 0.3]
    assert 0.8 * len(rows) < after.count() < len(rows)


def test_lines(stages):
    before, after = stages["line_dedup"]
    assert plain(after) == sorted((i, t) for i, _, _, t in kept_lines(plain(before)))
    changed = after.filter("n_chars <> length(text)").count()
    assert changed == before.filter("n_chars <> length(text)").count()


def test_near_copies(stages):
    before, after = stages["near_dedup"]
    rows = plain(before)
    # Wordless texts are groups of their own.
    assert plain(after) == sorted(r for r, g in zip(rows, brute_groups(rows)) if g == r[0])


def test_decontamination(stages, spark):
    before, after = stages["decontamination"]
    items = [decontam.normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [r for r in plain(before) if not any(i in decontam.normalised(r[1]) for i in items)]
    assert plain(after) == left and len(left) < before.count()


def test_packing_takes_every_document(stages):
    before, after = stages["packing"]
    assert after.select("doc_id").distinct().count() == before.count()
    assert after.agg({"offset": "min"}).first()[0] == 0


def test_run_is_the_stages_in_turn(stages, spark):
    whole = corpus_pipeline.run(spark, SF)
    last = stages["packing"][1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, last.select(columns).collect()))


def test_stages_take_odd_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            columns = rows.columns
            rows = stage(spark, rows, "/root/testdata/sf0.001")
            if name != "packing":
                assert rows.columns == columns
                rows = spark.createDataFrame(rows.collect(), rows.schema)
        assert (rows.count() == 0) == (docs is none)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows_as_the_text(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    duck.execute(registry.SQL[name])
    columns = [d[0] for d in duck.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == sorted(duck.fetchall(), key=repr)
