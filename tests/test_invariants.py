"""What must hold between the layers, on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from terrace import operators as op
from terrace import plans, schemas, sources
from terrace.schemas import Layout
from terrace.sources.order_feed import order_feed

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    feed = order_feed(spark, SF_DIR)
    layout = Layout(str(tmp_path_factory.mktemp("lake")))
    return plans.run_loads(
        spark, feed, layout, "r1", recency=registry.RECENCY, tie_break=(), on_fail="quarantine"
    )


@pytest.fixture(scope="module")
def gold(spark, done):
    return sources.read_layer(spark, done["gold"].path, schemas.GOLD)


def test_kept_and_dropped_make_the_total(spark, done):
    m = done["bronze"].metrics
    assert m["kept"] + m["dropped"] == m["total"] == order_feed(spark, SF_DIR).count()
    assert sources.read_layer(spark, done["bronze"].path, schemas.BRONZE).count() == m["kept"]


def test_accepted_and_rejected_make_the_keyed_rows(spark, done):
    m = done["silver"].metrics
    silver = sources.read_layer(spark, done["silver"].path, schemas.SILVER)
    quarantine = spark.read.parquet(done["silver"].quarantine)
    bronze = sources.read_layer(spark, done["bronze"].path, schemas.BRONZE)
    assert silver.count() == m["accepted"] and quarantine.count() == m["rejected"]
    assert m["accepted"] + m["rejected"] == op.drop_null_key(bronze).count()
    assert op.duplicate_keys(silver, ["id"]).isEmpty()
    assert silver.join(quarantine, "id", "left_semi").isEmpty()


def test_gold_counts_every_silver_row(done, gold):
    assert gold.agg(F.sum("entity_count")).first()[0] == done["silver"].metrics["accepted"]
    for dim in ("state", "category"):
        total = plans.total_by(gold, dim).agg(F.sum("total_entities")).first()[0]
        assert total == done["silver"].metrics["accepted"]


def test_shares_add_up(gold):
    for rows in (gold, plans.category_grain(gold)):
        sums = plans.share_within_state(rows).groupBy("state").agg(
            F.sum("percentage").alias("p"), F.count("*").alias("n")
        )
        assert all(abs(r.p - 100) <= 0.005 * r.n + 1e-9 for r in sums.collect())


def test_winners_cover_every_state_once(gold):
    winners = plans.popular_categories(gold)
    assert winners.agg(F.sum("states")).first()[0] == gold.select("state").distinct().count()


def test_same_run_twice_gives_the_same_rows(spark, done, tmp_path):
    """The survivors do not depend on how the input is partitioned."""
    again = plans.run_loads(
        spark,
        order_feed(spark, SF_DIR).repartition(7, "seen_at"),
        Layout(str(tmp_path)),
        "r2",
        recency=registry.RECENCY,
        tie_break=(),
        on_fail="quarantine",
    )
    stamps = (schemas.BRONZE_TS, schemas.SILVER_TS)
    first, second = (
        sources.read_layer(spark, d["silver"].path, schemas.SILVER).drop(*stamps) for d in (done, again)
    )
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
