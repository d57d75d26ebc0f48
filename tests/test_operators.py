"""Operators on hand-written rows and against brute force."""

from collections import Counter, defaultdict
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace import operators as op
from terrace import schemas


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- cleanse --------------------------------------------------------------------------


def test_project_fills_drops_casts_and_orders(spark):
    df = spark.createDataFrame([("x", 7, "1.5")], "extra string, id long, longitude string")
    out, extra = op.enforce_schema(df, schemas.BRONZE)
    assert out.schema == schemas.BRONZE
    assert extra == ["extra"]
    row = out.first()
    assert (row.id, row.longitude, row.name) == ("7", 1.5, None)


def test_filters_are_complements(spark):
    rows = [(None, None), ("a", None), (None, "b"), ("a", "b")]
    df = spark.createDataFrame(rows, "phone string, website_url string")
    assert op.require_any(df, schemas.CONTACT_FIELDS).count() == 3
    assert _rows(op.missing_all(df, schemas.CONTACT_FIELDS)) == [(None, None)]


def test_drop_null_key_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("1",), (None,)], "id string").write.parquet(str(tmp_path / "t"))
    df = op.drop_null_key(spark.read.parquet(str(tmp_path / "t")))
    assert _rows(df) == [("1",)]
    assert "PushedFilters: [IsNotNull(id)]" in df._jdf.queryExecution().executedPlan().toString()


def test_stamp(spark):
    df = spark.range(100)
    assert op.stamp(df, "ts").select("ts").distinct().count() == 1
    fixed = datetime(2024, 5, 6, 7, 8, 9)
    assert op.stamp(df, "ts", fixed).schema["ts"].dataType.simpleString() == "timestamp"
    assert op.stamp(df, "ts", fixed).select(F.date_format("ts", "yyyy-MM-dd")).first()[0] == "2024-05-06"


# --- dedupe ---------------------------------------------------------------------------

keyed_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
        st.one_of(st.none(), st.integers(0, 3)),
        st.integers(0, 2),
    ),
    max_size=25,
)
relaxed = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
SCHEMA = "id string, seen int, payload int"


def _newest(rows):
    best = {}
    for row in rows:
        rank = tuple(-1 if v is None else v for v in row[1:])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


@relaxed
@given(rows=keyed_rows)
def test_dedupe_matches_brute_force_and_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    once = op.latest_per_key(df, ["id"], ["seen"])
    assert _rows(once) == _newest(rows)
    assert _rows(op.latest_per_key(once, ["id"], ["seen"])) == _newest(rows)


@relaxed
@given(rows=keyed_rows)
def test_counts_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    copies = Counter(r[0] for r in rows)
    repeated = {k: n for k, n in copies.items() if n > 1}
    assert dict(map(tuple, op.duplicate_keys(df, ["id"]).collect())) == repeated
    total, kept = len(rows), len(copies)
    assert tuple(op.reconcile_keys(df, ["id"]).first()) == (total, kept, total - kept, len(repeated))
    assert tuple(op.reconcile(df, df.filter("seen = 1")).first()) == (
        total,
        sum(r[1] == 1 for r in rows),
        total - sum(r[1] == 1 for r in rows),
    )
    rules = {"zero": F.col("payload") == 0}
    newest = op.quality_metrics(df, ["id"], rules, ["seen"], None).first()
    assert tuple(newest) == (
        len(repeated),
        sum(r[2] == 0 for r in _newest(rows) if r[0] is not None),
    )
    every = op.quality_metrics(df, ["id"], rules).first()
    assert tuple(every) == (len(repeated), sum(r[2] == 0 for r in rows if r[0] is not None))


def test_upsert(spark):
    old = spark.createDataFrame([("1", 5, 0), ("2", 1, 0), ("4", 2, 0)], SCHEMA)
    new = spark.createDataFrame([("1", 4, 9), ("2", 1, 9), ("2", 2, 8), ("3", 1, 7), ("4", 2, -1)], SCHEMA)
    once = op.upsert(old, new, ["id"], ["seen"])
    # A late record does not replace a newer one; in a tie the new row wins.
    assert _rows(once) == [("1", 5, 0), ("2", 2, 8), ("3", 1, 7), ("4", 2, -1)]
    assert _rows(op.upsert(once, new, ["id"], ["seen"])) == _rows(once)
    replaced = op.upsert(old, new.filter("id = '1'"), ["id"])
    assert _rows(replaced) == [("1", 4, 9), ("2", 1, 0), ("4", 2, 0)]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(20_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("key"), F.col("id").alias("seen")
    )
    out = op.latest_per_key(df, ["key"], ["seen"], ())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange hashpartitioning(key")
    assert plan.index("Exchange hashpartitioning(key") < plan.index("row_number(), 1, Partial")
    assert out.filter("key is null").first().seen == 19_998


# --- quality --------------------------------------------------------------------------


def test_gate(spark):
    metrics = spark.createDataFrame([(3, 0, 2)], "duplicate_keys long, bad_postal long, no_contact long")
    assert tuple(op.gate(metrics).first())[3:] == (0, True, 1)
    strict = {"bad_postal": 0, "duplicate_keys": 0, "no_contact": 5}
    assert tuple(op.gate(metrics, strict).first())[3:] == (5, False, 0)
    row = metrics.first().asDict()
    op.check_gate(row)
    with pytest.raises(op.QualityGateError, match=r"duplicate_keys=3 \(limit 0\)") as caught:
        op.check_gate(row, strict)
    assert caught.value.metrics == row


def test_metrics_and_reconciliation_are_one_pass(spark, tmp_path):
    """No sort aggregate; each plan scans its input as often as it has shuffles."""
    spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 1, 0)], SCHEMA).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = lambda out: out._jdf.queryExecution().executedPlan().toString()
    metrics = plan(op.quality_metrics(df, ["id"], {"zero": F.col("payload") == 0}, ["seen"]))
    assert "SortAggregate" not in metrics and "WindowGroupLimit" in metrics
    rule = op.reconcile_rule(df, F.col("payload") == 0)
    assert tuple(rule.first()) == (3, 2, 1)
    assert plan(op.reconcile_rule(df, F.col("payload") == 0)).count("FileScan") == 1


def test_unknown_limits_are_refused():
    op.require_known({"bad_postal": 0}, ["bad_postal"])
    with pytest.raises(ValueError, match="no such total: typo"):
        op.require_known({"typo": 0}, ["bad_postal"])


# --- windows --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def measures(spark):
    """A third of the rows in one group, equal measures, and a NULL group."""
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"g{i % 37}")
        rows.append((group, i % 4, i))
    return rows, spark.createDataFrame(rows, "state string, n long, item long").repartition(6)


def order():
    return [F.col("n").desc(), F.col("item").asc()]


def _groups(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return {k: sorted(v, key=lambda r: (-r[1], r[2])) for k, v in groups.items()}


def _ranks(rows):
    ranked = [(*row, i + 1) for group in _groups(rows).values() for i, row in enumerate(group)]
    return sorted(ranked, key=repr)


@pytest.mark.parametrize("slices", [None, 1, 30])
def test_row_numbers_of_a_hot_group(spark, measures, slices):
    rows, df = measures
    out = op.number_rows(df, ["state"], order(), slices=slices)
    assert out.schema["rank"].dataType.simpleString() == "bigint"
    assert _rows(out) == _ranks(rows)


def test_sliced_row_numbers_split_the_hot_group(spark, measures):
    rows, df = measures
    out = op.number_rows(df, ["state"], order(), slices=12)
    assert _rows(out) == _ranks(rows)
    path = out.inputFiles()[0].rsplit("/", 1)[0]
    hot = spark.read.parquet(path).filter("state = 'hot'")
    assert hot.select("_slice").distinct().count() >= 3


def test_top_n(measures):
    rows, df = measures
    for n in (1, 3, 1000):
        expected = sorted((r for g in _groups(rows).values() for r in g[:n]), key=repr)
        assert _rows(op.top_n(df, ["state"], order(), n)) == expected
    with pytest.raises(ValueError, match="number_rows"):
        op.top_n(df, ["state"], order(), 1001)


def test_share_of_group_with_and_without_broadcast(spark, measures):
    rows, df = measures
    totals = {g: sum(r[1] for r in rs) for g, rs in _groups(rows).items()}
    half_up = lambda n, t: ((n * 20000 + t) // (2 * t)) / 100
    expected = sorted(((*r, half_up(r[1], totals[r[0]])) for r in rows), key=repr)
    assert _rows(op.percent_of_group(df, ["state"], "n")) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = op.percent_of_group(df, ["state"], "n")
        assert _rows(out) == expected
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_group_is_split_in_the_share_join(spark):
    """Without broadcast AQE must be able to split the hot group of the join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(200_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("state"),
            F.col("id"),
            F.sha2(F.col("id").cast("string"), 256).alias("wide"),
            F.lit(1).cast("long").alias("n"),
        )
        out = op.percent_of_group(df, ["state"], "n")
        assert len(out.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_rollup_counts_only_present_keys(spark):
    df = spark.createDataFrame([("x", "1"), ("x", None), (None, "2")], "state string, id string")
    assert dict(map(tuple, op.rollup_count(df, ["state"], "id").collect())) == {"x": 1, None: 1}
