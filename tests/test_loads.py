"""The loads from page files to gold, and what stops them."""

import glob
import importlib
import json
import os

import pytest
from pyspark.sql import functions as F

from terrace import plans, schemas, sources
from terrace.operators import QualityGateError
from terrace.schemas import Layout
from terrace.sinks import StaleBaseError


def _record(key, **fields):
    base = {
        "id": key,
        "name": "Chain A",
        "category": "Micro",
        "city": "Ames",
        "state": "Iowa",
        "country": "United States",
        "postal_code": "50010",
        "longitude": "-93.5",
        "latitude": "42.0",
        "phone": "555",
        "website_url": None,
    }
    return {**base, **fields}


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()

    def put(number, records):
        (folder / f"page-{number}.json").write_text(json.dumps(records))
        return str(folder)

    return put


def _run(spark, folder, root, run_id="r1", **options):
    rows = sources.read_pages(spark, folder)
    listed = sources.list_pages(spark, folder)
    return plans.run_loads(spark, rows, Layout(str(root)), run_id, listed, **options)


def _layer(spark, load, schema):
    return sources.read_layer(spark, load.path, schema)


def test_chain(spark, pages, tmp_path):
    pages(1, [_record("1"), _record("2", state="OHIO", phone=None, website_url="w"), _record(None)])
    pages(2, [])
    folder = pages(3, [_record("1", city="Boone", longitude="n/a"), _record("3", phone=None)])
    done = _run(spark, folder, tmp_path / "lake")
    assert done["bronze"].metrics == {
        "boundary": 4,
        "pages_read": 3,
        "broken": False,
        "truncated": False,
        "unnumbered": 0,
        "skipped": 0,
        "pages_left_out": 0,
        "rows_left_out": 0,
        "total": 5,
        "kept": 4,
        "dropped": 1,
        "duplicate_keys": 1,
        "coord_malformed": 1,
        "blank_partition": 0,
        "empty_fields": 1,
    }
    bronze = {r.id: r for r in _layer(spark, done["bronze"], schemas.BRONZE).collect()}
    assert len(bronze) == 4 and bronze["1"].city == "Boone" and bronze["1"].longitude is None
    assert bronze["2"].longitude == -93.5 and bronze["2"].ts_load_timestamp is not None
    assert done["silver"].metrics == {
        # The bronze load resolved these two; the gate still sees them.
        "duplicate_keys": 1,
        "coord_malformed": 1,
        "bad_postal": 0,
        "no_contact": 1,
        "postal_missing": 0,
        "rejected": 1,
        "accepted": 2,
    }
    silver = {r.id: r for r in _layer(spark, done["silver"], schemas.SILVER).collect()}
    assert set(silver) == {"1", "2"}
    assert (silver["1"].name, silver["1"].state, silver["2"].state) == ("chain a", "iowa", "ohio")
    assert silver["1"].phone.startswith("91a73fd8") and silver["2"].phone is None
    assert done["silver"].quarantine is None
    gold = _layer(spark, done["gold"], schemas.GOLD)
    assert gold.agg(F.sum("entity_count")).first()[0] == 2
    assert gold.columns == schemas.GOLD.names


def test_gate_stops_the_chain_and_leaves_earlier_runs(spark, pages, tmp_path):
    lake = tmp_path / "lake"
    folder = pages(1, [_record("1")])
    first = _run(spark, folder, lake)
    pages(1, [_record("1"), _record("2", postal_code="123")])
    with pytest.raises(QualityGateError, match="bad_postal=1"):
        _run(spark, folder, lake, "r2")
    assert os.path.exists(lake / "bronze" / "run_id=r2")
    assert not os.path.exists(lake / "silver" / "run_id=r2")
    assert not os.path.exists(lake / "gold" / "run_id=r2")
    assert _layer(spark, first["silver"], schemas.SILVER).count() == 1


def test_quarantine_keeps_every_row(spark, pages, tmp_path):
    bad = [_record("2", postal_code="123"), _record("3", postal_code="9", phone=None)]
    folder = pages(1, [_record("1"), *bad, _record("4", phone=None), _record("5", postal_code=None)])
    done = _run(spark, folder, tmp_path / "lake", on_fail="quarantine")
    silver = _layer(spark, done["silver"], schemas.SILVER).collect()
    assert sorted(r.id for r in silver) == ["1", "5"]
    kept_aside = spark.read.parquet(done["silver"].quarantine)
    found = sorted((r.verdict, r.id) for r in kept_aside.collect())
    assert found == [("bad_postal", "2"), ("bad_postal", "3"), ("no_contact", "4")]
    assert all(len(r.phone) == 64 for r in kept_aside.filter("phone IS NOT NULL").collect())
    assert done["silver"].metrics["bad_postal"] == 2 and done["silver"].metrics["no_contact"] == 2
    assert done["silver"].metrics["postal_missing"] == 1


def test_limits_and_options(spark, pages, tmp_path):
    folder = pages(1, [_record("1"), _record("2", phone=None)])
    with pytest.raises(QualityGateError, match="no_contact=1"):
        _run(spark, folder, tmp_path / "a", limits={"no_contact": 0})
    with pytest.raises(QualityGateError, match="no_contact=1"):
        _run(spark, folder, tmp_path / "q", limits={"no_contact": 0}, on_fail="quarantine")
    with pytest.raises(ValueError, match="no such total: coord_bad"):
        _run(spark, folder, tmp_path / "u", limits={"coord_bad": 0})
    assert not os.path.exists(tmp_path / "u")
    with pytest.raises(ValueError, match="on_fail"):
        _run(spark, folder, tmp_path / "b", on_fail="ignore")
    with pytest.raises(QualityGateError):
        _run(spark, folder, tmp_path / "c", patterns={"united states": "^[A-Z]$"})


def test_bronze_totals_reach_the_gate(spark, pages, tmp_path):
    folder = pages(1, [_record("1"), _record("1", longitude="n/a"), _record("2")])
    for name in ("duplicate_keys", "coord_malformed"):
        for on_fail in ("raise", "quarantine"):
            lake = tmp_path / f"{name}-{on_fail}"
            with pytest.raises(QualityGateError, match=f"{name}=1"):
                _run(spark, folder, lake, limits={name: 0}, on_fail=on_fail)
            assert not os.path.exists(lake / "silver") and not os.path.exists(lake / "gold")
            stored = {(r.load, r.metric): r.value for r in spark.read.parquet(str(lake / "metrics")).collect()}
            assert stored["silver", name] == stored["bronze", name] == 1
        assert "gold" in _run(spark, folder, tmp_path / f"{name}-ok", limits={name: 1})


def test_thirteen_pages_are_thirteen_pages(spark, pages, tmp_path):
    for number in range(1, 14):
        folder = pages(number, [_record(str(number))])
    done = _run(spark, folder, tmp_path / "lake")
    assert done["bronze"].metrics["pages_read"] == done["bronze"].metrics["kept"] == 13
    some = _run(spark, folder, tmp_path / "some", total_pages=10)["bronze"].metrics
    assert (some["kept"], some["pages_left_out"], some["rows_left_out"], some["truncated"]) == (10, 3, 3, True)


def test_a_page_before_the_first_is_refused(spark, pages, tmp_path):
    pages(0, [_record("0")])
    folder = pages(1, [_record("1")])
    with pytest.raises(plans.TruncatedLoadError, match="2 records or files on pages before page 1"):
        _run(spark, folder, tmp_path / "lake")
    done = _run(spark, folder, tmp_path / "zero", first_page=0)
    assert done["bronze"].metrics["kept"] == 2


def test_unnumbered_pages_are_refused(spark, pages, tmp_path):
    folder = pages(1, [_record("1")])
    (tmp_path / "pages" / "extra.json").write_text(json.dumps([_record("2"), _record("3")]))
    with pytest.raises(plans.UnnumberedPageError, match="3 records or files"):
        _run(spark, folder, tmp_path / "lake")
    done = _run(spark, folder, tmp_path / "all", allow_unnumbered=True)
    assert done["bronze"].metrics["kept"] == 3


def test_truncated_load_is_refused(spark, pages, tmp_path):
    pages(1, [_record("1")])
    folder = pages(3, [_record("3")])
    with pytest.raises(plans.TruncatedLoadError, match="page 2"):
        _run(spark, folder, tmp_path / "lake")
    assert not os.path.exists(tmp_path / "lake" / "bronze")
    done = _run(spark, folder, tmp_path / "lake", "r2", allow_truncated=True)
    assert [r.id for r in _layer(spark, done["bronze"], schemas.BRONZE).collect()] == ["1"]
    assert done["bronze"].metrics["truncated"] is True
    assert done["bronze"].metrics["pages_left_out"] == done["bronze"].metrics["rows_left_out"] == 1


def test_failed_page_cuts_the_load(spark, pages, tmp_path):
    folder = pages(1, [_record("1")])
    (tmp_path / "pages" / "page-2.json").write_text('[{"id": "2"}, {"id"')
    with pytest.raises(plans.TruncatedLoadError, match="page 2"):
        _run(spark, folder, tmp_path / "lake")


def test_empty_batch_writes_nothing(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    done = _run(spark, str(folder), tmp_path / "lake")
    assert done["bronze"].path is None and "silver" not in done
    assert not os.path.exists(tmp_path / "lake" / "bronze")


def test_nothing_accepted(spark, pages, tmp_path):
    folder = pages(1, [_record("1", phone=None)])
    done = _run(spark, folder, tmp_path / "lake")
    assert done["silver"].path is None and "gold" not in done


def test_foreign_bronze_with_duplicates(spark, tmp_path):
    rows = [("1", "a", "123", "t1"), ("1", "b", "50010", "t2"), ("2", "a", "50010", "t1")]
    bronze = spark.createDataFrame(rows, "id string, name string, postal_code string, t string").select(
        "id",
        "name",
        "postal_code",
        F.lit("United States").alias("country"),
        F.lit("555").alias("phone"),
        F.when(F.col("t") == "t1", F.lit("2024-01-01")).otherwise("2024-01-02").cast("timestamp").alias("ts_load_timestamp"),
    )
    from terrace.operators import project

    load = plans.load_silver(project(bronze, schemas.BRONZE), Layout(str(tmp_path)), "r1")
    # The older row of id 1 has the bad code; the newer one survives and passes.
    assert load.metrics["duplicate_keys"] == 1 and load.metrics["bad_postal"] == 0
    found = sources.read_layer(spark, load.path, schemas.SILVER).collect()
    assert sorted((r.id, r.name) for r in found) == [("1", "b"), ("2", "a")]


def test_silver_is_one_file_per_state_however_bronze_is_stored(spark, pages, tmp_path):
    folder = pages(1, [_record(str(i), state=f"s{i % 4}") for i in range(40)])
    done = _run(spark, folder, tmp_path / "lake")
    assert len(glob.glob(f"{done['silver'].path}/*/*.parquet")) == 4
    foreign = sources.read_layer(spark, done["bronze"].path, schemas.BRONZE).repartition(8)
    load = plans.load_silver(foreign, Layout(str(tmp_path / "other")), "r1")
    assert len(glob.glob(f"{load.path}/*/*.parquet")) == 4
    assert not os.path.exists(tmp_path / "other" / "staging" / "run_id=r1")


def test_one_wide_dedupe_per_silver_load(spark, tmp_path, monkeypatch):
    """The window over whole rows stands in one write; silver and quarantine read its result."""
    from terrace.plans import loads

    written = []
    plain = loads.write_layer
    monkeypatch.setattr(loads, "write_layer", lambda df, path, *a, **k: (written.append((path, df._jdf.queryExecution().executedPlan().toString())), plain(df, path, *a, **k)))
    bronze = spark.createDataFrame([_record("1"), _record("1", city="B"), _record("2", phone=None)], schemas.RAW)
    from terrace.operators import project

    load = plans.load_silver(project(bronze, schemas.BRONZE), Layout(str(tmp_path)), "r1", on_fail="quarantine")
    assert load.metrics["duplicate_keys"] == 1 and load.quarantine
    assert [("staging" in path, "Window" in plan) for path, plan in written] == [(True, True), (False, False)]


def test_incremental_loads_equal_one_load(spark, pages, tmp_path):
    """Late, rejected and repeated records in three batches against all at once."""
    from dataclasses import replace

    from pyspark.sql.types import LongType

    entity = replace(schemas.Entity(), recency={"seen": LongType()})
    batches = [
        [_record("1", seen="1"), _record("2", seen="5"), _record("3", seen="9"), _record("6", phone=None, seen="9")],
        [_record("1", city="Boone", seen="2"), _record("2", city="late", seen="4"), _record("6", seen="8")],
        [_record("3", phone=None, seen="10"), _record("1", phone=None, seen="1"), _record("5", seen="1")],
    ]

    def load(records, run_id, **options):
        rows = spark.createDataFrame([{**r, "street": "s", "page": options.get("first_page", 1), "page_failed": False} for r in records],
            "id string, name string, category string, street string, city string, state string, postal_code string, "
            "country string, longitude string, latitude string, phone string, website_url string, seen string, page long, page_failed boolean")
        return plans.run_loads(spark, rows, Layout(str(tmp_path / "lake")), run_id, entity=entity, tie_break=(), **options)

    columns = [*schemas.ENTITY.names, "seen"]
    previous = None
    for number, records in enumerate(batches, 1):
        done = load(records, f"r{number}", incremental=True, previous_run=previous, first_page=number)
        previous = f"r{number}"
    merged = plans.read_silver(spark, done["silver"], previous, entity).select(columns).collect()
    whole = load([r for b in batches for r in b], "whole")
    at_once = sources.read_layer(spark, whole["silver"].path, entity.silver).select(columns).collect()
    assert sorted(merged, key=repr) == sorted(at_once, key=repr)
    assert sorted((r.id, r.city) for r in merged) == [("1", "boone"), ("2", "ames"), ("5", "ames")]
    with pytest.raises(StaleBaseError, match="run r3 lies on r2 already"):
        load(batches[2], "kept", incremental=True, previous_run="r2", first_page=3)
    kept = load(batches[2], "kept", incremental=True, previous_run="r2", branch=True, first_page=3, rejected_updates="keep")
    assert sorted(r.id for r in plans.read_silver(spark, kept["silver"], "kept", entity).collect()) == ["1", "2", "3", "5"]


def test_an_entity_under_other_names(spark, tmp_path):
    entity = schemas.Entity(
        fields=("code", "title", "kind", "region", "price", "mail"),
        key=("code",),
        text=("title", "kind"),
        contact=("mail",),
        coordinates=("price",),
        masked=("mail",),
        dims=("kind", "region"),
        partition="region",
        country="kind",
        postal="code",
        source={"title": "item_title", "kind": "item_kind"},
    )
    rows = [("1", "A", "Tool", "n", "2.5", "m", 1, False), ("2", "B", "TOOL", "n", "x", None, 1, False)]
    pages = spark.createDataFrame(rows, "code string, item_title string, item_kind string, region string, price string, mail string, page long, page_failed boolean")
    done = plans.run_loads(spark, pages, Layout(str(tmp_path)), "r1", entity=entity)
    gold = sources.read_layer(spark, done["gold"].path, entity.gold).drop(schemas.GOLD_TS).collect()
    assert [tuple(r) for r in gold] == [("tool", "n", 1)]
    assert done["bronze"].metrics["coord_malformed"] == 1
    with pytest.raises(ValueError, match="no field item_kind"):
        plans.run_loads(spark, pages.drop("item_kind"), Layout(str(tmp_path)), "r2", entity=entity)


def test_published_gold_is_the_run(spark, pages, tmp_path):
    folder = pages(1, [_record("1"), _record("2")])
    names = {"silver": "silver.load_test", "gold": "gold.load_test"}
    _run(spark, folder, tmp_path / "lake", "2026-12-04", publish=names)
    assert spark.table("silver.load_test").count() == 2
    assert spark.sql("SELECT sum(entity_count) FROM gold.load_test").first()[0] == 2
    pages(1, [_record("3")])
    _run(spark, folder, tmp_path / "lake", "2026-12-05", publish=names)
    assert spark.table("silver.load_test").count() == 1


def test_fixed_stamp_reaches_all_layers(spark, pages, tmp_path):
    from datetime import datetime

    folder = pages(1, [_record("1")])
    done = _run(spark, folder, tmp_path / "lake", ts=datetime(2024, 1, 2, 3, 4, 5))
    text = lambda load, schema, c: _layer(spark, load, schema).select(F.col(c).cast("string")).first()[0]
    assert text(done["gold"], schemas.GOLD, schemas.GOLD_TS) == "2024-01-02 03:04:05"
    assert text(done["silver"], schemas.SILVER, schemas.SILVER_TS) == "2024-01-02 03:04:05"
    assert text(done["bronze"], schemas.BRONZE, schemas.BRONZE_TS) == "2024-01-02 03:04:05"


# --- runs that are stopped, repeated and merged ---------------------------------------


def _daily(spark, folder, root, run_id, **options):
    return plans.load_new_pages(spark, folder, Layout(str(root)), run_id, **options)


def _cities(spark, load):
    return {r.id: r.city for r in plans.read_silver(spark, load).collect()}


def test_a_stopped_run_is_repeated_under_its_id_and_under_another(spark, pages, tmp_path):
    lake = tmp_path / "lake"
    folder = pages(1, [_record("1"), _record("2")])
    _daily(spark, folder, lake, "r1")
    pages(2, [_record("3"), _record("4", postal_code="bad")])
    for _ in range(2):
        with pytest.raises(QualityGateError, match="bad_postal=1"):
            _daily(spark, folder, lake, "r2")
    states = {r.page: (r.state, r.label) for r in plans.page_states(spark, Layout(str(lake))).collect()}
    assert states == {1: ("loaded", "r1"), 2: ("refused", "r2-attempt2")}
    stored = spark.read.parquet(f"{lake}/metrics/run_id=r2-attempt2")
    assert stored.filter("load = 'silver' AND metric = 'bad_postal'").first().value == 1
    done = _daily(spark, folder, lake, "r2", on_fail="quarantine")
    assert _cities(spark, done["silver"]) == dict.fromkeys("123", "ames")
    assert done["silver"].merge.run_id == "r2-attempt3" and done["silver"].merge.previous == "r1"
    with pytest.raises(ValueError, match="run r2 is finished"):
        _daily(spark, folder, lake, "r2")
    pages(3, [_record("5", postal_code="bad")])
    with pytest.raises(QualityGateError):
        _daily(spark, folder, lake, "r3")
    done = _daily(spark, folder, lake, "r4", on_fail="quarantine")
    assert _cities(spark, done["silver"]) == dict.fromkeys("123", "ames")
    assert _daily(spark, folder, lake, "r5") == {}
    pages(4, [_record("6")])
    with pytest.raises(ValueError, match="no such total"):
        _daily(spark, folder, lake, "r5", limits={"none": 1})
    assert set(_cities(spark, _daily(spark, folder, lake, "r5")["silver"])) == set("1236")
    assert [r.run_id for r in plans.finished_runs(spark, Layout(str(lake)))] == ["r1", "r2", "r4", "r5"]


def test_a_full_run_is_repeated_too(spark, pages, tmp_path):
    folder = pages(1, [_record("1", postal_code="bad")])
    with pytest.raises(QualityGateError):
        _run(spark, folder, tmp_path / "lake")
    pages(1, [_record("1")])
    done = _run(spark, folder, tmp_path / "lake")
    assert done["gold"].path.endswith("run_id=r1-attempt2")


def test_a_repaired_page_is_loaded_alone(spark, pages, tmp_path):
    lake = tmp_path / "lake"
    pages(1, [_record("1")])
    folder = pages(3, [_record("3"), _record("2", city="newer")])
    (tmp_path / "pages" / "page-2.json").write_text('[{"id": "2"}, {"id"')
    with pytest.raises(plans.TruncatedLoadError, match="page 2"):
        _daily(spark, folder, lake, "r1")
    done = _daily(spark, folder, lake, "r1", skip_failed=True)
    assert _cities(spark, done["silver"]) == {"1": "ames", "2": "newer", "3": "ames"}
    assert done["bronze"].metrics["pages_left_out"] == 1
    pages(2, [_record("2", city="older"), _record("9")])
    again = _daily(spark, folder, lake, "r2")
    landed = spark.read.parquet(again["landing"].path)
    assert {r.page for r in landed.collect()} == {2}
    assert set(_cities(spark, again["silver"])) == {"1", "2", "3", "9"}
    states = {r.page: r.state for r in plans.page_states(spark, Layout(str(lake))).collect()}
    assert states == dict.fromkeys((1, 2, 3), "loaded")


def test_pages_behind_a_gap_wait_for_it(spark, pages, tmp_path):
    lake = tmp_path / "lake"
    pages(1, [_record("1")])
    folder = pages(3, [_record("3")])
    done = _daily(spark, folder, lake, "r1", allow_truncated=True)
    assert set(_cities(spark, done["silver"])) == {"1"}
    assert {r.page: r.state for r in plans.page_states(spark, Layout(str(lake))).collect()} == {1: "loaded", 3: "left"}
    pages(2, [])
    done = _daily(spark, folder, lake, "r2")
    assert set(_cities(spark, done["silver"])) == {"1", "3"}


def test_a_second_run_keeps_the_first_ones_rows(spark, pages, tmp_path):
    """Without a stated base a run lies on the newest finished one, not on nothing."""
    lake = tmp_path / "lake"
    folder = pages(1, [_record(str(i)) for i in range(300)])
    _run(spark, folder, lake, "r1", incremental=True)
    folder = pages(1, [_record(f"x{i}") for i in range(5)])
    done = _run(spark, folder, lake, "r2", incremental=True)
    assert plans.read_silver(spark, done["silver"]).count() == 305
    with pytest.raises(StaleBaseError, match="no finished incremental run"):
        _run(spark, folder, lake, "r3", incremental=True, previous_run="r0")
    done = _run(spark, folder, lake, "r3", incremental=True, fresh=True)
    assert plans.read_silver(spark, done["silver"]).count() == 5


def test_a_crash_between_silver_and_gold_loses_nothing(spark, pages, tmp_path, monkeypatch):
    lake = tmp_path / "lake"
    folder = pages(1, [_record("1"), _record("2")])
    _daily(spark, folder, lake, "r1")
    pages(2, [_record("2", city="Boone"), _record("3")])
    from terrace.plans import loads

    plain = loads.load_gold_changes

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(loads, "load_gold_changes", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        _daily(spark, folder, lake, "r2")
    monkeypatch.setattr(loads, "load_gold_changes", plain)
    done = _daily(spark, folder, lake, "r2")
    counts = {r.city: r.entity_count for r in plans.read_gold(spark, done["gold"]).collect()}
    assert counts == {"ames": 2, "boone": 1}


def test_gold_by_changes_equals_gold_at_once_and_reads_touched_buckets(spark, pages, tmp_path):
    lake = tmp_path / "lake"
    batches = [
        [_record(str(i), city=f"c{i % 4}") for i in range(60)],
        [_record("1", city="c9"), _record("2", phone=None), _record("70", state="OHIO"), _record("3")],
        [_record("2", city="c1"), _record("70", postal_code="bad"), _record("5", name="Other", category=None)],
    ]
    for number, records in enumerate(batches, 1):
        folder = pages(number, records)
        done = _daily(spark, folder, lake, f"r{number}", on_fail="quarantine")
        silver = plans.read_silver(spark, done["silver"])
        at_once = silver.groupBy(*schemas.GOLD_DIMS).agg(F.count("id").alias("entity_count"))
        by_changes = plans.read_gold(spark, done["gold"]).drop(schemas.GOLD_TS)
        assert by_changes.exceptAll(at_once).isEmpty() and at_once.exceptAll(by_changes).isEmpty()
    layer = plans.gold_layer(Layout(str(lake)))
    # The last run brought three keys; its gold delta holds just the groups they left and entered.
    assert layer.delta(spark, "r3").count() <= 6
    assert not os.path.exists(lake / "gold")


def test_totals_are_counted_from_stored_rows(spark, pages, tmp_path):
    """A task that runs twice does not count twice."""
    folder = pages(1, [_record("1", postal_code="bad"), _record("2", phone=None), _record("3")])
    rows = sources.read_pages(spark, folder)
    done = plans.run_loads(spark, rows, Layout(str(tmp_path / "lake")), "r1", sources.list_pages(spark, folder), on_fail="quarantine")
    stage = str(tmp_path / "stage")
    flags = {n: f"rule_{n}" for n in ("bad_postal", "no_contact", "postal_missing")}
    frame = spark.createDataFrame([(True, False, False, "bad_postal"), (False, True, False, "no_contact"), (False, False, False, "accepted")],
        "rule_bad_postal boolean, rule_no_contact boolean, rule_postal_missing boolean, verdict string")
    frame.write.partitionBy("verdict").parquet(stage)
    from terrace.plans import loads

    counted = loads._staged_totals(spark, stage, flags)
    assert counted == {k: done["silver"].metrics[k] for k in counted}
    assert "Observation(f\"silver" not in open(loads.__file__).read()


def test_published_gold_of_an_incremental_run(spark, pages, tmp_path):
    lake = tmp_path / "lake"
    folder = pages(1, [_record("1"), _record("2")])
    _daily(spark, folder, lake, "d1", publish={"gold": "gold.daily_test"})
    assert spark.sql("SELECT sum(entity_count) FROM gold.daily_test").first()[0] == 2
    pages(2, [_record("3")])
    _daily(spark, folder, lake, "d2", publish={"gold": "gold.daily_test"})
    assert spark.sql("SELECT sum(entity_count) FROM gold.daily_test").first()[0] == 3


def test_the_ledger_is_not_written_by_tasks_of_many_partitions(spark, tmp_path, monkeypatch):
    """Such a task holds the table of the join with the loaded files once for each of them."""
    ledger = importlib.import_module("terrace.plans.ledger")
    plans_of, write = [], ledger.write_layer

    def write_layer(rows, *args, **options):
        plans_of.append(rows._jdf.queryExecution().optimizedPlan().toString())
        write(rows, *args, **options)

    monkeypatch.setattr(ledger, "write_layer", write_layer)
    layout = Layout(str(tmp_path / "lake"))
    files = spark.range(0, 400, 1, 40).select(
        F.format_string("file-%03d", "id").alias("file"), F.col("id").alias("length"),
        F.current_timestamp().alias("modified"), F.col("id").alias("page"), F.lit("seen").alias("state"), F.lit("").alias("reason"),
    )
    path = ledger._record(files, layout, "r1", "r1", "seen")
    assert len(plans_of) == 1 and "Repartition 8, false" not in plans_of[0]
    assert len(glob.glob(f"{path}/*.parquet")) <= 8
    stored = spark.read.schema(ledger.LEDGER).parquet(path)
    assert sorted(r.page for r in stored.collect()) == list(range(400))


def test_new_page_files_are_loaded_without_their_names_on_the_driver(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "pages")
    rows = spark.createDataFrame([(*_record(str(n)).values(), n // 2 + 1) for n in range(12)], f"{' string, '.join(_record(''))} string, page long")
    sources.write_pages(rows, folder)

    def held(*args, **options):
        raise AssertionError("the files are listed on the driver")

    for module in ("terrace.plans.ledger", "terrace.sources.pages"):
        monkeypatch.setattr(importlib.import_module(module), "read_pages", held, raising=False)
    lake = Layout(str(tmp_path / "lake"))
    done = plans.load_new_pages(spark, folder, lake, "r1", False)
    assert plans.read_silver(spark, done["silver"]).count() == 12
    assert plans.load_new_pages(spark, folder, lake, "r2", False) == {}
    assert {(r.page, r.state) for r in plans.page_states(spark, lake).collect()} == {(p, "loaded") for p in range(1, 7)}


def _joins(df):
    return [w for w in df._jdf.queryExecution().sparkPlan().toString().split() if w.endswith("Join")]


def test_paths_of_files_are_not_broadcast(spark, pages, tmp_path):
    lake, folder = Layout(str(tmp_path / "lake")), pages(1, [_record("1")])
    plans.load_new_pages(spark, folder, lake, "r1")
    pages(2, [_record("2")])
    found = plans.open_files(spark, folder, lake)
    assert _joins(found) == ["SortMergeJoin"]
    assert [r.page for r in found.collect()] == [2]


def test_many_customers_are_not_broadcast(spark, tmp_path, monkeypatch):
    feed = importlib.import_module("terrace.sources.order_feed")
    for name, rows in {
        "orders": "SELECT id AS o_orderkey, id % 3 AS o_custkey, timestamp_ntz'2020-01-01' AS o_orderdate FROM range(9)",
        "customer": "SELECT id AS c_custkey, int(id) AS c_nationkey, 'x' AS c_mktsegment FROM range(2)",
        "nation": "SELECT int(id) AS n_nationkey, 'n' AS n_name, 0 AS n_regionkey FROM range(2)",
        "region": "SELECT 0 AS r_regionkey, 'r' AS r_name",
    }.items():
        spark.sql(rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    few = feed.order_feed(spark, str(tmp_path))
    monkeypatch.setattr(feed, "_MOST_BROADCAST", 0)
    many = feed.order_feed(spark, str(tmp_path))
    assert "SortMergeJoin" in _joins(many) and "SortMergeJoin" not in _joins(few)
    assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, few.collect()), key=repr)
