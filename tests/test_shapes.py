"""Nested pages, schemas that change, pattern tables, replayed quarantine and profiles."""

import json
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampType
from test_loads import _record, pages  # noqa: F401

from terrace import operators as op
from terrace import plans, schemas, sinks, sources
from terrace.functions import POSTAL_US
from terrace.schemas import Layout

# --- nested pages ---------------------------------------------------------------------

MAPPING = {
    "$['id']": "id",
    "$['lines'][*]['no']": "no",
    "$['lines'][*]['at']['city']": "city",
    "$['lines'][*]['tags'][*]": "tag",
}


def texts(spark, *documents):
    return spark.createDataFrame([(d if isinstance(d, str) or d is None else json.dumps(d),) for d in documents], "j string")


def test_rows_of_nested_arrays(spark):
    df = texts(
        spark,
        {"id": 1, "lines": [{"no": 7, "at": {"city": "x"}, "tags": ["a", 2.5, {"b": 1}]}, {"no": None, "tags": []}]},
        {"id": "2", "lines": []},
        {"id": True},
        {"id": 4, "lines": {"no": 1}},
        {"id": 5, "lines": [None, 3, {"no": "q", "tags": None}]},
        "no json {",
        None,
    )
    rows = sources.map_json_rows(df, "j", MAPPING, positions=["line"]).drop("j").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([
        ("1", "7", "x", "a", 0), ("1", "7", "x", "2.5", 0), ("1", "7", "x", '{"b":1}', 0), ("1", None, None, None, 1),
        ("2", None, None, None, None), ("true", None, None, None, None), ("4", None, None, None, None),
        ("5", None, None, None, 0), ("5", None, None, None, 1), ("5", "q", None, None, 2),
        (None, None, None, None, None), (None, None, None, None, None),
    ], key=repr)
    some = sources.map_json_rows(df, "j", MAPPING, keep_empty=False).collect()
    assert sorted(r.tag for r in some) == ["2.5", "a", '{"b":1}']
    assert sources.map_json_rows(df.limit(0), "j", MAPPING).collect() == []


def test_what_is_not_mapped_is_kept_as_a_variant(spark):
    df = texts(spark, {"id": 1, "more": [1], "lines": [{"no": 1, "at": {"city": "x", "zip": 9}, "z": None}, {"no": 2}]})
    rows = sources.map_json_rows(df, "j", {"$.id": "id", "$.lines[*].no": "no", "$.lines[*].at.city": "city"}, rest="rest")
    assert dict(rows.dtypes)["rest"] == "variant"
    # An object that is mapped in part stays whole.
    got = rows.select("no", F.to_json("rest"), F.try_variant_get("rest", "$.at.zip", "int")).collect()
    assert [tuple(r) for r in got] == [("1", '{"at":{"city":"x","zip":9},"z":null}', 9), ("2", "{}", None)]
    flat = sources.map_json_rows(df, "j", {"$['id']": "id"}, rest="rest").select("id", F.try_variant_get("rest", "$.more[0]", "int"))
    assert [tuple(r) for r in flat.collect()] == [("1", 1)]


def test_row_paths_that_are_refused(spark):
    df = texts(spark, {}).withColumns({"_value0": F.lit(1), "_place1": F.lit(2)})
    with pytest.raises(ValueError, match="side by side"):
        sources.map_json_rows(df, "j", {"$.a[*].b": "b", "$.c[*].d": "d"})
    with pytest.raises(ValueError, match="not a row path"):
        sources.map_json_rows(df, "j", {"$.a[0]": "b"})
    with pytest.raises(ValueError, match="positions"):
        sources.map_json_rows(df, "j", {"$.a": "b"}, positions=["p"])
    kept = sources.map_json_rows(df, "j", {"$[*].b": "b"})
    assert kept.columns == ["j", "_value0", "_place1", "b"] and kept.count() == 1


def test_nested_files(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"id": 1, "lines": [{"no": 1}, {"no": 2}]}, indent=2))
    (tmp_path / "p2.json").write_text(json.dumps([{"id": 3}]))
    rows = sources.read_json_rows(spark, str(tmp_path), {"$.id": "id", "$.lines[*].no": "no"})
    assert sorted(map(tuple, rows.collect()), key=repr) == [("1", "1"), ("1", "2"), (None, None)]


# --- schemas that change --------------------------------------------------------------


def test_common_types():
    common = sources.common_type
    assert common(IntegerType(), LongType()) == LongType()
    assert common(IntegerType(), DoubleType()) == DoubleType()
    # A double does not hold every long.
    assert common(LongType(), DoubleType()) == StringType()
    assert common(DecimalType(10, 2), LongType()) == DecimalType(22, 2)
    assert common(DecimalType(38, 0), DecimalType(38, 30)) == StringType()
    assert common(TimestampType(), schemas.struct_of("x").fields[0].dataType) == StringType()
    a, b = (StructType.fromDDL(t) for t in ("a int, s struct<x int, y string>, l array<int>", "A bigint, s struct<x bigint, z date>, l array<double>"))
    assert sources.common_schema([a, b]) == StructType.fromDDL("a bigint, s struct<x bigint, y string, z date>, l array<double>")


def test_runs_of_other_schemas_are_read_together(spark, tmp_path):
    layout = Layout(str(tmp_path))
    frames = {
        "2024-01-01": spark.createDataFrame([(1, "01", "x", date(2024, 1, 1))], "id int, state string, gone string, day date"),
        "2": spark.createDataFrame([(1 << 40, "2", 2.5)], "id bigint, state string, fresh double"),
        "3": spark.createDataFrame([(7, "a", 1)], "id int, state string, Fresh int"),
    }
    for run, df in frames.items():
        sinks.write_layer(df, layout.run("typed", run), by=["state"])
    got = sources.read_runs(spark, layout.layer("typed"), list(frames))
    assert dict(got.dtypes) == {"id": "bigint", "gone": "string", "day": "date", "state": "string", "fresh": "double", "run_id": "string"}
    rows = {(r.run_id, r.id, r.state, r.gone, r.fresh) for r in got.collect()}
    assert rows == {("2024-01-01", 1, "01", "x", None), ("2", 1 << 40, "2", None, 2.5), ("3", 7, "a", None, 1.0)}
    drift = sources.schema_drift(spark, sources.run_schemas(spark, layout.layer("typed"), list(frames)))
    told = {(r.run, r.column.lower(), r.change) for r in drift.collect()}
    assert told == {("2", "id", "widened"), ("2", "gone", "missing"), ("2", "day", "missing"), ("2", "fresh", "added"),
        ("3", "id", "narrowed"), ("3", "gone", "missing"), ("3", "day", "missing"), ("3", "fresh", "narrowed")}
    with pytest.raises(ValueError, match="no runs"):
        sources.read_runs(spark, layout.layer("typed"), [])


# --- pattern tables -------------------------------------------------------------------


def test_a_pattern_table_of_any_size_is_one_plan(spark):
    countries = [(f"c{k}", f"^{k}-[0-9]+$") for k in range(5_000)]
    rows = [(f"c{k % 5_000}", f"{k % 5_000 if k % 3 else 'x'}-{k}") for k in range(20_000)] + [("c1", None), (None, "x"), ("no pattern", "x")]
    df = spark.createDataFrame(rows, "country string, postal_code string").repartition(4)
    table = spark.createDataFrame(countries, "country string, pattern string")
    bad = op.invalid_postal_by_table(df, table)
    assert bad.columns == df.columns
    assert sorted(map(tuple, bad.collect())) == sorted(r for k, r in enumerate(rows[:20_000]) if k % 3 == 0)
    plan = lambda t: op.invalid_postal_by_table(df, t)._jdf.queryExecution().optimizedPlan().toString()
    few = spark.createDataFrame(countries[:10], "country string, pattern string")
    assert abs(len(plan(table)) - len(plan(few))) < 100


def test_several_patterns_of_a_country_and_missing_ones(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("a", "?"), ("b", "1"), ("c", "1")], "country string, postal_code string")
    table = spark.createDataFrame([("a", "^[0-9]$"), ("a", "^[a-z]$"), ("a", "^[a-z]$"), ("b", None), (None, "^q$"), ("d", "^q$")], "country string, pattern string")
    assert [tuple(r) for r in op.invalid_postal_by_table(df, table).collect()] == [("a", "?")]
    assert op.invalid_postal_by_table(df, table.limit(0)).isEmpty()


def test_a_load_takes_a_pattern_table(spark, pages, tmp_path):  # noqa: F811
    folder = pages(1, [_record("1"), _record("2", postal_code="X1"), _record("3", country="Norway", postal_code="X1")])
    table = spark.createDataFrame([("united states", "^[0-9]{5}$"), ("norway", "^X[0-9]$")], "country string, pattern string")
    done = plans.load_new_pages(spark, folder, Layout(str(tmp_path / "lake")), "r1", patterns=table, on_fail="quarantine")
    assert done["silver"].metrics["bad_postal"] == 1
    assert {r.id for r in plans.read_silver(spark, done["silver"]).collect()} == {"1", "3"}


# --- replayed quarantine --------------------------------------------------------------


def test_replay_equals_loads_under_the_new_patterns(spark, tmp_path):
    entity = replace(schemas.Entity(), recency={"seen": LongType()})
    batches = [
        [_record("1", postal_code="A1", seen="1"), _record("2", seen="1"), _record("3", postal_code="A3", seen="1"), _record("4", phone=None, postal_code="A4", seen="1")],
        # Newer than what waits in quarantine, older than it, and one that stays bad.
        [_record("1", city="newer", seen="2"), _record("3", city="older", seen="0"), _record("5", postal_code="?", seen="1"), _record("2", postal_code="A2", seen="5")],
    ]
    old, new = {"united states": "^[0-9]{5}$"}, {"united states": "^([0-9]{5}|A[0-9])$"}

    def load(lake, patterns):
        for number, records in enumerate(batches, 1):
            folder = tmp_path / f"pages{number}"
            folder.mkdir(exist_ok=True)
            (folder / f"page-{number}.json").write_text(json.dumps([{"street": "s", **r} for r in records]))
            rows = sources.read_pages(spark, str(folder), entity.read_fields)
            done = plans.run_loads(spark, rows, Layout(str(tmp_path / lake)), f"r{number}", first_page=number, patterns=patterns,
                incremental=True, on_fail="quarantine", entity=entity, tie_break=())
        return done

    def state(done):
        silver = plans.read_silver(spark, done["silver"], entity=entity).select("id", "city", "postal_code", "phone", "seen")
        gold = plans.read_gold(spark, done["gold"], entity).drop(schemas.GOLD_TS)
        return [sorted(map(tuple, df.collect()), key=repr) for df in (silver, gold)]

    at_once = state(load("once", new))
    load("late", old)
    lake = Layout(str(tmp_path / "late"))
    first = plans.replay_quarantine(spark, lake, "replay", new, entity=entity)
    assert state(first) == at_once
    assert [r[1] for r in at_once[0]] == ["newer", "ames", "ames"]
    assert first["replay"].metrics == {"replayed_accepted": 3, "replayed_bad_postal": 1, "replayed_no_contact": 1}
    again = plans.replay_quarantine(spark, lake, "again", new, entity=entity)
    assert state(again) == at_once
    table = spark.createDataFrame(list(new.items()), "country string, pattern string")
    assert state(plans.replay_quarantine(spark, lake, "table", table, entity=entity)) == at_once
    nothing = plans.replay_quarantine(spark, Layout(str(tmp_path / "none")), "x", POSTAL_US, entity=entity)
    assert list(nothing) == ["replay"] and nothing["replay"].metrics == {}


# --- profiles -------------------------------------------------------------------------


def test_merged_profiles_equal_direct_ones(spark, tmp_path):
    layout = Layout(str(tmp_path))
    df = spark.range(30_000).selectExpr(
        "id % 3000 AS a", "if(id % 7 = 0, NULL, string(id % 500)) AS b", "id / 3.0D AS c", "CAST(NULL AS INT) AS n", "string(id % 4) AS state", "id % 3 AS run"
    ).withColumn("c", F.when(F.col("a") == 5, F.lit(float("nan"))).otherwise(F.col("c")))
    columns = ["a", "b", "c", "n"]
    for run in range(3):
        plans.store_profile(df.filter(F.col("run") == run), layout, f"r{run}", columns, ["state"])
    merged = {r.column: r for r in plans.profile_over_runs(spark, layout, ["r0", "r1", "r2"], quantiles=(0.1, 0.5)).collect()}
    direct = {r.column: r for r in op.profile_of(op.column_sketches(df, columns), (0.1, 0.5)).collect()}
    for name in columns:
        for part in ("rows", "nulls", "least", "greatest", "distinct"):
            assert merged[name][part] == direct[name][part], (name, part)
    assert (merged["a"].least, merged["a"].greatest, merged["b"].nulls) == ("0", "2999", 4286)
    assert abs(merged["a"].distinct / 3000 - 1) < 0.05 and abs(merged["c"].distinct / 29_991 - 1) < 0.05
    assert abs(merged["a"].quantiles[1] / 1500 - 1) < 0.05 and merged["n"].quantiles is None and merged["b"].quantiles is None
    by_state = plans.profile_over_runs(spark, layout, ["r0", "r2"], by=["state"])
    assert by_state.count() == 16 and by_state.agg(F.sum("rows")).first()[0] == 4 * 20_000
    assert op.profile_of(op.merged_sketches(op.column_sketches(df.limit(0), columns))).filter("rows > 0").isEmpty()
