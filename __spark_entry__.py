"""Registered queries over the given tables, and their DuckDB texts."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, TimestampNTZType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_texts import TEXTS  # noqa: E402
from terrace import operators as op  # noqa: E402
from terrace import plans, schemas, sinks, sources  # noqa: E402
from terrace.functions import POSTAL_US, any_present, coordinate_malformed, masked  # noqa: E402
from terrace.schemas import GOLD_DIMS, Layout  # noqa: E402
from terrace.session import scratch_dir  # noqa: E402
from terrace.sources.order_feed import order_feed  # noqa: E402
from terrace.sources.pages import stream_pages  # noqa: E402
from terrace.streaming import land_new_pages, recency_columns, stream_upserts  # noqa: E402

try:
    import corpus_pipeline  # noqa: F401
    from terrace.llm import registry as llm_registry
except ModuleNotFoundError as gone:
    # Only the absence of the subpackage itself is allowed.
    if gone.name not in {"corpus_pipeline", "terrace.llm"}:
        raise
    llm_registry = None

SF_DIR = "/root/testdata/sf0.001"
FIELDS = schemas.RAW.names
# In this feed `seen_at` and then the unique `seq` say which record of an id is newest.
RECENCY = ("seen_at", "seq")
POSTAL_PATTERNS = {
    **POSTAL_US,
    "europe": "^[0-9]{5}$",
    "asia": "^[0-9]{5}-[0-9]{4}$",
}
Query = Callable[[SparkSession, str], DataFrame]


# --- the layers as one lazy plan ------------------------------------------------------


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_coords(op.latest_per_key(order_feed(spark, sf_dir), ["id"], RECENCY, ()))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.refine(bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.mask(op.require_any(clean(spark, sf_dir), schemas.CONTACT_FIELDS)).select(*FIELDS)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rollup_count(silver(spark, sf_dir), GOLD_DIMS, "id")


# --- sources --------------------------------------------------------------------------


def _pages_with_a_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with the page nine tenths of the way through marked as failed."""
    raw = order_feed(spark, sf_dir)
    lost = raw.agg(F.floor(F.max("page") * 9 / 10)).scalar()
    return raw.withColumn("page_failed", F.col("page") == lost)


def src_page_prefix(spark, sf_dir):
    rows = _pages_with_a_loss(spark, sf_dir)
    return sources.keep_page_prefix(rows, sources.page_boundary(rows)).select("seq", "page", *FIELDS)


def src_page_report(spark, sf_dir):
    return sources.page_boundary(_pages_with_a_loss(spark, sf_dir))


def _write_page_files(spark, sf_dir, label) -> str:
    """The whole feed as JSON page files under their page numbers, one folder each."""
    path = f"{scratch_dir(spark, label)}/pages"
    raw = order_feed(spark, sf_dir).select(*FIELDS, "page")
    sources.write_pages(raw, path)
    return path


def src_page_files(spark, sf_dir):
    path = _write_page_files(spark, sf_dir, "page-files")
    rows = sources.read_pages(spark, path, multi_line=False)
    landing = plans.load_landing(rows, Layout(scratch_dir(spark, "page-files")), "r1")
    rows = sources.read_layer(spark, landing.path, rows.schema)
    pages = rows.select("page", "page_failed").unionByName(sources.list_pages(spark, path))
    boundary = sources.page_boundary(pages)
    return sources.keep_page_prefix(rows, boundary).select("page", *FIELDS)


def src_json_map(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "props")
    return sources.map_json(events, "props", {"$['k']": "k", "$['absent']": "absent"}).drop("props")


def src_json_rows(spark, sf_dir):
    """Customers with their orders and lines as nested JSON, opened again into lines. Customers
    without orders and orders without lines give a row each."""
    read = lambda name, *columns: spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    lines = read("lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").filter("l_linenumber > 1")
    per_order = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("no"), F.col("l_quantity").alias("qty"), F.col("l_returnflag").alias("flag"))).alias("lines"))
    orders = read("orders", "o_orderkey", "o_custkey", "o_orderstatus").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    order = F.struct(F.col("o_orderkey").alias("key"), F.struct(F.col("o_orderstatus").alias("code")).alias("status"), F.coalesce("lines", F.array()).alias("lines"))
    per_customer = orders.groupBy("o_custkey").agg(F.collect_list(order).alias("orders"))
    customers = read("customer", "c_custkey", "c_mktsegment").join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    pages = customers.select(F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), "orders")).alias("page"))
    mapping = {
        "$['id']": "id",
        "$['orders'][*]['key']": "order_key",
        "$['orders'][*]['status']['code']": "status",
        "$['orders'][*]['lines'][*]['no']": "line",
        "$['orders'][*]['lines'][*]['qty']": "qty",
    }
    rows = sources.map_json_rows(pages, "page", mapping, rest="rest").drop("page")
    return rows.select("id", "order_key", "status", "line", F.col("qty").cast("double").alias("qty"), F.to_json("rest").alias("rest"))


def src_typed_schema(spark, sf_dir):
    typed = schemas.struct_of(
        f"seq {schemas.ENTITY_FIELDS}", {f.name: f.dataType for f in schemas.ENTITY} | {"seq": LongType()}
    )
    return op.project(order_feed(spark, sf_dir), typed)


def src_layer_scan(spark, sf_dir):
    path = scratch_dir(spark, "scan")
    sinks.write_layer(op.project(bronze(spark, sf_dir), schemas.ENTITY), path, by=["state"])
    return sources.read_layer(spark, path, schemas.ENTITY)


def stream_landing(spark, sf_dir):
    pages = _write_page_files(spark, sf_dir, "stream")
    work = scratch_dir(spark, "stream")
    landing, mark = f"{work}/landing", f"{work}/checkpoint"
    # The second run finds no new file and must add nothing.
    for _ in range(2):
        land_new_pages(spark, pages, landing, mark, multi_line=False)
    return sources.read_layer(spark, landing, schemas.RAW)


def stream_upsert(spark, sf_dir):
    """The newest record of each id from a stream of page files: micro-batches out of order, pages
    that are delivered twice, and a restart halfway."""
    work = scratch_dir(spark, "stream-upsert")
    typed = schemas.StructType([*schemas.RAW.fields, *schemas.struct_of("seen_at seq", SEEN_ENTITY.recency).fields])
    layer = sinks.BucketLayer(f"{work}/layer", typed, ("id",), ("seen_at", "seq"))
    last = _last_page(spark, sf_dir)
    for late, part in enumerate((F.col("page") > last // 2, F.col("page") <= last * 2 // 3)):
        _put_pages(spark, sf_dir, f"{work}/pages/delivery={late}", part)
        rows = stream_pages(spark, f"{work}/pages", SEEN_ENTITY.read_fields, False, f"{work}/checkpoint", maxFilesPerTrigger=max(1, last // 3))
        rows = rows.withColumns(recency_columns(layer)).select(*typed.names)
        stream_upserts(spark, rows, layer, f"{work}/checkpoint", "feed")
    return layer.read(spark).select("seq", *FIELDS)


# --- sinks ----------------------------------------------------------------------------


def snk_partitioned_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    sinks.write_layer(silver(spark, sf_dir), path, by=["state"])
    return sources.read_layer(spark, path, schemas.ENTITY)


def snk_gold_roundtrip(spark, sf_dir):
    layout = Layout(scratch_dir(spark, "gold"))
    load = plans.load_gold(silver(spark, sf_dir), layout, "r1")
    return sources.read_layer(spark, load.path, schemas.GOLD).drop(schemas.GOLD_TS)


def snk_landing_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "landing")
    raw = order_feed(spark, sf_dir).withColumns(
        {"address_1": F.col("street"), "state_province": F.col("state")}
    )
    sinks.write_layer(op.project(raw, schemas.LANDING), path)
    return sources.read_layer(spark, path, schemas.LANDING)


def snk_namespaces(spark, sf_dir):
    root = scratch_dir(spark, "tables")
    sinks.create_namespaces(spark)
    silver_path = f"{root}/silver"
    sinks.write_layer(silver(spark, sf_dir), silver_path, by=["state"])
    sinks.publish_table(spark, "silver.entities", "r1", silver_path, schemas.ENTITY, by=["state"])
    load = plans.load_gold(spark.table("silver.entities"), Layout(root), "r1")
    sinks.publish_table(spark, "gold.entities_by_place", "r1", load.path, schemas.GOLD)
    return spark.sql(
        """SELECT 'silver' AS namespace, count(*) AS entities FROM silver.entities
        UNION ALL
        SELECT 'gold', sum(entity_count) FROM spark_catalog.gold.entities_by_place"""
    )


def snk_compact(spark, sf_dir):
    root = scratch_dir(spark, "compact")
    sinks.write_layer(silver(spark, sf_dir), f"{root}/v1", by=["state"])
    sinks.compact(spark, f"{root}/v1", f"{root}/v2", schemas.ENTITY, ["state"], ["category", "id"])
    return sources.read_layer(spark, f"{root}/v2", schemas.ENTITY)


def snk_compact_hot(spark, sf_dir):
    """Without clustering columns: a hash of the rows splits a hot folder."""
    root = scratch_dir(spark, "compact")
    sinks.write_layer(silver(spark, sf_dir), f"{root}/v1", by=["state"])
    sinks.compact(spark, f"{root}/v1", f"{root}/v2", schemas.ENTITY, ["state"], file_bytes=16 * 1024)
    return sources.read_layer(spark, f"{root}/v2", schemas.ENTITY)


def snk_zorder(spark, sf_dir):
    """Clustered by three columns alike, in many small files."""
    root = scratch_dir(spark, "zorder")
    sinks.write_layer(silver(spark, sf_dir), f"{root}/v1", by=["state"])
    sinks.zorder(spark, f"{root}/v1", f"{root}/v2", schemas.ENTITY, ["category", "city", "id"], ["state"], file_bytes=64 * 1024)
    return sources.read_layer(spark, f"{root}/v2", schemas.ENTITY)


# --- projections and filters ----------------------------------------------------------


def prj_fixed_fields(spark, sf_dir):
    return op.project(order_feed(spark, sf_dir), schemas.struct_of(f"{schemas.ENTITY_FIELDS} updated_at"))


def prj_parse_coords(spark, sf_dir):
    raw = order_feed(spark, sf_dir).withColumn("longitude_malformed", coordinate_malformed("longitude"))
    return op.parse_coords(raw).select("seq", "longitude", "latitude", "longitude_malformed")


def prj_cast_double(spark, sf_dir):
    raw = order_feed(spark, sf_dir).select("seq", "longitude", "latitude")
    return op.cast_cols(raw, {"longitude": "double", "latitude": "double"})


def prj_lower(spark, sf_dir):
    return op.lower_cols(
        order_feed(spark, sf_dir).select("seq", *schemas.TEXT_FIELDS), schemas.TEXT_FIELDS
    )


def prj_sha256_mask(spark, sf_dir):
    raw = order_feed(spark, sf_dir).select("seq", "phone", masked("phone", "pepper").alias("salted"))
    return op.hash_col(raw, "phone")


def prj_load_stamp(spark, sf_dir):
    stamped = op.stamp(order_feed(spark, sf_dir), "ts")
    per_stamp = stamped.groupBy("ts").agg(F.count("*").alias("n"))
    return per_stamp.agg(F.sum("n").alias("stamped"), F.count("*").alias("stamps"))


def flt_drop_null_key(spark, sf_dir):
    return op.drop_null_key(order_feed(spark, sf_dir)).select("seq", *FIELDS)


def flt_equality(spark, sf_dir):
    raw = order_feed(spark, sf_dir).filter(F.col("country") == "United States")
    return raw.select("seq", "id", "state", "country")


def flt_invalid_postal(spark, sf_dir):
    return op.invalid_postal(clean(spark, sf_dir)).select("id", "postal_code", "country")


def flt_missing_all(spark, sf_dir):
    return plans.mask(op.missing_all(clean(spark, sf_dir), schemas.CONTACT_FIELDS)).select(*FIELDS)


# --- aggregates, quality and windows --------------------------------------------------


def agg_duplicate_keys(spark, sf_dir):
    return op.duplicate_keys(order_feed(spark, sf_dir), ["id"])


def agg_dedupe_latest(spark, sf_dir):
    return bronze(spark, sf_dir).select("seq", *FIELDS)


def agg_reconcile(spark, sf_dir):
    return op.reconcile_keys(order_feed(spark, sf_dir), ["id"])


def agg_reconcile_frames(spark, sf_dir):
    path = scratch_dir(spark, "clean")
    sinks.write_layer(clean(spark, sf_dir), path)
    rows = spark.read.parquet(path)
    return op.reconcile(rows, op.require_any(rows, schemas.CONTACT_FIELDS))


def agg_reconcile_rule(spark, sf_dir):
    return op.reconcile_rule(clean(spark, sf_dir), any_present(schemas.CONTACT_FIELDS))


def dq_metrics(spark, sf_dir):
    raw = op.lower_cols(order_feed(spark, sf_dir), ["country"])
    return op.quality_metrics(raw, ["id"], op.entity_rules(), RECENCY)


def dq_gate(spark, sf_dir):
    return op.gate(dq_metrics(spark, sf_dir))


def dq_gate_strict(spark, sf_dir):
    limits = {"duplicate_keys": 0, "bad_postal": 100, "no_contact": 10_000_000}
    return op.gate(dq_metrics(spark, sf_dir), limits)


def dq_gate_history(spark, sf_dir):
    """Monthly totals of the feed, each against the twelve months before it."""
    raw = op.lower_cols(order_feed(spark, sf_dir), ["country"])
    flags = {n: F.count_if(c) for n, c in op.entity_rules().items()} | {"total": F.count("*")}
    months = raw.groupBy(F.date_format("seen_at", "yyyy-MM").alias("run")).agg(*[c.alias(n) for n, c in flags.items()])
    totals = months.unpivot(["run"], list(flags), "metric", "value")
    bounded = op.with_bounds(totals, op.DriftRule(runs=12, factor=3.0, share=0.05, least=5.0, falls=True))
    return bounded.select("run", "metric", "value", "earlier", "median", "drifted")


def dq_profile(spark, sf_dir):
    """Column profiles of three runs by state, stored as sketches and merged without the rows;
    `close` says whether the estimate of distinct values is within five percent."""
    layout = Layout(scratch_dir(spark, "profiles"))
    rows = op.parse_coords(order_feed(spark, sf_dir))
    columns = ["seq", "id", "postal_code", "longitude"]
    for part in range(3):
        plans.store_profile(rows.filter(F.col("seq") % 3 == part), layout, f"r{part}", columns, ["state"])
    merged = plans.profile_over_runs(spark, layout, ["r0", "r1", "r2"])
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot([], columns, "column", "exact")
    close = F.abs(F.col("distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return merged.join(exact, "column").select("column", "rows", "nulls", "least", "greatest", close.alias("close"))


def win_percent_of_partition(spark, sf_dir):
    return op.percent_of_group(gold(spark, sf_dir), ["state"], "entity_count")


def win_row_number(spark, sf_dir):
    rows = gold(spark, sf_dir)
    return op.number_rows(rows, ["state"], plans.largest_first(rows, "entity_count"))


def win_top1(spark, sf_dir):
    rows = gold(spark, sf_dir)
    return op.top_n(rows, ["state"], plans.largest_first(rows, "entity_count"))


# --- loads ----------------------------------------------------------------------------


def _loads(spark, sf_dir) -> dict[str, plans.Load]:
    return plans.run_loads(
        spark,
        order_feed(spark, sf_dir),
        Layout(scratch_dir(spark, "lake")),
        "r1",
        recency=RECENCY,
        tie_break=(),
        on_fail="quarantine",
    )


def flow_bronze(spark, sf_dir):
    layout = Layout(scratch_dir(spark, "lake"))
    raw = order_feed(spark, sf_dir)
    landing = plans.load_landing(raw, layout, "r1")
    landed = sources.read_layer(spark, landing.path, raw.schema)
    load = plans.load_bronze(landed, layout, "r1", recency=RECENCY, tie_break=())
    return sources.read_layer(spark, load.path, schemas.ENTITY)


def _silver_load(spark, sf_dir) -> plans.Load:
    rows = op.stamp(bronze(spark, sf_dir), schemas.BRONZE_TS)
    root = scratch_dir(spark, "lake")
    path = f"{root}/bronze"
    sinks.write_layer(op.project(rows, schemas.BRONZE), path, by=["state"])
    stored = sources.read_layer(spark, path, schemas.BRONZE)
    return plans.load_silver(stored, Layout(root), "r1", on_fail="quarantine")


def flow_silver(spark, sf_dir):
    return sources.read_layer(spark, _silver_load(spark, sf_dir).path, schemas.ENTITY)


def dq_quarantine(spark, sf_dir):
    rejected = schemas.struct_of(
        f"verdict {schemas.ENTITY_FIELDS}", {f.name: f.dataType for f in schemas.ENTITY}
    )
    return sources.read_layer(spark, _silver_load(spark, sf_dir).quarantine, rejected)


def flow_gold(spark, sf_dir):
    stored = sources.read_layer(spark, _silver_load(spark, sf_dir).path, schemas.SILVER)
    load = plans.load_gold(stored, Layout(scratch_dir(spark, "lake")), "r1")
    return sources.read_layer(spark, load.path, schemas.GOLD).drop(schemas.GOLD_TS)


def flow_all(spark, sf_dir):
    path = _loads(spark, sf_dir)["gold"].path
    return plans.total_by(sources.read_layer(spark, path, schemas.GOLD), "state")


def _land_and_load(spark, sf_dir, layout, run_id, pages, half, **options):
    """Writes the page files of one half of the feed, lands what is new and loads it."""
    _put_pages(spark, sf_dir, pages, half)
    landed = land_new_pages(
        spark, pages, layout.layer("incoming"), f"{layout.root}/mark", SEEN_ENTITY.read_fields, False, run_id=run_id
    )
    rows = spark.read.parquet(landed).drop("batch")
    return plans.run_loads(
        spark, rows, layout, run_id, tie_break=(), on_fail="quarantine", incremental=True, entity=SEEN_ENTITY, **options
    )


def flow_incremental(spark, sf_dir):
    """Two batches of page files, landed by a stream and merged into a bucketed silver."""
    layout = Layout(scratch_dir(spark, "incremental"))
    pages = f"{layout.root}/pages"
    half = order_feed(spark, sf_dir).agg(F.floor(F.max("page") / 2).cast("long")).first()[0]
    _land_and_load(spark, sf_dir, layout, "r1", pages, F.col("page") <= half)
    done = _land_and_load(
        spark, sf_dir, layout, "r2", pages, F.col("page") > half, first_page=half + 1, previous_run="r1"
    )
    return plans.read_silver(spark, done["silver"], entity=SEEN_ENTITY).select(*FIELDS)


# The feed's records with the columns that say which one is newer.
SEEN_ENTITY = replace(schemas.Entity(), recency={"seen_at": TimestampNTZType(), "seq": LongType()})


def _put_pages(spark, sf_dir, pages, chosen, mode="append"):
    """The chosen pages of the feed as JSON page files, one folder a page."""
    raw = order_feed(spark, sf_dir).filter(chosen).select(*SEEN_ENTITY.fields, "seen_at", "seq", "page")
    sources.write_pages(raw, pages, mode)


def _load_new(spark, layout, run_id, **options):
    return plans.load_new_pages(
        spark, f"{layout.root}/pages", layout, run_id, False, entity=SEEN_ENTITY, tie_break=(), on_fail="quarantine", **options
    )


def _last_page(spark, sf_dir) -> int:
    return order_feed(spark, sf_dir).agg(F.max("page")).first()[0]


def flow_gold_delta(spark, sf_dir):
    """Gold kept up to date by signed changes over three batches. Records come out of order, and
    keys leave silver when their newest record is rejected."""
    layout = Layout(scratch_dir(spark, "gold-delta"))
    last = _last_page(spark, sf_dir)
    for number in range(3):
        part = F.col("page").between(last * number // 3 + 1, last * (number + 1) // 3)
        _put_pages(spark, sf_dir, f"{layout.root}/pages", part)
        done = _load_new(spark, layout, f"r{number}")
    return plans.read_gold(spark, done["gold"], SEEN_ENTITY).drop(schemas.GOLD_TS)


def flow_rerun(spark, sf_dir):
    """Half the pages, then the rest with one page broken: the gate stops that run, it is repeated
    under its id, and the page that is repaired later is loaded alone."""
    layout = Layout(scratch_dir(spark, "rerun"))
    pages, last = f"{layout.root}/pages", _last_page(spark, sf_dir)
    half, broken = last // 2, last * 3 // 4
    _put_pages(spark, sf_dir, pages, F.col("page") <= half)
    _load_new(spark, layout, "r1")
    _put_pages(spark, sf_dir, pages, (F.col("page") > half) & (F.col("page") != broken))
    spark.createDataFrame([('{"id": "1", ',)], "value string").write.text(f"{pages}/page={broken}")
    try:
        _load_new(spark, layout, "r2", limits={"no_contact": 0}, skip_failed=True)
    except op.QualityGateError:
        _load_new(spark, layout, "r2", skip_failed=True)
    repaired = order_feed(spark, sf_dir).filter(F.col("page") == broken)
    repaired.select(*SEEN_ENTITY.fields, "seen_at", "seq").write.mode("overwrite").json(f"{pages}/page={broken}")
    done = _load_new(spark, layout, "r3")
    return plans.read_silver(spark, done["silver"], entity=SEEN_ENTITY).select(*FIELDS)


def _three_runs(spark, sf_dir, label) -> sinks.BucketLayer:
    """A silver layer of three daily runs."""
    layout = Layout(scratch_dir(spark, label))
    last = _last_page(spark, sf_dir)
    for number in range(3):
        _put_pages(spark, sf_dir, f"{layout.root}/pages", F.col("page").between(last * number // 3 + 1, last * (number + 1) // 3))
        _load_new(spark, layout, f"r{number + 1}")
    return plans.silver_layer(layout, SEEN_ENTITY)


def flow_replay(spark, sf_dir):
    """Two runs under patterns that few codes fulfil, and the quarantine replayed under the real
    ones: as if these had held from the start."""
    layout = Layout(scratch_dir(spark, "replay"))
    half = _last_page(spark, sf_dir) // 2
    strict = {country: "^[0-9]{5}$" for country in ("united states", "europe", "asia")}
    for number, part in enumerate((F.col("page") <= half, F.col("page") > half), 1):
        _put_pages(spark, sf_dir, f"{layout.root}/pages", part)
        _load_new(spark, layout, f"r{number}", patterns=strict)
    done = plans.replay_quarantine(spark, layout, "replay", POSTAL_US, entity=SEEN_ENTITY)
    return plans.read_silver(spark, done["silver"], entity=SEEN_ENTITY).select(*FIELDS)


def _typed_runs(spark, sf_dir) -> Layout:
    """The feed in three runs whose columns differ: numbers become wider, one turns to text, one
    comes and one goes."""
    layout = Layout(scratch_dir(spark, "widened"))
    raw, part = order_feed(spark, sf_dir), F.col("seq") % 3
    seq, lat = F.col("seq"), F.col("latitude").try_cast("double")
    runs = {
        "r1": raw.filter(part == 0).select(seq.cast("int").alias("seq"), "state", lat.cast("int").alias("latitude"), "page"),
        "r2": raw.filter(part == 1).select(seq.cast("long").alias("seq"), "state", lat.alias("latitude"), F.col("page").cast("string").alias("page")),
        "r3": raw.filter(part == 2).select(seq.cast("int").alias("seq"), "state", "city", lat.cast("int").alias("latitude")),
    }
    for run_id, rows in runs.items():
        sinks.write_layer(rows, layout.run("typed", run_id), by=["state"])
    return layout


def doc_schema_widened(spark, sf_dir):
    """All runs under the schema that holds the values of each."""
    return sources.read_runs(spark, _typed_runs(spark, sf_dir).layer("typed"), ["r1", "r2", "r3"])


def doc_schema_drift(spark, sf_dir):
    schemas_of = sources.run_schemas(spark, _typed_runs(spark, sf_dir).layer("typed"), ["r1", "r2", "r3"])
    return sources.schema_drift(spark, schemas_of)


def doc_postal_table(spark, sf_dir):
    """Bad codes by a table of patterns that is derived from the regions."""
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    country = F.when(F.col("r_name") == "AMERICA", "united states").otherwise(F.lower("r_name"))
    five = region.select(country.alias("country"), F.lit("^[0-9]{5}$").alias("pattern"), "r_regionkey")
    nine = five.filter("r_regionkey % 2 = 1").withColumn("pattern", F.lit("^[0-9]{5}-[0-9]{4}$"))
    table = five.unionByName(nine).filter("r_regionkey < 4").select("country", "pattern")
    return op.invalid_postal_by_table(clean(spark, sf_dir), table).select("id", "country", "postal_code")


def doc_changes(spark, sf_dir):
    """What the last of three runs inserted, updated and deleted in silver."""
    changes = _three_runs(spark, sf_dir, "changes").changes(spark, "r2", "r3", [c for c in FIELDS if c != "id"])
    pair = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in ("postal_code", "longitude") for side in ("before", "after")]
    return changes.select("id", "change", F.array_join("changed", ",").alias("changed"), *pair)


def doc_history(spark, sf_dir):
    """Every state of every entity over three runs."""
    return _three_runs(spark, sf_dir, "history").history(spark, columns=["id", "postal_code", "longitude", "phone"])


# A second entity table under names of its own.
PARTS = schemas.Entity(
    fields=("part_no", "name", "type", "size", "price", "brand"),
    key=("part_no",),
    text=("name", "type"),
    contact=("brand",),
    coordinates=("price",),
    masked=("brand",),
    dims=("type", "name"),
    partition="type",
    country="type",
    postal="size",
    source={"part_no": "p_partkey", "name": "p_name", "type": "p_type", "size": "p_size", "price": "p_retailprice", "brand": "p_brand"},
)
PART_SIZES = {"economy": "^[1-3]?[0-9]$"}


def flow_second_entity(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    rows = parts.select(
        *[F.col(c).cast("string").alias(c) for c in PARTS.source.values()],
        F.expr("p_partkey DIV 100 + 1").alias("page"),
        F.lit(False).alias("page_failed"),
    )
    layout = Layout(scratch_dir(spark, "parts"))
    done = plans.run_loads(spark, rows, layout, "r1", patterns=PART_SIZES, on_fail="quarantine", entity=PARTS)
    return sources.read_layer(spark, done["gold"].path, PARTS.gold).drop(schemas.GOLD_TS)


# --- KPI queries as SQL over the published gold table ---------------------------------

PUBLISHED = "gold.entities_of_run"
KPI_SQL = {
    "sql_kpi_1": """SELECT state, sum(entity_count) AS total_entities FROM {t}
        GROUP BY state ORDER BY total_entities DESC, state""",
    "sql_kpi_2": """SELECT category, sum(entity_count) AS total_entities FROM {t}
        GROUP BY category ORDER BY total_entities DESC, category""",
    "sql_kpi_3": """SELECT state, sum(entity_count) AS total_entities FROM {t} WHERE category = 'building'
        GROUP BY state ORDER BY total_entities DESC, state""",
    "sql_kpi_4": """WITH totals AS (SELECT state, sum(entity_count) AS total FROM {t} GROUP BY state)
        SELECT g.state, category, name, country, city, entity_count,
            CAST(round(entity_count * 100.0 / total, 2) AS DOUBLE) AS percentage
        FROM {t} AS g JOIN totals ON g.state <=> totals.state ORDER BY g.state, percentage DESC""",
    "sql_kpi_5": """WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY state
            ORDER BY entity_count DESC, category, name, country, city) AS place FROM {t})
        SELECT category AS most_popular_category, sum(entity_count) AS total FROM ranked
        WHERE place = 1 GROUP BY category ORDER BY total DESC""",
}


def _sql_kpi(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout = Layout(scratch_dir(spark, "published"))
        plans.run_loads(
            spark,
            order_feed(spark, sf_dir),
            layout,
            # A run id with dashes, and one that no earlier call has published.
            f"run-{uuid.uuid4().hex[:12]}",
            recency=RECENCY,
            tie_break=(),
            on_fail="quarantine",
            publish={"gold": PUBLISHED},
        )
        return spark.sql(KPI_SQL[name].format(t=PUBLISHED))

    return query


# --- described but not coded by the reference ------------------------------------------


def doc_upsert(spark, sf_dir):
    """The second half of the pages, then the first half delivered late: the newest record
    of an id survives, whichever came last."""
    raw = op.drop_null_key(order_feed(spark, sf_dir))
    half = raw.agg(F.max("page") / 2).scalar()
    old = op.latest_per_key(raw.filter(F.col("page") > half), ["id"], RECENCY, ())
    merged = op.upsert(old, raw.filter(F.col("page") <= half), ["id"], RECENCY, ())
    return plans.mask(plans.refine(merged)).select("seq", *FIELDS)


def doc_enforce_schema(spark, sf_dir):
    return op.enforce_schema(order_feed(spark, sf_dir), schemas.SILVER_EXPECTED)[0]


def doc_incremental(spark, sf_dir):
    """Every second row at the last loaded stamp comes late."""
    raw = order_feed(spark, sf_dir)
    before = raw.filter(F.col("seen_at") < F.lit("1997-01-01").cast("timestamp_ntz"))
    mark = before.agg(F.max("seen_at")).scalar()
    loaded = before.filter((F.col("seen_at") < mark) | (F.col("seq") % 2 == 0))
    return sources.newer_than(raw, loaded, "seen_at", ["seq"]).select("seq", "id", "state")


def doc_postal_by_country(spark, sf_dir):
    rows = op.invalid_postal(clean(spark, sf_dir), POSTAL_PATTERNS)
    return rows.select("id", "country", "postal_code")


def entry(spark: SparkSession) -> DataFrame:
    """All loads on the smallest tables, then the totals per state from the stored gold."""
    return flow_all(spark, SF_DIR)


def queries() -> dict[str, Query]:
    return {
        "src_page_prefix": src_page_prefix,
        "src_page_report": src_page_report,
        "src_page_files": src_page_files,
        "src_json_map": src_json_map,
        "src_json_rows": src_json_rows,
        "src_typed_schema": src_typed_schema,
        "src_layer_scan": src_layer_scan,
        "stream_landing": stream_landing,
        "stream_upsert": stream_upsert,
        "snk_partitioned_roundtrip": snk_partitioned_roundtrip,
        "snk_gold_roundtrip": snk_gold_roundtrip,
        "snk_landing_roundtrip": snk_landing_roundtrip,
        "snk_namespaces": snk_namespaces,
        "snk_compact": snk_compact,
        "snk_compact_hot": snk_compact_hot,
        "snk_zorder": snk_zorder,
        "prj_fixed_fields": prj_fixed_fields,
        "prj_parse_coords": prj_parse_coords,
        "prj_cast_double": prj_cast_double,
        "prj_lower": prj_lower,
        "prj_sha256_mask": prj_sha256_mask,
        "prj_load_stamp": prj_load_stamp,
        "flt_drop_null_key": flt_drop_null_key,
        "flt_equality": flt_equality,
        "flt_invalid_postal": flt_invalid_postal,
        "flt_require_any": silver,
        "flt_missing_all": flt_missing_all,
        "agg_duplicate_keys": agg_duplicate_keys,
        "agg_dedupe_latest": agg_dedupe_latest,
        "agg_gold_rollup": gold,
        "agg_reconcile": agg_reconcile,
        "agg_reconcile_frames": agg_reconcile_frames,
        "agg_reconcile_rule": agg_reconcile_rule,
        "dq_metrics": dq_metrics,
        "dq_gate": dq_gate,
        "dq_gate_strict": dq_gate_strict,
        "dq_quarantine": dq_quarantine,
        "dq_gate_history": dq_gate_history,
        "dq_profile": dq_profile,
        "win_percent_of_partition": win_percent_of_partition,
        "win_row_number": win_row_number,
        "win_top1": win_top1,
        "kpi_1_total_by_state": lambda s, d: plans.total_by(gold(s, d), "state"),
        "kpi_2_total_by_category": lambda s, d: plans.total_by(gold(s, d), "category"),
        "kpi_3_states_for_category": lambda s, d: plans.states_for_category(gold(s, d), "building"),
        "kpi_4_share": lambda s, d: plans.share_within_state(gold(s, d), extra=("name", "country", "city")),
        "kpi_4_share_by_category": lambda s, d: plans.share_within_state(
            plans.category_grain(gold(s, d))
        ),
        "kpi_5_popular": lambda s, d: plans.popular_categories(gold(s, d)).drop("states"),
        "kpi_5_popular_by_category": lambda s, d: plans.popular_categories(
            plans.category_grain(gold(s, d))
        ),
        "flow_bronze": flow_bronze,
        "flow_silver": flow_silver,
        "flow_gold": flow_gold,
        "flow_all": flow_all,
        "flow_incremental": flow_incremental,
        "flow_second_entity": flow_second_entity,
        "flow_gold_delta": flow_gold_delta,
        "flow_rerun": flow_rerun,
        "flow_replay": flow_replay,
        **{name: _sql_kpi(name) for name in KPI_SQL},
        "doc_upsert": doc_upsert,
        "doc_enforce_schema": doc_enforce_schema,
        "doc_incremental": doc_incremental,
        "doc_postal_by_country": doc_postal_by_country,
        "doc_postal_table": doc_postal_table,
        "doc_schema_widened": doc_schema_widened,
        "doc_schema_drift": doc_schema_drift,
        "doc_changes": doc_changes,
        "doc_history": doc_history,
    } | (llm_registry.QUERIES if llm_registry else {})


def oracle_sql() -> dict[str, str]:
    return dict(TEXTS) | (llm_registry.SQL if llm_registry else {})
