"""Quarantined rows judged once more, under other patterns."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import schemas
from terrace.operators import latest_per_key, stamp, with_postal_pattern
from terrace.plans.loads import ACCEPTED, ENTITY, Load, load_gold_changes, record_metrics, silver_layer, silver_rules
from terrace.plans.runs import base_run, finish_run, finished_runs, next_attempt
from terrace.schemas import Entity, Layout
from terrace.session import exists
from terrace.sinks import write_layer
from terrace.sources import read_layer


def quarantined(spark: SparkSession, layout: Layout, entity: Entity = ENTITY) -> DataFrame:
    """The rejected rows of all finished runs with their verdict: of each key the newest."""
    held = schemas.StructType([*entity.silver.fields, *schemas.struct_of("verdict").fields])
    folders = [layout.run("quarantine", r.label) for r in finished_runs(spark, layout)]
    folders = [f for f in folders if exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], held)
    rows = None
    for folder in folders:
        own = read_layer(spark, folder, held)
        rows = own if rows is None else rows.unionByName(own)
    return latest_per_key(rows, entity.key, [*(tuple(entity.recency) or (schemas.BRONZE_TS,)), schemas.SILVER_TS])


def replay_quarantine(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    patterns: Mapping[str, str] | DataFrame,
    ts: datetime | None = None,
    entity: Entity = ENTITY,
) -> dict[str, Load]:
    """Merge the quarantined rows that pass under `patterns` into the incremental layers, as a
    run of its own; the rest stays in quarantine.

    Rows are as the silver load stored them, refined and masked, and are not refined again (so
    the postal column must not be masked). They are merged by their own recency: a row whose key
    has had a newer record since then changes nothing, and replaying twice changes nothing. The
    removal that the rejected row left behind is lifted by the row itself.
    """
    label = next_attempt(spark, layout, run_id)
    base = base_run(spark, layout, None, False, False)
    rules = silver_rules(patterns, entity)
    rows = quarantined(spark, layout, entity).drop("verdict")
    if isinstance(patterns, DataFrame):
        rows = with_postal_pattern(rows, patterns, entity.country)
    verdict = F.when(rules["bad_postal"], "bad_postal").when(rules["no_contact"], "no_contact").otherwise(ACCEPTED)
    stage = layout.run("replayed", label)
    judged = stamp(rows.withColumn("verdict", verdict), schemas.SILVER_TS, ts)
    write_layer(judged.select(*entity.silver.names, "verdict"), stage, by=["verdict"])
    held = schemas.StructType([*entity.silver.fields, *schemas.struct_of("verdict").fields])
    stored = read_layer(spark, stage, held)
    accepted = stored.filter(F.col("verdict") == ACCEPTED).drop("verdict")
    totals = {r.verdict: r["count"] for r in stored.groupBy("verdict").count().collect()}
    done = {"replay": Load(stage, {f"replayed_{k}": n for k, n in totals.items()})}
    if totals.get(ACCEPTED):
        layer = silver_layer(layout, entity)
        merged = layer.merge(accepted, label, base, fresh=base is None, branch=True)
        done["silver"] = Load(layer.root, merge=merged)
        done["gold"] = load_gold_changes(spark, layout, label, base, ts, entity)
    record_metrics(spark, done, layout, label, ts=ts)
    finish_run(spark, layout, run_id, label, base, "gold" in done)
    return done
