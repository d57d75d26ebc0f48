"""The three loads and their chain. Each load reads one stored layer and writes the next."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace import schemas
from terrace.functions import POSTAL_US, coordinate_malformed
from terrace.operators import (
    QualityGateError,
    breaks_pattern,
    cast_cols,
    check_gate,
    drop_null_key,
    entity_rules,
    hash_col,
    latest_per_key,
    lower_cols,
    project,
    reconcile_keys,
    require_known,
    rollup_count,
    signed_changes,
    stamp,
    with_postal_pattern,
)
from terrace.operators.quality import DEFAULT_LIMITS
from terrace.schemas import Entity, Layout
from terrace.plans.history import HistoryGate, bounds_for_next, check_drift
from terrace.plans.runs import base_run, finish_run, next_attempt
from terrace.session import remove, small_files
from terrace.sinks import BucketLayer, Merge, compact, create_namespaces, publish_table, write_layer
from terrace.sinks.buckets import GONE, RUN
from terrace.sources import page_boundary, read_layer
from terrace.sources.pages import FAILED, PAGE

ENTITY = Entity()
# Totals that only the bronze load can measure, as later layers no longer show them.
BRONZE_TOTALS = ("duplicate_keys", "coord_malformed")
RULES = ("bad_postal", "no_contact", "postal_missing")
ACCEPTED = "accepted"


class TruncatedLoadError(RuntimeError):
    """A wanted page is missing or failed; nothing was replaced."""


class UnnumberedPageError(RuntimeError):
    """Page files without a page number were found; nothing was replaced."""


@dataclass(frozen=True)
class Load:
    """What a load did. `path` is None where there was nothing to write; `quarantine`
    holds the rejected rows of a silver load, if it kept any; `merge` is what an
    incremental load merged into the bucketed layer at `path`."""

    path: str | None
    metrics: Mapping[str, int] = field(default_factory=dict)
    quarantine: str | None = None
    merge: Merge | None = None


def _one_row(df: DataFrame) -> dict:
    return df.first().asDict()


def refine(df: DataFrame, entity: Entity = ENTITY) -> DataFrame:
    """Bronze rows as the silver checks want them: no missing key, doubles, lower case.

    The phone is not masked yet: the checks only ask whether it is there, and a filter
    above the mask would digest every number to find out.
    """
    typed = cast_cols(drop_null_key(df, entity.key), {c: "double" for c in entity.coordinates})
    return lower_cols(typed, entity.text)


def mask(df: DataFrame, salt: str = "", entity: Entity = ENTITY) -> DataFrame:
    for name in entity.masked:
        df = hash_col(df, name, salt)
    return df


def load_landing(rows: DataFrame, layout: Layout, run_id: str, entity: Entity = ENTITY) -> Load:
    """Store raw page records under the entity's column names, so that JSON is parsed once
    per run. Columns beside the entity's (page, page_failed, recency) are kept."""
    path = layout.run("landing", run_id)
    with small_files(rows.sparkSession):
        write_layer(entity.renamed(rows), path)
    return Load(path)


def load_bronze(
    landed: DataFrame,
    layout: Layout,
    run_id: str,
    listed_pages: DataFrame | None = None,
    total_pages: int | None = None,
    recency: Sequence[str] | None = None,
    tie_break: Sequence[str] | None = None,
    allow_truncated: bool = False,
    allow_unnumbered: bool = False,
    first_page: int = 1,
    skip_failed: bool = False,
    ts: datetime | None = None,
    entity: Entity = ENTITY,
) -> Load:
    """The newest record of each key from the unbroken prefix of landed pages.

    `landed` holds text records with `page` and `page_failed`; `listed_pages` adds
    the pages without records. Narrow passes over the stored columns come first: the page
    boundary, what lies beyond it, and the counts per key. Rows without a page number stop
    the load unless `allow_unnumbered` loads them too. `recency` is the entity's own, or
    the page. An incremental run starts at its `first_page`. With `skip_failed` the good pages
    behind a missing or failed one are loaded as well and only failed pages are left out; that
    needs a ledger of what is still to come (`load_new_pages`).
    """
    recency = recency or tuple(entity.recency) or (PAGE,)
    pages = landed.select(PAGE, FAILED)
    if listed_pages is not None:
        pages = pages.unionByName(listed_pages)
    metrics = _one_row(page_boundary(pages, total_pages, first_page))
    if metrics["unnumbered"] and not allow_unnumbered:
        raise UnnumberedPageError(f"{metrics['unnumbered']} records or files without a page number")
    if metrics["broken"] and not (allow_truncated or skip_failed):
        raise TruncatedLoadError(f"page {metrics['boundary']} is missing or failed")

    if metrics["skipped"] and not allow_truncated:
        raise TruncatedLoadError(f"{metrics['skipped']} records or files on pages before page {first_page}")

    metrics |= {"pages_left_out": 0, "rows_left_out": 0}
    failed = landed.groupBy(PAGE).agg(F.max(FAILED).alias("failed"), F.count("*").alias("n"))
    if metrics["truncated"]:
        left = failed.filter("failed") if skip_failed else failed.filter(F.col(PAGE) >= metrics["boundary"])
        metrics |= _one_row(left.agg(F.count("*").alias("pages_left_out"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_left_out")))
    wanted = F.col(PAGE).between(first_page, metrics["boundary"] - 1)
    if skip_failed:
        wanted = F.col(PAGE) >= first_page
        if total_pages:
            wanted = F.col(PAGE).between(first_page, total_pages)
        landed = landed.join(failed.filter("failed").select(PAGE), [PAGE], "left_anti") if metrics["truncated"] else landed
    kept = landed.filter(wanted | F.col(PAGE).isNull())
    kept = kept.withColumns({c: F.col(c).try_cast(t) for c, t in entity.recency.items()})
    malformed = F.lit(False)
    for name in entity.coordinates:
        malformed = malformed | coordinate_malformed(name)
    metrics |= _one_row(reconcile_keys(kept, entity.key, {"coord_malformed": malformed}))
    if metrics["total"] == 0:
        return Load(None, metrics)

    # Survivors are picked on the stored text; only they are parsed. Files store a blank
    # partition value like a missing one, and a field that the source spells otherwise is
    # empty in every row, so both are counted as the rows are written.
    rows = latest_per_key(kept, entity.key, recency, tie_break)
    seen = Observation(f"bronze-{run_id}")
    blank = F.count_if(F.col(entity.partition) == "").alias("blank_partition")
    rows = rows.observe(seen, blank, *[F.count(c).alias(f"_{c}") for c in entity.fields])
    path = layout.run("bronze", run_id)
    write_layer(stamp(project(rows, entity.plain), schemas.BRONZE_TS, ts), path, by=[entity.partition])
    metrics["blank_partition"] = seen.get["blank_partition"]
    metrics["empty_fields"] = sum(seen.get[f"_{c}"] == 0 for c in entity.fields)
    return Load(path, metrics)


def _limits(limits: Mapping[str, int] | None, on_fail: str, known: Sequence[str]) -> Mapping[str, int]:
    """Limits that the caller sets always hold. The default one is for `raise` only:
    quarantine takes bad postal codes out instead."""
    if on_fail not in ("raise", "quarantine"):
        raise ValueError(f"on_fail must be raise or quarantine, not {on_fail}")
    if limits is None:
        return DEFAULT_LIMITS if on_fail == "raise" else {}
    require_known(limits, known)
    return limits


def silver_rules(patterns: Mapping[str, str] | DataFrame, entity: Entity = ENTITY) -> dict[str, Column]:
    """The row predicates of the silver checks. For a table of patterns (country, pattern) the
    rows must have been given theirs by `with_postal_pattern`."""
    if isinstance(patterns, DataFrame):
        return entity_rules({}, entity.contact, entity.country, entity.postal) | {"bad_postal": breaks_pattern(entity.postal)}
    return entity_rules(patterns, entity.contact, entity.country, entity.postal)


def load_silver(
    bronze: DataFrame,
    layout: Layout,
    run_id: str,
    patterns: Mapping[str, str] | DataFrame = POSTAL_US,
    limits: Mapping[str, int] | None = None,
    on_fail: str = "raise",
    salt: str = "",
    earlier: Mapping[str, int] | None = None,
    bounds: Mapping[str, tuple[float, float]] | None = None,
    incremental: bool = False,
    previous_run: str | None = None,
    rejected_updates: str = "remove",
    buckets: int | None = None,
    file_bytes: int = 512 * 1024 * 1024,
    ts: datetime | None = None,
    entity: Entity = ENTITY,
) -> Load:
    """Refined, checked and unique rows with a contact.

    One wide dedupe writes the rows with their verdict and the flag of every rule to a staging
    folder, and the totals are counted from what is stored there, so that a task that ran twice
    counts once. Then the gate looks at them: the totals of the rules, the repeated keys of this
    input, and the totals of `earlier`, the metrics of the bronze load. A broken limit
    raises and nothing is written. With `on_fail="quarantine"` rows with a bad postal code
    stay out of silver, and they and the rows without contact are stored by their verdict
    next to it; limits that are set still raise, and so does a total outside its `bounds`, which
    the earlier runs set (`bounds_for_next`).

    `patterns` are those of some countries, or a table (country, pattern) of any size, which is
    joined. Silver is the staged rows compacted into one sorted layer by the partition column. With
    `incremental` it is a bucketed layer instead, to which the rows are added as a delta
    (the entity's recency, else the bronze stamp, says which row of a key is newer) on top of
    `previous_run`, or as the first run of a new layer. A key whose newest record is rejected
    is removed, or keeps its earlier row with `rejected_updates="keep"`.
    """
    known = [*RULES, "duplicate_keys", *(earlier or {}).keys() & set(BRONZE_TOTALS)]
    limits = _limits(limits, on_fail, known)
    if rejected_updates not in ("remove", "keep"):
        raise ValueError(f"rejected_updates must be remove or keep, not {rejected_updates}")
    spark = bronze.sparkSession
    clean = refine(bronze, entity)
    rules = silver_rules(patterns, entity)
    verdict = F.when(rules["no_contact"], "no_contact").otherwise(ACCEPTED)
    if on_fail == "quarantine":
        verdict = F.when(rules["bad_postal"], "bad_postal").otherwise(verdict)
    recency = tuple(entity.recency) or (schemas.BRONZE_TS,)

    copies = clean.groupBy(*entity.key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    metrics = _one_row(copies)
    # Gates the totals that are known before the wide step.
    for name in BRONZE_TOTALS:
        if earlier and name in earlier:
            metrics[name] = metrics.get(name, 0) + earlier[name]
    check_gate(metrics, {k: v for k, v in limits.items() if k in metrics})

    flags = {n: f"rule_{n}" for n in rules}
    newest = latest_per_key(clean, entity.key, recency)
    if isinstance(patterns, DataFrame):
        newest = with_postal_pattern(newest, patterns, entity.country)
    newest = newest.withColumns({"verdict": verdict} | {flags[n]: c for n, c in rules.items()})
    stage = layout.run("staging", run_id)
    staged = stamp(mask(newest, salt, entity), schemas.SILVER_TS, ts)
    write_layer(staged.select(*entity.silver.names, *flags.values(), "verdict"), stage, by=["verdict"])
    try:
        metrics |= _staged_totals(spark, stage, flags)
        check_gate(metrics, limits)
        check_drift(metrics, bounds or {})
        return _store_silver(spark, stage, metrics, layout, run_id, on_fail, incremental, previous_run, rejected_updates, recency, buckets, file_bytes, entity)
    finally:
        remove(spark, stage)


def _staged_totals(spark: SparkSession, stage: str, flags: Mapping[str, str]) -> dict[str, int]:
    """Totals of the rules and verdicts, from the flag columns of the stored rows."""
    schema = schemas.StructType([*[schemas.StructField(c, schemas.BooleanType()) for c in flags.values()], *schemas.struct_of("verdict").fields])
    counted = [F.count_if(c).alias(n) for n, c in flags.items()]
    accepted = F.count_if(F.col("verdict") == ACCEPTED).alias(ACCEPTED)
    return _one_row(read_layer(spark, stage, schema).agg(*counted, accepted, F.count_if(F.col("verdict") != ACCEPTED).alias("rejected")))


def _store_silver(
    spark: SparkSession,
    stage: str,
    metrics: Mapping[str, int],
    layout: Layout,
    run_id: str,
    on_fail: str,
    incremental: bool,
    previous_run: str | None,
    rejected_updates: str,
    recency: Sequence[str],
    buckets: int | None,
    file_bytes: int,
    entity: Entity,
) -> Load:
    """Silver and quarantine from the staged rows."""
    with_verdict = schemas.StructType([*entity.silver.fields, *schemas.struct_of("verdict").fields])
    staged = read_layer(spark, stage, with_verdict)
    quarantine = path = written = None
    if metrics["rejected"] and on_fail == "quarantine":
        quarantine = layout.run("quarantine", run_id)
        write_layer(staged.filter(F.col("verdict") != ACCEPTED), quarantine, by=["verdict"])
    if incremental:
        layer = silver_layer(layout, entity)
        path = layer.root
        if rejected_updates == "keep":
            staged = staged.filter(F.col("verdict") == ACCEPTED)
        gone = F.col("verdict") != ACCEPTED
        # The chain says which run this one lies on; stopped attempts may lie on it too.
        written = layer.merge(staged, run_id, previous_run, gone, buckets, fresh=previous_run is None, branch=True)
    elif metrics[ACCEPTED]:
        path = layout.run("silver", run_id)
        compact(spark, f"{stage}/verdict={ACCEPTED}", path, entity.silver, [entity.partition], entity.key, file_bytes)
    return Load(path, metrics, quarantine, written)


def load_gold(
    silver: DataFrame,
    layout: Layout,
    run_id: str,
    ts: datetime | None = None,
    file_bytes: int = 512 * 1024 * 1024,
    entity: Entity = ENTITY,
) -> Load:
    """Entities per name, category and place, compacted and sorted by these columns. Runs
    lie side by side under `run_id`."""
    rows = stamp(rollup_count(silver, entity.dims, entity.key[0]), schemas.GOLD_TS, ts)
    stage, path = layout.run("staging_gold", run_id), layout.run("gold", run_id)
    write_layer(rows, stage)
    try:
        compact(silver.sparkSession, stage, path, entity.gold, (), entity.dims, file_bytes)
    finally:
        remove(silver.sparkSession, stage)
    return Load(path)


def silver_layer(layout: Layout, entity: Entity = ENTITY) -> BucketLayer:
    recency = tuple(entity.recency) or (schemas.BRONZE_TS,)
    return BucketLayer(layout.layer("silver_buckets"), entity.silver, entity.key, recency)


def gold_layer(layout: Layout, entity: Entity = ENTITY) -> BucketLayer:
    return BucketLayer(layout.layer("gold_buckets"), entity.gold, entity.dims, sums=("entity_count",))


def load_gold_changes(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    previous_run: str | None = None,
    ts: datetime | None = None,
    entity: Entity = ENTITY,
) -> Load:
    """Gold from what a silver merge changed: rows that left count -1 and rows that entered +1
    in their group, and these changes are merged into the stored counts of `previous_run`.

    Only the keys of the run's own delta are looked up in the silver before, in the buckets that
    hold them; the rest of silver is not read, and gold gets one small delta.
    """
    silver, gold = silver_layer(layout, entity), gold_layer(layout, entity)
    brought = silver.delta(spark, run_id)
    columns = list(dict.fromkeys([*entity.key, *silver.recency, *entity.dims]))
    before = silver.lookup(spark, previous_run, brought, columns)
    after = latest_per_key(before.unionByName(brought.select(*before.columns)), entity.key, [*silver.recency, RUN], ())
    changes = signed_changes(before.filter(f"NOT {GONE}"), after.filter(f"NOT {GONE}"), entity.dims, "entity_count")
    merged = gold.merge(stamp(changes, schemas.GOLD_TS, ts), run_id, previous_run, fresh=previous_run is None, branch=True)
    return Load(gold.root, merge=merged)


def record_metrics(
    spark: SparkSession, done: Mapping[str, Load], layout: Layout, label: str, stopped: str = "", ts: datetime | None = None
) -> str:
    """Store the totals of an attempt's loads as rows (load, metric, value, stopped, at)."""
    rows = [(load, name, int(value), stopped) for load, own in done.items() for name, value in own.metrics.items()]
    path = layout.run("metrics", label)
    frame = spark.createDataFrame(rows or [("none", "none", 0, stopped)], "load string, metric string, value long, stopped string")
    write_layer(stamp(frame, "at", ts).coalesce(1), path)
    return path


def run_loads(
    spark: SparkSession,
    pages: DataFrame,
    layout: Layout,
    run_id: str,
    listed_pages: DataFrame | None = None,
    total_pages: int | None = None,
    recency: Sequence[str] | None = None,
    tie_break: Sequence[str] | None = None,
    allow_truncated: bool = False,
    allow_unnumbered: bool = False,
    first_page: int = 1,
    skip_failed: bool = False,
    patterns: Mapping[str, str] | DataFrame = POSTAL_US,
    limits: Mapping[str, int] | None = None,
    on_fail: str = "raise",
    salt: str = "",
    incremental: bool = False,
    previous_run: str | None = None,
    fresh: bool = False,
    branch: bool = False,
    rejected_updates: str = "remove",
    history: HistoryGate | None = None,
    publish: Mapping[str, str] | None = None,
    ts: datetime | None = None,
    entity: Entity = ENTITY,
) -> dict[str, Load]:
    """Landing, bronze, silver and gold in turn. A load that raises or has nothing to
    write stops the ones after it; layers published by earlier runs stay as they are.

    A run that was stopped can be repeated under its id: each attempt writes folders of its own
    and stores its totals, and nobody reads an attempt that did not finish. A finished id is
    not used again.

    An `incremental` run merges into the silver and gold of the newest finished run. Another
    `previous_run` is refused if a finished run lies on it already, as that one's records would be
    left out, unless `branch` asks for it; `fresh` starts new layers beside the old ones.

    `limits` may name any total of the bronze and silver loads; unknown names are refused
    before a job runs. With `history` totals that lie far from those of the lake's finished runs
    stop the run like a broken limit. `publish` maps `silver` and `gold` to catalog names that are moved
    to this run at the end (of an incremental run a compacted copy of gold; its silver is not
    published, as its folders belong to many runs).
    """
    _limits(limits, on_fail, [*RULES, *BRONZE_TOTALS])
    if publish and set(publish) - {"silver", "gold"}:
        raise ValueError("only silver and gold can be published")
    label = next_attempt(spark, layout, run_id)
    base = base_run(spark, layout, previous_run, fresh, branch) if incremental else None
    bounds = bounds_for_next(spark, layout, history) if history else {}
    done: dict[str, Load] = {}
    try:
        done["landing"] = load_landing(pages, layout, label, entity)
        landed = read_layer(spark, done["landing"].path, entity.renamed(pages).schema)
        done["bronze"] = load_bronze(
            landed,
            layout,
            label,
            listed_pages=listed_pages,
            total_pages=total_pages,
            recency=recency,
            tie_break=tie_break,
            allow_truncated=allow_truncated,
            allow_unnumbered=allow_unnumbered,
            first_page=first_page,
            skip_failed=skip_failed,
            ts=ts,
            entity=entity,
        )
        check_drift(done["bronze"].metrics, bounds.get("bronze", {}))
        if done["bronze"].path is not None:
            done["silver"] = load_silver(
                read_layer(spark, done["bronze"].path, entity.bronze),
                layout,
                label,
                patterns=patterns,
                limits=limits,
                on_fail=on_fail,
                salt=salt,
                earlier=done["bronze"].metrics,
                bounds=bounds.get("silver"),
                incremental=incremental,
                previous_run=base,
                rejected_updates=rejected_updates,
                ts=ts,
                entity=entity,
            )
        if "silver" in done and done["silver"].path is not None:
            if incremental:
                done["gold"] = load_gold_changes(spark, layout, label, base, ts, entity)
            else:
                done["gold"] = load_gold(read_silver(spark, done["silver"], label, entity), layout, label, ts, entity=entity)
    except Exception as why:
        if isinstance(why, QualityGateError):
            done["silver"] = Load(None, why.metrics)
        record_metrics(spark, done, layout, label, f"{type(why).__name__}: {why}"[:1000], ts)
        raise
    record_metrics(spark, done, layout, label, ts=ts)
    _publish(spark, done, layout, label, publish or {}, entity)
    finish_run(spark, layout, run_id, label, base, incremental and "gold" in done)
    return done


def read_silver(spark: SparkSession, load: Load, run_id: str | None = None, entity: Entity = ENTITY) -> DataFrame:
    """The silver that a load stored, bucketed or not."""
    if load.merge is not None:
        recency = tuple(entity.recency) or (schemas.BRONZE_TS,)
        return BucketLayer(load.path, entity.silver, entity.key, recency).read(spark, load.merge.run_id)
    return read_layer(spark, load.path, entity.silver)


def read_gold(spark: SparkSession, load: Load, entity: Entity = ENTITY) -> DataFrame:
    """The gold that a load stored, bucketed or not."""
    if load.merge is not None:
        layer = BucketLayer(load.path, entity.gold, entity.dims, sums=("entity_count",))
        return layer.read(spark, load.merge.run_id)
    return read_layer(spark, load.path, entity.gold)


def _publish(spark: SparkSession, done: Mapping[str, Load], layout: Layout, label: str, names: Mapping[str, str], entity: Entity) -> None:
    by = {"silver": [entity.partition], "gold": []}
    schema = {"silver": entity.silver, "gold": entity.gold}
    for layer, name in names.items():
        load = done.get(layer)
        if load is None or load.path is None or (layer == "silver" and load.merge is not None):
            continue
        path = load.path
        if load.merge is not None:
            path = layout.run("gold", label)
            rows = read_gold(spark, load, entity).repartitionByRange(*entity.dims).sortWithinPartitions(*entity.dims)
            write_layer(rows, path)
        create_namespaces(spark, [name.rpartition(".")[0]] if "." in name else [])
        publish_table(spark, name, label, path, schema[layer], by[layer])
