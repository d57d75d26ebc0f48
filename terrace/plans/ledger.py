"""A ledger of page files, and the load of what it does not have yet.

Every attempt stores the page files that it saw and, at its end, what became of each: `loaded`,
`refused` (the file is broken, or the gate stopped the attempt) or `left` (it lies behind a page
that is missing or broken). The files of the next run are those that the ledger does not have as
loaded with the same size and time, so a run that was stopped is repeated with all that it brought,
a page that is repaired later is loaded alone, and a page that is delivered again in a corrected
form is taken again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.operators import stamp
from terrace.plans.loads import ENTITY, Load, run_loads
from terrace.plans.runs import next_attempt
from terrace.schemas import Entity, Layout
from terrace.session import exists
from terrace.sinks import write_layer
from terrace.sources import list_page_files, read_page_files
from terrace.sources.pages import FAILED, PAGE

LEDGER = "file string, length long, modified timestamp, page long, state string, reason string, run_id string, label string, at timestamp"
FILE = ("file", "length", "modified")
LOADED, REFUSED, LEFT, SEEN = "loaded", "refused", "left", "seen"


def ledger(spark: SparkSession, layout: Layout) -> DataFrame:
    """All entries of all attempts."""
    path = layout.layer("ledger")
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(path)


def page_states(spark: SparkSession, layout: Layout) -> DataFrame:
    """The newest entry of each file; an attempt's outcome comes after what it saw."""
    order = F.struct("at", (F.col("state") != SEEN).alias("ended"), "label", "length", "modified")
    newest = F.max_by(F.struct("page", "state", "reason", "run_id", "label", "at"), order).alias("entry")
    return ledger(spark, layout).groupBy("file").agg(newest).select("file", "entry.*")


def open_files(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """The page files (file, length, modified, page) that are not loaded as they are now."""
    loaded = ledger(spark, layout).filter(F.col("state") == LOADED).select(*FILE)
    # Never a broadcast: paths are small as stored, and large in a table on the driver.
    return list_page_files(spark, path).join(loaded.hint("merge"), list(FILE), "left_anti")


def _record(files: DataFrame, layout: Layout, run_id: str, label: str, part: str) -> str:
    """Store entries (`files` has state and reason) in a folder of their own; returns it. An
    attempt that ends before it lands anything leaves its label to the next one.

    The few files come of a shuffle: tasks that each took a share of all partitions would hold what
    the join above needs once a partition."""
    rows = files.withColumns({"run_id": F.lit(run_id), "label": F.lit(label)})
    names = [field.split()[0] for field in LEDGER.split(", ")]
    path = f"{layout.layer('ledger')}/{part}={label}-{uuid.uuid4().hex[:12]}"
    write_layer(stamp(rows, "at").select(*names).hint("rebalance"), path)
    return path


def _outcome(files: DataFrame, landed: DataFrame, boundary: int, skip_failed: bool) -> DataFrame:
    """What became of each file of a finished run."""
    pages = landed.groupBy(PAGE).agg(F.max(FAILED).alias("failed")).withColumnRenamed(PAGE, "page")
    known = files.join(pages, "page", "left")
    failed = F.coalesce(F.col("failed"), F.lit(False))
    behind = F.lit(False) if skip_failed else F.coalesce(F.col("page") >= boundary, F.lit(False))
    state = F.when(failed, REFUSED).when(behind, LEFT).otherwise(LOADED)
    reason = F.when(failed, "not readable").when(behind, f"behind page {boundary}").otherwise("")
    return known.withColumns({"state": state, "reason": reason}).drop("failed")


def load_new_pages(
    spark: SparkSession,
    path: str,
    layout: Layout,
    run_id: str,
    multi_line: bool = True,
    fields: StructType | None = None,
    first_page: int = 1,
    skip_failed: bool = False,
    entity: Entity = ENTITY,
    **options: object,
) -> dict[str, Load]:
    """Merge the page files below `path` that no finished run has loaded into the incremental
    layers; `options` go to `run_loads`. Without such files nothing is done and the id stays free.

    Pages count from `first_page` over all runs: a page is missing if neither the ledger nor the
    folder has it. `skip_failed` loads what lies behind a missing or broken page at once; records
    are merged by recency, so their order does not matter.
    """
    label = next_attempt(spark, layout, run_id)
    seen = open_files(spark, path, layout).withColumns({"state": F.lit(SEEN), "reason": F.lit("")})
    folder = _record(seen, layout, run_id, label, "seen")
    # From here on the files are those that were listed, also if more arrive.
    files = spark.read.schema(LEDGER).parquet(folder).select(*FILE, "page")
    if files.isEmpty():
        return {}
    rows = read_page_files(spark, files, fields or entity.read_fields, multi_line)
    known = ledger(spark, layout).filter(F.col("state") == LOADED).select("page").unionByName(files.select("page"))
    listed = known.select(F.col("page").alias(PAGE), F.lit(False).alias(FAILED))
    try:
        done = run_loads(
            spark, rows, layout, run_id, listed, first_page=first_page, skip_failed=skip_failed, incremental=True, entity=entity, **options
        )
    except Exception as why:
        reason = F.lit(f"{type(why).__name__}: {why}"[:500])
        _record(files.withColumns({"state": F.lit(REFUSED), "reason": reason}), layout, run_id, label, "ended")
        raise
    landed = spark.read.parquet(done["landing"].path).select(PAGE, FAILED)
    _record(_outcome(files, landed, done["bronze"].metrics["boundary"], skip_failed), layout, run_id, label, "ended")
    return done
