"""Which runs of a lake are finished, and the attempts of a run.

A run that stops leaves the folders of its attempt behind; the next attempt writes its own. Only
the record that `finish_run` stores at the very end makes a run count, so a run that was stopped at
any point can be repeated and nothing of it is read.
"""

from __future__ import annotations

from pyspark.sql import Row, SparkSession

from terrace.schemas import Layout
from terrace.session import exists, get_records, put_record
from terrace.sinks import StaleBaseError

FINISHED = Row("run_id", "label", "number", "previous", "incremental")


def finished_runs(spark: SparkSession, layout: Layout) -> list[Row]:
    """The finished runs of a lake, oldest first: one row a run."""
    return sorted((FINISHED(*r) for r in get_records(spark, layout.layer("finished"))), key=lambda r: (r.number, r.run_id))


def next_attempt(spark: SparkSession, layout: Layout, run_id: str) -> str:
    """The label of the folders of the run's next attempt: its id, then id-attempt2, ..."""
    if exists(spark, f"{layout.layer('finished')}/{run_id}.json"):
        raise ValueError(f"run {run_id} is finished; a run id is used once")
    label, number = run_id, 1
    while exists(spark, layout.run("landing", label)) or exists(spark, layout.run("metrics", label)):
        number += 1
        label = f"{run_id}-attempt{number}"
    return label


def base_run(spark: SparkSession, layout: Layout, previous_run: str | None, fresh: bool, branch: bool) -> str | None:
    """The label of the finished incremental run that the next one lies on; None for a new layer."""
    runs = [r for r in finished_runs(spark, layout) if r.incremental]
    if fresh:
        if previous_run is not None:
            raise ValueError("a fresh layer has no previous run")
        return None
    if previous_run is None:
        return runs[-1].label if runs else None
    base = next((r for r in runs if r.run_id == previous_run), None)
    if base is None:
        raise StaleBaseError(f"there is no finished incremental run {previous_run}")
    later = [r.run_id for r in runs if r.previous == base.label]
    if later and not branch:
        raise StaleBaseError(f"run {later[-1]} lies on {previous_run} already; name the newest run or ask for a branch")
    return base.label


def finish_run(spark: SparkSession, layout: Layout, run_id: str, label: str, previous: str | None, incremental: bool) -> None:
    number = 1 + max((r.number for r in finished_runs(spark, layout)), default=0)
    put_record(spark, f"{layout.layer('finished')}/{run_id}.json", (run_id, label, number, previous, incremental))
