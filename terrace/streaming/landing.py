"""Incremental landing: each run takes the page files that no earlier run has taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from terrace.schemas import RAW
from terrace.session import small_files
from terrace.sources.pages import stream_pages


def land_new_pages(
    spark: SparkSession,
    pages: str,
    landing: str,
    checkpoint: str,
    fields: StructType = RAW,
    multi_line: bool = True,
    max_files_per_batch: int | None = None,
    run_id: str | None = None,
) -> str:
    """Add the new page files under `pages` to the landing table, then stop; returns where.

    With `run_id` the new rows go to a folder of their own below `landing`, one per batch,
    so that a load can take just what this run brought. A batch that is run again after a
    failure writes its folder anew; repeat a failed run under its own id. Without `run_id`
    the rows are appended to `landing` itself, and the file sink's log makes each batch
    land once. `checkpoint` must be on shared storage.
    """
    reader_limit = {} if max_files_per_batch is None else {"maxFilesPerTrigger": max_files_per_batch}
    rows = stream_pages(spark, pages, fields, multi_line, checkpoint, **reader_limit)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if run_id is None:
        writer, target = writer.format("parquet").option("path", landing), landing
    else:
        target = f"{landing.rstrip('/')}/run_id={run_id}"

        def put(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

        writer = writer.foreachBatch(put)
    # The stream lists its files by the settings of the session that made it, while it runs.
    with small_files(spark):
        writer.start().awaitTermination()
    return target
