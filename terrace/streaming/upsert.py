"""A stream of records merged into a keyed layer, batch by batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import latest_per_key
from terrace.session import scratch_dir, setting, small_files
from terrace.sinks import BucketLayer

ARRIVED = "_arrived"
# Keeps the state on the executors' disks, not on their heaps.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_of_stream(rows: DataFrame, layer: BucketLayer, redelivered_within: str) -> DataFrame:
    """The stream without records that came before: same key and same recency within the given
    time of arrival. That is the state the stream keeps, and the watermark lets go of it.

    The event time is the time of arrival, so a record that is old by its own recency is never
    late and never dropped; whether it still counts is decided by the layer.
    """
    marked = rows.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, redelivered_within)
    return marked.dropDuplicatesWithinWatermark([*layer.keys, *layer.recency]).drop(ARRIVED)


def stream_upserts(
    spark: SparkSession,
    rows: DataFrame,
    layer: BucketLayer,
    checkpoint: str,
    name: str,
    gone: Column | None = None,
    redelivered_within: str = "2 days",
) -> list[str]:
    """Merge what the stream brings into `layer` and stop when it is empty; returns the merges.

    Each micro-batch is one merge, `name` and the batch number, and holds the newest record of
    each of its keys; between batches the layer keeps the newest by recency, so batches may come
    in any order. A batch that is run again after a failure finds its merge done, or does it. Rows
    without a key are left out, and of records of one key and recency in a batch the largest
    stays. `checkpoint` must be on shared storage and belongs to this `name`.
    """
    merged: list[str] = []
    keyed = rows.dropna(subset=list(layer.keys))

    def put(batch: DataFrame, number: int) -> None:
        run_id = f"{name}-{number:09}"
        path = f"{scratch_dir(spark, 'upsert')}/batch"
        # Also of a batch that is merged already: its rows must pass for the state to be stored.
        latest_per_key(batch, layer.keys, layer.recency).write.parquet(path)
        stored = spark.read.schema(batch.schema).parquet(path)
        if stored.isEmpty() or run_id in {r.run_id for r in layer.runs(spark)}:
            return
        layer.merge(stored, run_id, gone=gone)
        merged.append(run_id)

    stream = newest_of_stream(keyed, layer, redelivered_within)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # The stream lists its files by the settings of the session that made it, while it runs.
    with small_files(spark), setting(spark, "spark.sql.streaming.stateStore.providerClass", STATE_STORE):
        writer.foreachBatch(put).start().awaitTermination()
    return merged


def recency_columns(layer: BucketLayer) -> Mapping[str, Column]:
    """The layer's recency columns cast from text, for records read as text."""
    return {c: F.col(c).try_cast(layer.schema[c].dataType) for c in layer.recency}
