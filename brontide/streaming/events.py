"""Status events as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from brontide.operators.events import (
    dedup_events, idempotency_key, merge_partial_states, merge_run_state, normalize_events, partial_run_state)
from brontide.schemas import CALLBACK
from brontide.sources import ledger, tables


def read_callbacks(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream of status events from a folder that receives raw callbacks as JSON files."""
    return normalize_events(spark.readStream.schema(CALLBACK).options(**options).json(path))


def _first_per_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column("idempotency_key").dictionary_encode().indices
        _, first = np.unique(codes.to_numpy(), return_index=True)
        yield batch.take(pa.array(np.sort(first)))


def dedup_event_stream(events: DataFrame, delay: str = "168 hours") -> DataFrame:
    """First arrival of every idempotency key, whatever time it tells of; a replay that arrives more than
    ``delay`` after it passes again.

    The watermark is on the time of arrival. On the events' own time it would drop first arrivals of old
    events, and one clock in the future would drop all that follow. A streaming deduplication shuffles
    every row by its key. Copies within an Arrow batch are dropped before, so a key that is replayed very
    often does not swamp one task.
    """
    keyed = events.withColumn("idempotency_key", idempotency_key())
    arrived = keyed.mapInArrow(_first_per_key, keyed.schema).withColumn("_arrived", F.current_timestamp())
    return (arrived.withWatermark("_arrived", delay)
                   .dropDuplicatesWithinWatermark(["idempotency_key"]).drop("_arrived"))


def dedup_for_good(events: DataFrame, path: str, ledger_root: str, checkpoint: str, order_by: list[str], **trigger) -> StreamingQuery:
    """File the first event of every idempotency key under ``path``, whatever time has passed since.

    Keys that were ever admitted are in a ledger, see ``sources/ledger.py``; of a micro-batch the first event of each key counts,
    by ``order_by``. A batch that is run again overwrites its folder with the same events. To be read with ``read_admitted``.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        new = ledger.admit(dedup_events(batch, order_by), ledger_root, batch_id)
        new.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())


def read_admitted(spark: SparkSession, path: str) -> DataFrame:
    """Admitted events with their ``batch``."""
    return spark.read.parquet(path)


def maintain_run_state(events: DataFrame, path: str, checkpoint: str, order_by: list[str],
                       fold_every: int = 100, **trigger) -> StreamingQuery:
    """Keep the state of all runs under ``path``.

    Each micro-batch adds the partial state of the runs it saw, in a folder of its own, so a
    batch costs what it holds and not what all runs hold. Every ``fold_every`` batches the
    partial states so far are merged into one snapshot. A batch that is run again after a failure
    overwrites its folder, and merging a partial state twice changes nothing. Snapshots but the last three
    are deleted, and the partial states that the snapshot of before already holds.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        (partial_run_state(batch, order_by)
            .write.mode("overwrite").parquet(f"{path}/partial/batch={batch_id}"))
        if (batch_id + 1) % fold_every == 0:
            folded = merge_partial_states(_partial_states(spark, path))
            tables.write_table(folded.withColumn("batch", F.lit(batch_id)), path, "folded", "parquet", keep=3)
            for name in tables.list_names(spark, f"{path}/partial"):
                if name.startswith("batch=") and int(name.removeprefix("batch=")) <= batch_id - fold_every:
                    tables.delete_path(spark, f"{path}/partial/{name}")

    return (events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())


def _partial_states(spark: SparkSession, path: str) -> DataFrame:
    """The last snapshot and the batches after it."""
    batches = spark.read.parquet(f"{path}/partial")
    if not tables.table_exists(spark, path, "folded", "parquet"):
        return batches
    folded = tables.scan_table(spark, path, "folded", "parquet")
    upto = folded.agg(F.max("batch")).first()[0]
    return folded.unionByName(batches.filter(F.col("batch") > upto))


def read_run_state(spark: SparkSession, path: str) -> DataFrame:
    return merge_run_state(_partial_states(spark, path))


def write_stream(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream to Parquet files, each row once per checkpoint."""
    return (df.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})).start())
