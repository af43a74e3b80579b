"""Structured Streaming form of the change-feed collapse (STR1-STR3).

* STR1: the Bronze change feed is a file source; the checkpoint records which
  files were consumed, so each run (``trigger(availableNow=True)``) takes only new
  changes.
* STR2: state per key is ``max_by(row, (lsn, seqval, op, *tiebreakers))`` - the
  same total order as the batch collapse. Output mode ``update`` emits the keys a
  micro-batch touched with their current latest change.
* STR3: a delete stays in state as the key's latest change (a tombstone), so an
  out-of-order insert with an older LSN cannot bring the key back. Deletes are
  filtered when the table is read.

Sink: ``foreachBatch`` writes each micro-batch's changed keys to
``<sink>/batches/<id>`` with overwrite, so a batch replayed after a failure
replaces its own output. The current table is the highest batch per key, minus
tombstones. ``compact`` folds the batches up to the last one into a base table and retires
their folders, so a read sees the base and the few batches after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.operators.cdc import drop_change_metadata
from terrace.operators.silver import keep_first
from terrace.sources import lake
from terrace.specs import CHANGE_LSN, CHANGE_OPERATION, CHANGE_SEQVAL, OP_DELETE

BATCH_COL = "batch_id"
BASE = "base"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_changes(stream: DataFrame, key: Sequence[str], tiebreakers: Sequence[str] = ()) -> DataFrame:
    """Streaming aggregate: the latest change row per key (tombstones included)."""
    payload = [c for c in stream.columns if c not in key]
    order = F.struct(
        F.col(CHANGE_LSN), F.col(CHANGE_SEQVAL), F.col(CHANGE_OPERATION), *[F.col(c) for c in tiebreakers]
    )
    agg = stream.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in payload]), order).alias("__row"))
    return agg.select(*key, *[F.col(f"__row.{c}").alias(c) for c in payload])


def _writer(sink: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .parquet(f"{sink}/batches/{batch_id:012d}")
        )

    return write


def run_stream(
    spark: SparkSession,
    feed_path: str,
    schema: StructType,
    key: Sequence[str],
    sink: str,
    checkpoint: str,
    tiebreakers: Sequence[str] = (),
    max_files_per_trigger: int | None = None,
    rocksdb: bool = True,
) -> int:
    """Consume every new file of the feed and stop (``availableNow``); returns the
    number of micro-batches run."""
    if rocksdb:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(feed_path)
    before = len(lake.folders(spark, f"{sink}/batches"))
    query = (
        latest_changes(stream, key, tiebreakers)
        .writeStream.outputMode("update")
        .foreachBatch(_writer(sink))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return len(lake.folders(spark, f"{sink}/batches")) - before


def _latest(spark: SparkSession, sink: str, key: Sequence[str]) -> DataFrame:
    """Latest change per key (tombstones included): the newest base and the batches after it."""
    bases = lake.folders(spark, f"{sink}/{BASE}")
    batches = lake.folders(spark, f"{sink}/batches")
    parts = [f"{sink}/{BASE}/{bases[-1]}"] if bases else []
    parts += [f"{sink}/batches/{b}" for b in batches if not bases or b > bases[-1]]
    return keep_first(spark.read.parquet(*parts), key, [F.col(BATCH_COL).desc()])


def current_state(spark: SparkSession, sink: str, key: Sequence[str]) -> DataFrame:
    """Current rows: the highest batch per key, tombstones removed, metadata dropped."""
    live = _latest(spark, sink, key).filter(F.col(CHANGE_OPERATION) != F.lit(OP_DELETE))
    return drop_change_metadata(live.drop(BATCH_COL))


def compact(spark: SparkSession, sink: str, key: Sequence[str]) -> None:
    """Fold every batch so far into a new base named after the last of them (a scheduled job).

    The base is complete before the folders it replaces are removed; a job that dies between
    leaves folders that no read uses, and the next run removes them.
    """
    batches, bases = lake.folders(spark, f"{sink}/batches"), lake.folders(spark, f"{sink}/{BASE}")
    if batches and (not bases or batches[-1] > bases[-1]):
        _latest(spark, sink, key).write.mode("overwrite").parquet(f"{sink}/{BASE}/{batches[-1]}")
        bases.append(batches[-1])
    for name in bases[:-1]:
        lake.remove(spark, f"{sink}/{BASE}/{name}")
    for name in batches:
        if bases and name <= bases[-1]:
            lake.remove(spark, f"{sink}/batches/{name}")
