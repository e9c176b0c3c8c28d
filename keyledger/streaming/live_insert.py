"""Live inserts (F1, B13) and extraction while they go on (F2).

The original starts an endless rate-limited loop inside executor tasks.  Here
it is a Structured Streaming query: the ``rate-micro-batch`` source gives a
steady, deterministic stream of sequence numbers, each becomes a new-user
event (``id = mock:id:(n + value mod n)``), and ``foreachBatch`` appends each
micro-batch to the event table.  Each batch is written to its own
``batch_id=<epoch>`` directory and then named in ``_committed``, one marker a
batch.  A snapshot of the table is the batches named at that moment: a batch that
is being written, or was left half written, has no rows in it.  A batch replayed
after a failure replaces what was left of it; one that is committed is not
written again, so no reader sees its files go.  The total rate is what is asked
for (not rate x partitions).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keyledger import schemas
from keyledger.functions.columns import timeuuid_from_millis
from keyledger.functions.constants import MOCK_ID


def new_user_events(stream: DataFrame, n_existing: int) -> DataFrame:
    """Rate rows ``(timestamp, value)`` -> raw core events of new users."""
    n = max(int(n_existing), 1)
    uid = F.lit(n).cast("bigint") + F.pmod(F.col("value"), F.lit(n))
    ms = F.unix_millis(F.col("timestamp"))
    id_col = F.concat(F.lit(MOCK_ID), uid.cast("string"))
    payload = F.to_json(F.struct(
        F.array().cast("array<string>").alias("$rem"), F.lit("").alias("model"), id_col.alias("id"),
        ms.alias("time"), F.lit("").alias("source"), F.struct(id_col.alias("id")).alias("$set"),
        F.lit(1).alias("version"), F.lit(False).alias("snapshot")))
    return stream.select(id_col.alias("id"),
                         timeuuid_from_millis(ms, node=F.col("value")).alias("time"),
                         payload.alias("payload"), F.col("value").alias("seq_no"))


def _append_batch(target: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if epoch_id not in committed_batches(spark, target):
            batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch_id={epoch_id}")
            commit_batch(spark, target, epoch_id)
    return write


def _markers(spark: SparkSession, target: str, name: str = ""):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/_committed{name}")
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def commit_batch(spark: SparkSession, target: str, batch_id: int) -> None:
    """Name a batch whose files are complete: from now on snapshots have it."""
    fs, path = _markers(spark, target, f"/{batch_id}")
    fs.create(path, True).close()


def committed_batches(spark: SparkSession, target: str) -> list[int]:
    fs, path = _markers(spark, target)
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(path)) if fs.exists(path) else []


def snapshot(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows of the batches committed at this moment, with ``batch_id``; the
    frame keeps to them however often it is read."""
    schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    paths = [f"{target.rstrip('/')}/batch_id={n}" for n in committed_batches(spark, target)]
    return spark.read.schema(schema).option("basePath", target).parquet(*paths) if paths else spark.createDataFrame([], schema)


def event_table(spark: SparkSession, target: str) -> DataFrame:
    """A1, F2: the event table as it is at this moment: batches committed later, or
    being written, are not read."""
    return snapshot(spark, target, schemas.RAW_EVENT).select("id", "time", "payload")


def start_live_insert(spark: SparkSession, n_existing: int, target: str, checkpoint: str,
                      rows_per_batch: int, trigger_seconds: float | None = None,
                      available_now: bool = False, start_ms: int | None = None) -> StreamingQuery:
    """Start appending new-user events to ``target``, dated from ``start_ms``
    (default: now) and a trigger interval further with every batch.

    ``available_now``: run exactly one micro-batch of ``rows_per_batch`` rows
    and stop (bounded runs, tests).  Otherwise run every ``trigger_seconds``
    until stopped: ``rows_per_batch / trigger_seconds`` rows per second."""
    src = (spark.readStream.format("rate-micro-batch")
           .option("rowsPerBatch", int(rows_per_batch))
           .option("startTimestamp", int(time.time() * 1000) if start_ms is None else start_ms)
           .option("advanceMillisPerBatch", int(1000 * (trigger_seconds or 1)))
           .load())
    w = new_user_events(src, n_existing).writeStream.foreachBatch(_append_batch(target)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds or 1} seconds")
    return w.start()


def insert_batches(spark: SparkSession, n_existing: int, target: str, checkpoint: str,
                   rows_per_batch: int, batches: int, start_ms: int | None = None) -> None:
    """Run ``batches`` micro-batches to completion, one after the other,
    resuming from the same checkpoint each time."""
    for _ in range(batches):
        q = start_live_insert(spark, n_existing, target, checkpoint, rows_per_batch, available_now=True, start_ms=start_ms)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def await_batches(query: StreamingQuery, batches: int) -> None:
    """Wait until a running insert has finished ``batches`` batches."""
    while query.lastProgress is None or query.lastProgress["batchId"] < batches - 1:
        if not query.isActive:
            raise query.exception() or RuntimeError("the live insert was stopped")
        time.sleep(0.1)


def stop_between_batches(query: StreamingQuery, patience_seconds: float = 30.0) -> None:
    """Stop a running insert while no batch is being written, so that none is
    interrupted half way; one that never rests is stopped after a while all the same."""
    deadline = time.time() + patience_seconds
    while query.isActive and query.status["isTriggerActive"] and time.time() < deadline:
        time.sleep(0.02)
    query.stop()


def read_inserted(spark: SparkSession, target: str) -> DataFrame:
    """The events appended so far (``id, time, payload, seq_no, batch_id``)."""
    return snapshot(spark, target, T.StructType([*schemas.RAW_EVENT.fields, T.StructField("seq_no", T.LongType())]))
