"""Ids cut into JSON message batches for a topic or a queue.

The original cuts each partition's iterator into groups of 50 (and, for the
queue, groups of 10 messages per request), so its batches depend on how the
data happens to be partitioned.  Here a batch is defined by a bucket of the id
(a hash by default) and the id's position in its bucket, so the result repeats
from run to run.  Positions come from ``rank_within``: the ids are range
partitioned on (bucket, id), so a large bucket is spread over many tasks.
Gathering a batch collects at most ``batch_size`` ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyledger.functions.columns import ids_json
from keyledger.functions.constants import IDS_PER_MESSAGE, MESSAGES_PER_REQUEST
from keyledger.operators.ranking import rank_within


N_BUCKETS = 64  # of the default bucket, whatever the cluster's settings: batches do not depend on them


def hash_bucket(id_col: str = "id", n_buckets: int = N_BUCKETS) -> Column:
    """Default bucket: a 64-bit hash of the id modulo ``n_buckets``."""
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_buckets))


def _positions(ids: DataFrame, bucket: Column | None, n_buckets: int) -> DataFrame:
    bucket = hash_bucket("id", n_buckets) if bucket is None else bucket
    return rank_within(ids.select(bucket.cast("bigint").alias("bucket"), F.col("id")), ["bucket"], ["id"])


def run_uuid(run_id: str, *parts: Column) -> Column:
    """A uuid text that differs from run to run and is the same however
    often a task of the run is tried: the hash of the run and the parts."""
    h = F.md5(F.concat_ws("|", F.lit(run_id), *parts))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4),
                       F.substring(h, 21, 12))


def _gather(ranked: DataFrame, group_cols: list[str]) -> DataFrame:
    g = ranked.groupBy(*group_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col("seq"), F.col("id")))).alias("_b"))
    return g.select(*group_cols, F.transform(F.col("_b"), lambda x: x["id"]).alias("ids"))


def topic_messages(ids: DataFrame, batch_size: int = IDS_PER_MESSAGE, bucket: Column | None = None,
                   n_buckets: int = N_BUCKETS) -> DataFrame:
    """One message per ``batch_size`` ids of a bucket, ordered by id:
    ``bucket, batch_no, n_ids, ids, body`` where ``body`` is the JSON array
    of ids (S10, S17).  ``bucket`` may be any integer column expression over
    ``id``; the default is a hash modulo ``n_buckets``."""
    r = _positions(ids, bucket, n_buckets).withColumn("batch_no", F.expr(f"(seq - 1) div {int(batch_size)}"))
    g = _gather(r, ["bucket", "batch_no"])
    return g.select("bucket", "batch_no", F.size("ids").cast("bigint").alias("n_ids"), "ids",
                    ids_json(F.col("ids")).alias("body"))


def queue_messages(ids: DataFrame, batch_size: int = IDS_PER_MESSAGE, per_request: int = MESSAGES_PER_REQUEST,
                   bucket: Column | None = None, n_buckets: int = N_BUCKETS, run_id: str | None = None) -> DataFrame:
    """Entries of ``batch_size`` ids, ``per_request`` entries per send
    request: ``bucket, request_no, entry_no, entry_id, n_ids, body``.

    ``entry_id`` is ``bucket-entry_no`` so the output repeats; with a
    ``run_id`` it is a uuid of that run (S18), as a live sender uses."""
    m = topic_messages(ids, batch_size, bucket, n_buckets).withColumnRenamed("batch_no", "entry_no")
    place = [F.col("bucket").cast("string"), F.col("entry_no").cast("string")]
    entry_id = F.concat_ws("-", *place) if run_id is None else run_uuid(run_id, *place)
    return m.select("bucket", F.expr(f"entry_no div {int(per_request)}").alias("request_no"), "entry_no",
                    entry_id.alias("entry_id"), "n_ids", "body")


def queue_requests(messages: DataFrame) -> DataFrame:
    """The send requests of ``queue_messages``: one row per request with its
    entries (at most ``per_request``, so the group is bounded)."""
    return messages.groupBy("bucket", "request_no").agg(
        F.array_sort(F.collect_list(F.struct("entry_no", "entry_id", "body"))).alias("entries"),
        F.sum("n_ids").alias("n_ids"))
