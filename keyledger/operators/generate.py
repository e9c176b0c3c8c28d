"""Mock event generation (A9, S19, S20), distributed: ids x events come from
``explode(sequence(...))`` over the users frame, never from a driver loop."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.functions.columns import timeuuid_from_millis
from keyledger.functions.constants import MOCK_ID

DAY_MS = 86_400_000


def events_per_user(seed: int, low: int = 5, span: int = 10) -> int:
    """One event count for all users, drawn once: ``low`` to ``low+span-1``."""
    return low + random.Random(seed).randrange(span)


def mock_ids(n: int | DataFrame, spark=None, inclusive_end: bool = False) -> DataFrame:
    """``mock:id:i`` for i in [0, n) (or for the ``i`` column of a frame).
    ``inclusive_end`` also makes ``mock:id:n``, as a range split whose last
    chunk ends at ``to n`` does (K19)."""
    if isinstance(n, DataFrame):
        base = n.select(F.col("i").alias("id"))
    else:
        base = spark.range(n + 1 if inclusive_end else n)
    return base.select(F.concat(F.lit(MOCK_ID), F.col("id").cast("string")).alias("id"))


def seed_core_events(users: DataFrame, n_events: int, anchor_ms: int, max_days: int = 100,
                     seed: int = 17) -> DataFrame:
    """``n_events`` core events per user id, each at ``anchor_ms`` minus 1 to
    ``max_days`` days; the payload `$set` carries only the id, and the other
    envelope fields keep their defaults.  Output ``(id, time, payload)`` ready to
    append to an event table.

    The day comes from a hash of seed, id and event number, so the same call
    gives the same rows however its input is partitioned or retried."""
    ev = users.select("id", F.explode(F.sequence(F.lit(0), F.lit(n_events - 1))).alias("event_no"))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id"), F.col("event_no").cast("string")))
    days = F.pmod(F.conv(F.substring(draw, 1, 8), 16, 10).cast("bigint"), F.lit(max_days)) + 1
    ev = ev.withColumn("_ms", F.lit(anchor_ms).cast("bigint") - days * F.lit(DAY_MS))
    payload = F.to_json(F.struct(
        F.array().cast("array<string>").alias("$rem"), F.lit("").alias("model"), F.col("id").alias("id"),
        F.col("_ms").alias("time"), F.lit("").alias("source"),
        F.struct(F.col("id").alias("id")).alias("$set"), F.lit(1).alias("version"),
        F.lit(False).alias("snapshot")))
    # Distinct uuids for a user's events of one instant: the event number fills
    # the 48 node bits, a hash of the id the clock bits.
    clock = F.conv(F.substring(F.md5(F.col("id")), 1, 4), 16, 10).cast("bigint")
    time = timeuuid_from_millis(F.col("_ms"), node=F.col("event_no"), clock_seq=clock)
    return ev.select("id", time.alias("time"), payload.alias("payload"))
