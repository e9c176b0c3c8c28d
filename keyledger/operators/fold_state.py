"""The fold as a stored state that takes new events.

``max_by(value, order)`` needs of the past only, per id and field, the last
touching event's order and the value it left.  That is the state: one row per
id, ``member`` (is it a user), and per tracked field ``o_<field>`` (the order, null:
never touched) and ``v_<field>`` (the value, null: removed).  Two states merge
field by field, the greater order winning, whichever came first: events that
arrive late, twice, or in another batch than their neighbours give the same state
as one fold of the whole log.  So a day's run reads that day's events and the
buckets of the ids they touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyledger.operators.events import log_rows
from keyledger.operators.families import EventFamily, TrackedField, family_of
from keyledger.sinks import buckets

ORDER = T.StructType([T.StructField("time_ms", T.LongType()), T.StructField("ticks", T.LongType()), T.StructField("time", T.StringType())])


def tracked(families: list[str | EventFamily]) -> tuple[TrackedField, ...]:
    return tuple(f for family in families for f in family_of(family).fields)


def state_schema(families: list[str | EventFamily]) -> T.StructType:
    fields = [T.StructField("id", T.StringType()), T.StructField("member", T.BooleanType())]
    for f in tracked(families):
        fields += [T.StructField(f"o_{f.name}", ORDER), T.StructField(f"v_{f.name}", T.StringType())]
    return T.StructType(fields)


def fold_state(logs: list[tuple[str | EventFamily, DataFrame]], members: tuple[str, ...] = ("core",), on_bad: str = "fail") -> DataFrame:
    """The state of some events: one shuffle, partial on the map side."""
    aggs = [F.max("is_member").alias("member")]
    for f in tracked([family for family, _ in logs]):
        order = F.when(F.col(f"t_{f.name}"), F.col("_ord"))
        aggs += [F.max(order).alias(f"o_{f.name}"), F.max_by(F.col(f"v_{f.name}"), order).alias(f"v_{f.name}")]
    return log_rows(logs, members, on_bad).groupBy("id").agg(*aggs)


def merge_states(states: DataFrame, fields: tuple[TrackedField, ...], by: tuple[str, ...] = ("id",)) -> DataFrame:
    """One state of several rows per id."""
    aggs = [F.max("member").alias("member")]
    for f in fields:
        o, v = F.col(f"o_{f.name}"), F.col(f"v_{f.name}")
        aggs += [F.max(o).alias(f"o_{f.name}"), F.max_by(v, o).alias(f"v_{f.name}")]
    return states.groupBy(*by).agg(*aggs)


def current_fields(state: DataFrame, fields: tuple[TrackedField, ...]) -> DataFrame:
    """``id`` and the fields of every user, as ``events.populate_from_logs`` gives them."""
    return state.where(F.col("member")).select("id", *[F.col(f"v_{f.name}").alias(f.name) for f in fields])


def create_state(spark: SparkSession, state_dir: str, families: list[str | EventFamily], n_buckets: int = buckets.N_BUCKETS) -> None:
    buckets.create(spark, state_dir, state_schema(families), ["id"], n_buckets)


def update_state(spark: SparkSession, state_dir: str, batch: DataFrame, fields: tuple[TrackedField, ...]) -> list[int]:
    """Merge a batch's state (``fold_state``, staged) into the stored one; only
    the buckets of its ids are read and rewritten.  The same batch again changes
    nothing."""
    return buckets.merge(spark, state_dir, batch, lambda rows: merge_states(rows, fields, ("bucket", "id")))


def read_state(spark: SparkSession, state_dir: str, only: list[int] | None = None) -> DataFrame:
    return buckets.read(spark, state_dir, only).drop("bucket")
