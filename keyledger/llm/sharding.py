"""Sharding by sampled splitters: shards of nearly equal bytes.

Rows are ordered by a key: a hash of the text, then a hash of the whole row, so
equal texts lie side by side and rows that agree in every column share a key.
A sample of the keys, each drawn with a chance in proportion to its weight,
gives splitters at the quantiles; records are moved once, to the range their
key falls in.  The exact weight of each range is known before anything moves,
and an overfull range is subdivided: by a further sample of its own keys, or,
where one key alone is overfull (a row repeated very often), by dealing its
copies to several parts.  The place of a row in the whole order is then its
range's offset and its place in the range, and a row goes to the shard in which
the middle of its bytes falls, so two shards differ by less than twice the
largest row.  Shards and slots do not depend on the sample, the number of ranges
or the partitioning.

A weight is a row's size and the mean size once more, so a range holds at most
its share of bytes and of rows, both times two.

Driver: the sample (``DRAWS`` keys a range), the ranges (at most ``MAX_RANGES``
and their parts) and the shards, never the rows.

Defined cases: a null text has size 1 like an empty one; null ids are part of
the row's hash like any value; rows equal in all columns are interchangeable; an
empty table gives an empty result; a column of the input that is named like one
of the result (``law``, ``shard``, ``slot``, ``grown_shard``) gives way to it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyledger.llm.common import documents, text_or_empty
from keyledger.session import stage

SHARDS = 16
RANGE_BYTES = 64 << 20  # weight of a range, about
MAX_RANGES = 1 << 16    # beyond it, ranges grow instead
DRAWS = 64              # keys drawn for a range
MAX_DRAWS = 1 << 20     # keys drawn in all
RESULT = ["law", "shard", "slot", "grown_shard"]


@dataclass(frozen=True)
class Splitters:
    """Ascending keys at which ranges begin; range 0 lies before the first."""
    hash: np.ndarray
    tie: np.ndarray

    def range_of(self, hash_: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """How many splitters are at or before each key."""
        low, high = (np.searchsorted(self.hash, hash_, side) for side in ("left", "right"))
        for at in np.unique(low[low < high]):  # splitters with this hash: the tie decides
            rows = np.flatnonzero((low == at) & (low < high))
            low[rows] += np.searchsorted(self.tie[at:high[rows[0]]], tie[rows], "right")
        return low

    def with_keys(self, keys: set[tuple[int, int]]) -> Splitters:
        pairs = sorted(keys | set(zip(self.hash.tolist(), self.tie.tolist(), strict=True)))
        return Splitters(*(np.array([p[i] for p in pairs], dtype=np.int64) for i in (0, 1)))

    def column(self):
        @F.pandas_udf("int")
        def range_of(hash_: pd.Series, tie: pd.Series) -> pd.Series:
            return pd.Series(self.range_of(hash_.to_numpy(), tie.to_numpy()))

        # Said to be nondeterministic so that filters on its result stay above it
        # and it is worked out once a row.
        return range_of.asNondeterministic()("__hash", "__tie")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__hash``, ``__tie`` (the key) and ``__size``."""
    whole = [F.to_json(c) if "map<" in kind else F.col(c) for c, kind in docs.dtypes]
    return docs.select("*", F.xxhash64(text_or_empty()).alias("__hash"), F.xxhash64(*whole).alias("__tie"),
                       (F.octet_length(text_or_empty()).cast("bigint") + 1).alias("__size"))


def after(key: tuple[int, int]) -> tuple[int, int]:
    """The least key above ``key``."""
    top = (1 << 63) - 1
    return (key[0], key[1] + 1) if key[1] < top else (min(key[0] + 1, top), -top - 1)


def draw(keys: DataFrame, share: float, target: float, seed: int) -> list:
    """Keys drawn with a chance of ``weight / share`` each, ascending, with the
    weight each stands for; keys of weight ``target`` and more are always drawn."""
    chance = F.shiftrightunsigned(F.xxhash64("__hash", "__tie", F.lit(seed)), 11) / F.lit(float(1 << 53))
    drawn = keys.where((F.col("weight") >= target) | (chance < F.col("weight") / share))
    return (drawn.select("__hash", "__tie", F.greatest("weight", F.lit(share)).alias("stands"),
                         (F.col("weight") >= target).alias("heavy")).orderBy("__hash", "__tie").collect())


def quantiles(drawn: list, parts: int) -> set[tuple[int, int]]:
    """Keys at the ``parts`` quantiles of a sample; a heavy key gets a range of its own."""
    if not drawn:
        return set()
    total = np.cumsum([r["stands"] for r in drawn])
    at = np.searchsorted(total, total[-1] * np.arange(1, parts) / parts)
    out = {(drawn[i]["__hash"], drawn[i]["__tie"]) for i in at}
    heavy = {(r["__hash"], r["__tie"]) for r in drawn if r["heavy"]}
    return out | heavy | {after(k) for k in heavy}


def split(keys: DataFrame, weight: float, ranges: int) -> tuple[Splitters, list]:
    """Splitters under which no range of more than one key weighs over twice its
    share, and the exact ``bytes``, ``rows``, ``keys``, ``weight`` of every range."""
    target = weight / ranges
    drawn = draw(keys, weight / min(MAX_DRAWS, ranges * DRAWS), target, 0)
    splitters = Splitters(*[np.empty(0, dtype=np.int64)] * 2).with_keys(quantiles(drawn, ranges))
    for turn in range(1, 64):
        placed = keys.select("*", splitters.column().alias("range"))
        found = placed.groupBy("range").agg(
            F.sum(F.col("__size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"),
            F.count(F.lit(1)).alias("keys"), F.sum("weight").alias("weight")).orderBy("range").collect()
        over = [r for r in found if r["keys"] > 1 and r["weight"] > 2 * target]
        if not over:
            return splitters, found
        more = draw(placed.where(F.col("range").isin([r["range"] for r in over])), target / DRAWS, target, turn)
        lie = splitters.range_of(*(np.array([d[i] for d in more], dtype=np.int64) for i in (0, 1)))
        for r in over:
            mine = more[np.searchsorted(lie, r["range"]):np.searchsorted(lie, r["range"], "right")]
            splitters = splitters.with_keys(quantiles(mine, int(-(-r["weight"] // target)) + 1))
    raise RuntimeError("ranges that cannot be subdivided")


def shard_documents(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None) -> DataFrame:
    """Every row of ``docs`` with ``law`` ('bytes'), ``shard``, ``slot`` (its
    place in the shard, from 0) and ``grown_shard`` (null: shards under this law
    move when their number does).  The rows come range by range, in order, ready
    to be written (``write_shards``).  ``ranges``: as many as weights ask for."""
    spark = docs.sparkSession
    docs = docs.select(*[c for c in docs.columns if c not in RESULT])
    rows = keyed(docs)
    keys = stage(rows.groupBy("__hash", "__tie", "__size").agg(F.count(F.lit(1)).alias("copies")), "shard-keys")
    total, n = keys.agg(F.sum(F.col("__size") * F.col("copies")), F.sum("copies")).first()
    if not n:
        return docs.where(F.lit(False)).select(
            "*", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"))
    ranges = ranges or min(MAX_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * total // RANGE_BYTES)))
    weight = F.col("copies") * (F.col("__size") + F.lit(total / n))
    splitters, found = split(keys.withColumn("weight", weight), 2.0 * total, ranges)

    # Ranges in order, a heavy key's copies dealt to several parts of equal count.
    parts, offsets, at = [], [], [0, 0]
    for r in found:
        k = max(1, min(r["rows"], round(r["weight"] * ranges / (2.0 * total)))) if r["keys"] == 1 else 1
        size, edges = r["bytes"] // r["rows"], [r["rows"] * i // k for i in range(k + 1)]
        parts += [(len(parts) + i, r["range"], k > 1, b - a, at[0] + a * size, at[1] + a)
                  for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        offsets.append((r["range"], at[0]))
        at = [at[0] + r["bytes"], at[1] + r["rows"]]
    table = F.broadcast(spark.createDataFrame(
        parts, "part int, range int, dealt boolean, part_rows bigint, bytes_before bigint, rows_before bigint"))
    first = F.broadcast(spark.createDataFrame(
        first_ranks(keys.select("*", splitters.column().alias("range")), offsets, total, shards), "shard int, first_rank bigint"))

    ranged = rows.select("*", splitters.column().alias("range"))
    moved = ranged.join(table.where(~F.col("dealt")), "range").withColumn("part_rows", F.lit(1).cast("bigint"))
    if any(p[2] for p in parts):
        # Rows that agree in every column: one of them, with their number, is dealt.
        held = table.where("dealt").select("range").distinct()
        one = ranged.join(F.broadcast(held), "range", "left_semi").groupBy("range").agg(
            *[F.any_value(c).alias(c) for c in rows.columns])
        moved = moved.unionByName(one.join(table, "range").select(*moved.columns))
    moved = moved.repartitionById(len(parts), F.col("part"))
    if any(p[2] for p in parts):
        moved = moved.select("*", F.explode(F.expr("sequence(1L, part_rows)")).alias("__copy"))
    order = Window.partitionBy("part").orderBy("__hash", "__tie")
    before = F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
    start = F.col("bytes_before") + before
    placed = moved.select(*docs.columns, shard_at(start, F.col("__size"), total, shards).cast("int").alias("shard"),
                          (F.col("rows_before") + F.row_number().over(order) - 1).alias("__rank"))
    return placed.join(first, "shard").select(
        *docs.columns, F.lit("bytes").alias("law"), "shard", (F.col("__rank") - F.col("first_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def shard_at(start, size, total: int, shards: int):
    """The shard in which the middle of ``size`` bytes from ``start`` lies."""
    middle, small = 2 * start + size, 2 * total * shards < 1 << 62
    scaled = middle * F.lit(shards) if small else middle.cast("decimal(38,0)") * F.lit(shards)
    return F.call_function("div", scaled, F.lit(2 * total)).cast("int")


def first_ranks(keys: DataFrame, offsets: list[tuple[int, int]], total: int, shards: int) -> list[tuple[int, int]]:
    """(shard, rows that lie before its first).  Read from the keys and their
    counts; the copies of one key may lie in several shards."""
    order = Window.partitionBy("range").orderBy("__hash", "__tie")
    size, copies, held = F.col("__size"), F.col("copies"), F.col("__size") * F.col("copies")
    table = F.broadcast(keys.sparkSession.createDataFrame(offsets, "range int, bytes_before bigint"))
    placed = keys.join(table, "range").withColumn(
        "start", F.col("bytes_before") + F.sum(held).over(order.rowsBetween(Window.unboundedPreceding, 0)) - held)
    start = F.col("start")
    placed = placed.select("*", shard_at(start, size, total, shards).alias("a"),
                           shard_at(start + size * (copies - 1), size, total, shards).alias("b"))
    whole = lambda c: c.cast("decimal(38,0)")

    def before(shard):
        """Copies of the key whose middle, start + (2 j + 1) size / 2, lies before the shard's bytes."""
        room, step = whole(F.lit(2 * total)) * shard - whole(2 * start) * F.lit(shards), whole(size) * F.lit(shards)
        return F.when(room <= step, F.lit(0).cast("bigint")).otherwise(
            F.least(copies, F.call_function("div", room - 1 - step, 2 * step) + 1))

    s = F.col("s")
    n = F.when(F.col("a") == F.col("b"), copies).otherwise(before(s + 1) - before(s))
    counted = placed.select("*", F.explode(F.sequence("a", "b")).alias("s")).groupBy("s").agg(F.sum(n).alias("n")).collect()
    held_by = {r["s"]: r["n"] for r in counted}
    return list(enumerate(np.cumsum([0, *[held_by.get(i, 0) for i in range(shards - 1)]]).tolist()))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> str:
    """The sharded records as Parquet, a folder ``shard=<n>`` each; a shard's
    files are ordered by slot within."""
    shard_documents(docs, shards).write.mode("errorifexists").partitionBy("shard").parquet(path)
    return path


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    placed = shard_documents(documents(spark, sf_dir))
    return placed.select("doc_id", (F.octet_length(text_or_empty()).cast("bigint") + 1).alias("size"),
                         F.crc32(text_or_empty()).alias("text_crc32"), *RESULT)
