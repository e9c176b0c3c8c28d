"""Position of each row within its group, without one task per group.

``row_number().over(partitionBy(k).orderBy(o))`` sends every row of a key to
one task; a key holding a third of the data then runs on one core.  Here the
rows are range-partitioned on ``(k, o)`` instead, so a hot key is spread over
many partitions.  Each partition counts its rows per key (at most partitions +
keys rows in all), a running sum over partitions gives every (partition, key)
its offset, and the position is offset + place inside the partition.

The input is staged first, so the sampling of the range bounds and the shuffle
read narrow columns instead of computing the input twice, and the number of
ranges follows from its rows.  The numbered rows are staged too, so that the
statistics and the rows agree: computed twice, they could differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyledger.session import stage

ROWS_PER_RANGE = 500_000  # rows of a range partition, about


def rank_within(df: DataFrame, keys: list[str], order: list[Column | str], *, seq_col: str = "seq",
                rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``seq_col`` = 1-based position of each row among the rows with equal
    ``keys``, in ``order`` (ascending).  ``order`` should be total within a key
    for a deterministic result.  Pass only the columns needed: all of them are
    staged and shuffled.

    Offsets are joined on ``(partition, key)``, which is balanced because no
    such pair holds more than one partition of rows; AQE broadcasts them where
    they are small."""
    rows = stage(df, "rank-rows")
    n = max(1, -(-rows.count() // rows_per_range))
    sort_cols = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    s = stage(rows.repartitionByRange(n, *sort_cols)
              .sortWithinPartitions(*sort_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mono", F.monotonically_increasing_id()), "rank-numbered")
    stats = s.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select(
        F.col("_pid").alias("_opid"), *[F.col(k).alias(f"_o_{k}") for k in keys], "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    cond = [s["_pid"] == offs["_opid"]] + [s[k].eqNullSafe(offs[f"_o_{k}"]) for k in keys]
    out = s.join(offs, cond, "inner")
    out = out.withColumn(seq_col, (F.col("_mono") - F.col("_first") + F.col("_before") + 1).cast("bigint"))
    return out.drop("_pid", "_mono", "_opid", "_first", "_before", *[f"_o_{k}" for k in keys])
