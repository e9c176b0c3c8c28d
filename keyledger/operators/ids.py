"""User-id extraction: distinct ids, counts, and the comparison of two
extractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.functions.constants import FIELD_ORDER


def bare_fields(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids -> ``UniqueFields`` rows with no field known yet."""
    return ids.select(F.col(id_col).alias("id"),
                      *[F.lit(None).cast("string").alias(f) for f in FIELD_ORDER])


def distinct_ids(events: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct user ids of an event table.  Only the id column is read
    (column pruning reaches the scan); partial aggregation removes duplicates
    on the map side before the shuffle."""
    return events.select(F.col(id_col).alias("id")).distinct()


def id_counts(events: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows per user id, combined map-side before the shuffle."""
    return events.groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))


def extraction_counts(events: DataFrame, id_col: str = "id", sum_col: str | None = None,
                      approx: bool = False) -> DataFrame:
    """E3, E4, E5, E11 in one pass: row count, distinct id count (exact by
    default; ``approx`` uses a HyperLogLog++ sketch, relative error ~1%), an
    optional sum, and rows minus distinct ids."""
    distinct = F.approx_count_distinct(F.col(id_col)) if approx else F.count_distinct(F.col(id_col))
    aggs = [F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_ids")]
    if sum_col is not None:
        aggs.append(F.sum(F.col(sum_col)).cast("bigint").alias("sum_value"))
    out = events.agg(*aggs)
    return out.withColumn("n_repeated", F.col("n_rows") - F.col("n_ids"))


def extraction_diff(first: DataFrame, second: DataFrame, on: list[str] | str = "id") -> DataFrame:
    """Rows (distinct on ``on``) of the first extraction that the
    second lacks.  An anti join: an outer join plus a null test would not be
    rewritten to one."""
    cols = [on] if isinstance(on, str) else list(on)
    # Both sides are made distinct first (combined map-side); the anti join
    # then finds both already partitioned on its keys.
    return first.select(*cols).distinct().join(second.select(*cols).distinct(), cols, "left_anti")
