"""Distinct counts that add up across extractions.

The exact count of distinct ids over several extractions has to see all ids
again.  A HyperLogLog sketch of each extraction is stored instead, a few
kilobytes whatever its size, and sketches of any days merge into the sketch of
their union.  The exact counts (``ids.extraction_counts``) stay the reference:
the estimate's relative standard error is about 1.04 / sqrt(2^LOG_K), 0.8 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LOG_K = 14
MAX_ERROR = 0.04  # five standard errors


def extraction_sketches(extractions: DataFrame, by: list[str], id_col: str = "id", log_k: int = LOG_K) -> DataFrame:
    """Per group (a day, a run): ``n_rows`` and ``sketch``; partial on the map side."""
    return extractions.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(id_col, F.lit(log_k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The sketch of a union: ``n_rows`` and ``sketch`` per group, or of all."""
    return sketches.groupBy(*(by or [])).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: Column | str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def running(sketches: DataFrame, order: str) -> DataFrame:
    """Per stored extraction, in order, the sketch of it and all before it.  One
    row per extraction: the window holds sketches, not ids."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return sketches.select(order, F.sum("n_rows").over(w).alias("n_rows"), F.hll_union_agg("sketch").over(w).alias("sketch"))
