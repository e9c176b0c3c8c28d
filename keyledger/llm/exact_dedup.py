"""Exact dedup by a heavy-hitter split.

Rows are reduced to (id, digest).  A Misra-Gries summary of ``1/support``
counters (``DataFrame.freqItems``) holds every digest on more than ``support``
of the rows; an exact count verifies its candidates, and the verified winners,
at most ``1/support`` rows of fixed width, are broadcast.  A row of a winner
that is not the one that stays is settled where it lies, without a shuffle.
All other rows, now in groups of at most ``support * rows``, are grouped by an
ordinary shuffle.  Everything is DataFrame functions.

Defined cases: null text counts as empty, so null and empty texts are copies
of each other; of equal texts the row with the largest id stays, a null id
being smaller than any other; of rows that repeat id and text one stays.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyledger.llm.common import documents, keep_rows, text_key, text_or_empty
from keyledger.session import stage

SUPPORT = 0.001  # share of all rows above which a digest is a heavy hitter


def decide(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, text_key."""
    rows = stage(docs.select("doc_id", F.sha2(text_or_empty().cast("binary"), 256).alias("text_sha256"),
                             text_key().alias("text_key")), "exact-digests")
    n_rows = rows.count()
    candidates = (rows.select("text_sha256").freqItems(["text_sha256"], support)
                  .select(F.explode("text_sha256_freqItems").alias("text_sha256")))
    winners = stage(
        rows.join(F.broadcast(candidates), "text_sha256")
        .groupBy("text_sha256").agg(F.count(F.lit(1)).alias("w_size"), F.max("doc_id").alias("w_keep"))
        .where(F.col("w_size") > support * n_rows), "exact-winners")
    marked = rows.join(F.broadcast(winners), "text_sha256", "left")
    settled = F.col("w_keep").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("w_keep")))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "text_key"]
    removed = marked.where(settled).select(
        "doc_id", F.col("w_keep").alias("keep_id"), F.col("w_size").alias("group_size"),
        F.lit(False).alias("kept"), "text_sha256", "text_key")
    group = Window.partitionBy("text_sha256")
    rest = (marked.where(~settled)
            .withColumn("keep_id", F.max("doc_id").over(group))
            .withColumn("group_size", F.coalesce("w_size", F.count(F.lit(1)).over(group)))
            .withColumn("kept", F.row_number().over(group.orderBy(F.col("doc_id").desc_nulls_last())) == 1)
            .select(*columns))
    return removed.unionByName(rest)


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return decide(documents(spark, sf_dir)).drop("text_key")


def stage_exact_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts one document stays."""
    return keep_rows(docs, decide(docs).where("kept"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
"""
