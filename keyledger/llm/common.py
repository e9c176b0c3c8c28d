"""What several operators share: the text column, row keys, keeping rows, and
connected components."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyledger.session import stage

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str = "text"):
    """Null text counts as empty in every operator."""
    return F.coalesce(F.col(col), F.lit(""))


def text_key(col: str = "text"):
    """A 64-bit key of the text, computed in the JVM: with the id it names a
    row when an id occurs on several rows."""
    return F.xxhash64(text_or_empty(col))


def seeded_uint(seed: int, name: str) -> int:
    """A fixed 64-bit number for a seed and a name (the same on every worker)."""
    return int.from_bytes(hashlib.sha256(f"{seed}:{name}".encode()).digest()[:8], "little")


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose (id, text) is in ``kept`` (columns ``id_col``
    and ``text_key``, unique), each once: a row that repeats id and text is
    dropped.  Texts move once: the join and the numbering of repeated rows share
    one key (a null id is folded into the key of its text), and nothing is
    broadcast by hand.
    """
    names = ["__llm_id", "__llm_key"]
    known = lambda key: [F.coalesce(F.col(id_col), F.lit(0)).alias(names[0]),
                         F.when(F.col(id_col).isNull(), F.bitwise_not(key)).otherwise(key).alias(names[1])]
    joined = docs.select("*", *known(text_key())).join(kept.select(*known(F.col("text_key"))), names, "left_semi")
    w = Window.partitionBy(*names).orderBy(names[0])
    return (joined.withColumn("__llm_copy", F.row_number().over(w)).where(F.col("__llm_copy") == 1)
            .select(*docs.columns))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (columns ``a``, ``b``,
    bigint): component is the smallest node reachable.

    Alternating large-star and small-star rounds: each points a node's
    neighbours at the smallest one, so a path of n links needs O(log n) rounds.
    A round reduces with ``min`` (combined map-side) and one join; a hub's
    neighbours are never gathered in one row.  Each round is written as a table
    in the shared folder, which cuts the lineage.  Links and components stay on
    the executors; the driver sees a count and a checksum per round.
    """
    e = stage(edges.where(F.col("a") != F.col("b"))
              .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    seen = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen or mark[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = mark
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(least, "u")
        small = (star.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = stage(small, name)
