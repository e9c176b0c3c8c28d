"""Mixing sources to target weights by Poisson replication.

Every source of the recipe has a target share of the mixture's characters; the
sources that the recipe does not name share ``other`` as one pool.  A source's
repetition rate is target characters / characters it has, and each document is
repeated a Poisson number of times with that mean: a number in [0, 1) seeded by
the document's hash is inverted through the distribution's cumulative table.  A
mean over ``PIECE`` is a sum of independent draws of equal mean at most
``PIECE``, so tables stay short however large the rate.  The copies are spread
by a hash and written in its order, a shuffle over the whole mixture.

The rates are a table of one row for each name in the recipe and one for the
rest, so its size is bounded by the recipe and it is broadcast; the character
counts behind it cover every document.  No row is moved by its source, so a
source that holds most rows does not weigh on one task.

Defined cases: a null source belongs to ``other``; a null or empty text has no
characters, takes part with its source's rate and copies like any other; a
source without characters has rate zero, a source whose target is zero too.  The
targets of sources that are absent or have no characters are shared out over the
others, in proportion to theirs, so the mixture keeps its size and the others
their ratios.  Rows that share an id draw alike, whatever their text; rows
without an id share one draw.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.llm.common import documents, text_or_empty

SEED = "mix-1"
PIECE = 16.0
#: Target shares of the mixture's characters; they sum to 1 with OTHER.
RECIPE = {"src0": 0.20, **{f"src{i}": 0.05 for i in range(1, 10)}}
OTHER = 0.35
DIGITS = 13  # hex digits of a digest used as a number: 52 bits, exact in a double
RATE, COPIES, COPY, ORDER = "__llm_rate", "__llm_copies", "__llm_copy", "__llm_order"  # no column of a table is so named


def cumulative(mean: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... of a Poisson(mean), until it rounds to 1."""
    out, p, total, k = [], math.exp(-mean), 0.0, 0
    while True:
        total += p
        if total >= 1.0 - 2.0 ** -52 or (k > mean and p < 2.0 ** -60):
            return out
        out.append(total)
        k += 1
        p *= mean / k


def uniform(*parts):
    """A number in [0, 1) from the hash of the parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint") / F.lit(float(16 ** DIGITS))


def pool_of(recipe: dict[str, float]):
    """The recipe's name of a row, or '' for the rest."""
    return F.when(F.col("source").isin(*recipe), F.col("source")).otherwise(F.lit("")) if recipe else F.lit("")


def rates(docs: DataFrame, recipe: dict[str, float], other: float, total_epochs: float = 1.0) -> list[tuple[str, float]]:
    """(pool, mean repetition rate): at most one row for each name and one."""
    if "" in recipe:
        raise ValueError("the empty name is kept for sources outside the recipe")
    sizes = {r["pool"]: int(r["size"] or 0) for r in
             docs.select(pool_of(recipe).alias("pool"), F.length(text_or_empty()).cast("bigint").alias("n"))
             .groupBy("pool").agg(F.sum("n").alias("size")).collect()}
    whole = sum(sizes.values())
    target = {**recipe, "": other}
    all_of, held = (sum((Decimal(repr(target[p])) for p in pools), Decimal(0)) for pools in (target, [p for p, n in sizes.items() if n]))
    share = {p: target[p] if held in (0, all_of) else target[p] / float(held / all_of) for p in target}
    return [(p, share[p] * whole * total_epochs / n if n else 0.0) for p, n in sorted(sizes.items())]


def replicate(docs: DataFrame, recipe: dict[str, float] = RECIPE, other: float = OTHER, seed: str = SEED,
              total_epochs: float = 1.0) -> DataFrame:
    """``docs`` with four columns more, RATE, COPIES, COPY and ORDER: one row for
    each copy, not yet shuffled."""
    spark = docs.sparkSession
    rows = [(p, rate, pieces, cumulative(rate / pieces)) for p, rate in rates(docs, recipe, other, total_epochs)
            for pieces in [max(1, math.ceil(rate / PIECE))]]
    table = spark.createDataFrame(rows, f"__llm_pool string, {RATE} double, __llm_pieces int, __llm_cdf array<double>")
    drawn = docs.withColumn("__llm_pool", pool_of(recipe)).join(F.broadcast(table), "__llm_pool")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    draw = lambda piece: F.size(F.filter("__llm_cdf", lambda c: c <= uniform(F.lit(seed), doc, piece)))
    one = F.size(F.filter("__llm_cdf", lambda c: c <= F.col("__llm_u")))
    many = F.aggregate(F.sequence(F.lit(0), F.col("__llm_pieces") - 1), F.lit(0),
                       lambda total, piece: total + draw(piece.cast("string")))
    counted = (drawn.withColumn("__llm_u", uniform(F.lit(seed), doc, F.lit("0")))
               .withColumn(COPIES, F.when(F.col("__llm_pieces") == 1, one).otherwise(many).cast("bigint"))
               .where(F.col(COPIES) > 0))
    copies = counted.withColumn(COPY, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(COPIES) - 1)))
    order = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), doc, F.col(COPY).cast("string"))), 1, 16)
    return copies.withColumn(ORDER, order).drop("__llm_pool", "__llm_pieces", "__llm_cdf", "__llm_u")


def shuffled(copies: DataFrame) -> DataFrame:
    """The copies in the order of their hash, over all partitions."""
    return copies.orderBy(ORDER, "doc_id", COPY)


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return shuffled(replicate(docs)).select(
        "doc_id", "source", F.col(RATE).alias("mix_rate"), F.col(COPIES).alias("n_copies"), F.col(COPY).alias("copy_no"),
        F.col(ORDER).alias("mix_order"), "text")


def stage_mixing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mixture, in its shuffled order."""
    return shuffled(replicate(docs)).select(*docs.columns)


def _oracle() -> str:
    """DuckDB: the same draw.  A Poisson table is a recursive query over the
    pools, so the SQL holds no number that Spark computed."""
    names = ", ".join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in {**RECIPE, "": OTHER}.items())
    known = ", ".join(f"'{k}'" for k in RECIPE)
    number = f"CAST(('0x' || md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), 'null'), CAST(piece AS VARCHAR)))[1:{DIGITS}]) AS BIGINT) / {16 ** DIGITS}.0::DOUBLE"
    return f"""
WITH RECURSIVE target(pool, share) AS (VALUES {names}),
d AS (SELECT doc_id, source, text, CASE WHEN source IN ({known}) THEN source ELSE '' END AS pool FROM documents),
size AS (SELECT pool, sum(length(coalesce(text, '')))::BIGINT AS n FROM d GROUP BY pool),
held AS (SELECT sum(share::DECIMAL(18,12)) AS there, (SELECT sum(share::DECIMAL(18,12)) FROM target) AS whole
         FROM size JOIN target USING (pool) WHERE n > 0),
rate AS (SELECT pool, CASE WHEN n = 0 THEN 0.0 ELSE
           CASE WHEN there = 0 OR there = whole THEN share ELSE share / (there::DOUBLE / whole::DOUBLE) END
           * (SELECT sum(n) FROM size)::DOUBLE / n END AS mix_rate
         FROM size JOIN target USING (pool), held),
pieces AS (SELECT pool, mix_rate, greatest(1, ceil(mix_rate / {PIECE}))::BIGINT AS m FROM rate),
pois(pool, k, p, total) AS (
  SELECT pool, 0, exp(-(mix_rate / m)), exp(-(mix_rate / m)) FROM pieces
  UNION ALL
  SELECT q.pool, k + 1, p * (mix_rate / m / (k + 1)), total + p * (mix_rate / m / (k + 1))
  FROM pois q JOIN pieces USING (pool) WHERE k < 200),
cdf AS (SELECT pool, list(total ORDER BY k) AS cdf FROM pois GROUP BY pool),
draws AS (SELECT doc_id, text, source, pool, mix_rate, unnest(range(m)) AS piece FROM d JOIN pieces USING (pool)),
u AS (SELECT *, {number} AS u FROM draws),
n AS (SELECT doc_id, any_value(source) AS source, any_value(text) AS text, any_value(mix_rate) AS mix_rate,
             sum(len(list_filter(cdf, lambda c: c <= u)))::BIGINT AS n_copies
      FROM u JOIN cdf USING (pool) GROUP BY doc_id)
SELECT doc_id, source, mix_rate, n_copies, copy_no,
       md5(concat_ws('|', '{SEED}', 'order', coalesce(CAST(doc_id AS VARCHAR), 'null'), CAST(copy_no AS VARCHAR)))[1:16] AS mix_order,
       text
FROM (SELECT *, unnest(range(n_copies)) AS copy_no FROM n)
"""


ORACLE = _oracle()
