from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyledger.llm import sharding as S
from tests.llm import fixtures as fx


@pytest.fixture(scope="module")
def docs(spark):
    return fx.documents(spark).cache()


def placed(df, **k):
    rows = S.shard_documents(df, **k).select("doc_id", "text", "law", "shard", "slot", "grown_shard").collect()
    assert {(r.law, r.grown_shard) for r in rows} <= {("bytes", None)}
    return rows


def check(rows, docs, shards=16):
    """Every row once, slots without gaps, sizes within twice the largest row."""
    key = lambda r: (r["doc_id"], r["text"])
    assert Counter(map(key, rows)) == Counter(map(key, docs.collect()))
    size = lambda r: len((r.text or "").encode()) + 1
    slots, held = defaultdict(list), Counter({s: 0 for s in range(shards)})
    for r in rows:
        slots[r.shard].append(r.slot)
        held[r.shard] += size(r)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(held) == set(range(shards))
    assert max(held.values()) - min(held.values()) < 2 * max(map(size, rows))


def test_shards_of_odd_rows_do_not_depend_on_ranges_or_partitions(spark, docs):
    one = placed(docs)
    check(one, docs)
    order = lambda rows: sorted(((r.doc_id or -1, r.text or "", r.shard, r.slot) for r in rows))
    assert order(placed(docs.repartition(9), ranges=40)) == order(one)
    assert order(placed(docs.coalesce(1), ranges=1)) == order(one)


def test_extra_columns_and_clashing_names(spark, docs):
    extra = docs.select("*", F.lit("x").alias("shard"), F.lit("y").alias("law"), F.create_map(F.lit("a"), F.col("n_chars")).alias("m"))
    got = S.shard_documents(extra)
    assert got.columns == [*docs.columns, "m", "law", "shard", "slot", "grown_shard"]
    check(got.collect(), docs)


@pytest.mark.parametrize("ranges", [3, 50])
def test_a_row_repeated_very_often_is_dealt_to_several_parts(spark, ranges):
    same = spark.range(6000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("the same text").alias("text"))
    copies = spark.range(6000).select((F.col("id") + 100).alias("doc_id"), F.lit("copies of one text").alias("text"))
    rest = spark.range(6000).select((F.col("id") + 20_000).alias("doc_id"), F.repeat(F.lit("ab "), (F.col("id") % 40).cast("int")).alias("text"))
    docs = same.unionByName(copies).unionByName(rest)
    check(placed(docs, ranges=ranges), docs)
    check(placed(docs, shards=5, ranges=ranges), docs, 5)


def test_ranges_are_even_in_bytes_and_rows(spark):
    docs = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "one short text").otherwise(
        F.repeat(F.lit("x"), (F.col("id") % 500).cast("int"))).alias("text")).withColumnRenamed("id", "doc_id")
    keys = S.keyed(docs).groupBy("__hash", "__tie", "__size").agg(F.count(F.lit(1)).alias("copies"))
    total, n = keys.agg(F.sum(F.col("__size") * F.col("copies")), F.sum("copies")).first()
    weighed = keys.withColumn("weight", F.col("copies") * (F.col("__size") + F.lit(total / n)))
    splitters, found = S.split(weighed, 2.0 * total, 20)
    assert sum(r["rows"] for r in found) == 5000 and sum(r["bytes"] for r in found) == total
    assert all(r["weight"] <= 2 * (2.0 * total / 20) for r in found) and len(splitters.hash) >= 19


def test_splitters_against_a_plain_search():
    rng = np.random.default_rng(1)
    keys = {(int(a), int(b)) for a, b in rng.integers(-5, 5, (40, 2))}
    s = S.Splitters(*[np.empty(0, dtype=np.int64)] * 2).with_keys(keys)
    rows = rng.integers(-6, 6, (500, 2))
    want = [sum(k <= (int(a), int(b)) for k in keys) for a, b in rows]
    assert s.range_of(rows[:, 0], rows[:, 1]).tolist() == want
    top = (1 << 63) - 1
    assert S.after((3, top)) == (4, -top - 1) and S.after((3, 4)) == (3, 5)


def test_written_shards_read_back_in_order(spark, docs, tmp_path):
    S.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r.doc_id, r.text) for r in docs.collect())
    assert {r.shard for r in back} == set(range(4))


def test_empty_and_single_rows(spark, docs):
    assert S.shard_documents(docs.limit(0)).collect() == []
    one = placed(spark.createDataFrame([(None, None)], "doc_id bigint, text string"))
    assert [(r.slot, 0 <= r.shard < 16) for r in one] == [(0, True)]


def test_the_query(spark):
    from binascii import crc32
    got = {r.doc_id: r for r in S.op11_sharding(spark, fx.SF).collect()}
    for r in spark.read.parquet(f"{fx.SF}/documents.parquet").collect():
        t = (r.text or "").encode()
        assert (got[r.doc_id]["size"], got[r.doc_id].text_crc32) == (len(t) + 1, crc32(t))
