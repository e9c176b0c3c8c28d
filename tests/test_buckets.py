"""Bucketed tables: an upsert rewrites the buckets it touches and no others, a run
that fails leaves the rows, one that is stopped while replacing is finished."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from keyledger import schemas
from keyledger.session import scratch_path
from keyledger.sinks import buckets as B
from keyledger.sinks import writers as W

KV = schemas.UNIQUENESS_INDEX


def files(path):
    root = path.replace("file://", "")
    return {b: {(f, os.stat(f"{root}/{b}/{f}").st_mtime_ns) for f in os.listdir(f"{root}/{b}") if f.endswith(".parquet")}
            for b in os.listdir(root) if b.startswith("bucket=")}


def as_dict(spark, path):
    rows = W.read_latest(spark, path).collect()
    assert len({r.key for r in rows}) == len(rows)
    return {r.key: r.value for r in rows}


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "buckets")
    B.create(spark, path, KV, ["key"], 64)
    W.upsert_table(spark, path, spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), F.lit("old").alias("value")), ["key"])
    return path


def test_one_percent_of_the_keys_rewrites_their_buckets(spark, table):
    before = files(table)
    assert len(before) == 64
    inc = spark.createDataFrame([(f"k{100 * i}", "new") for i in range(20)], KV)
    lay = B.layout(spark, table)
    touched = {f"bucket={r[0]}" for r in inc.select(B.bucket_of(lay)).distinct().collect()}
    W.upsert_table(spark, table, inc, ["key"])
    after = files(table)
    assert 0 < len(touched) <= 20
    assert {b for b in after if after[b] != before[b]} == touched
    got = as_dict(spark, table)
    assert len(got) == 2000 and {k for k, v in got.items() if v == "new"} == {f"k{100 * i}" for i in range(20)}


def test_only_touched_buckets_are_read(spark, table):
    plan = B.read(spark, table, [3, 5])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[bucket#\d+ IN \(3,5\)", plan)


def test_upserts_match_a_dict_model(spark):
    rnd = random.Random(11)
    for insert_only in (False, True):
        path, model = scratch_path(spark, "buckets"), {}
        B.create(spark, path, KV, ["key"], 5)
        for _ in range(4):
            inc = [(f"k{rnd.randrange(30)}", rnd.choice([None, "a", "b", "c"])) for _ in range(25)]
            best = {}
            for k, v in inc:
                best[k] = max(filter(None, (v, best.get(k))), default=None)
            for k, v in best.items():
                if not (insert_only and k in model):
                    model[k] = v
            W.upsert_table(spark, path, spark.createDataFrame(inc, KV), ["key"], insert_only=insert_only)
        assert as_dict(spark, path) == model


def test_a_failed_run_leaves_the_rows(spark, table):
    before = files(table)
    bad = spark.range(50).select(F.concat(F.lit("k"), "id").alias("key"),
                                 F.when(F.col("id") == 49, F.raise_error(F.lit("broken"))).otherwise("new").cast("string").alias("value"))
    with pytest.raises(Exception, match="broken"):
        W.upsert_table(spark, table, bad, ["key"])
    assert files(table) == before
    def fails(rows):
        return rows.groupBy("bucket", "key").agg(F.max(F.when(F.col("_new"), F.raise_error(F.lit("late"))).cast("string")).alias("value"))
    with pytest.raises(Exception, match="late"):
        B.put(spark, table, spark.createDataFrame([("k1", "x")], KV), fails)
    assert files(table) == before
    assert B.recover(spark, table) == 0 and set(as_dict(spark, table).values()) == {"old"}


def test_a_run_stopped_while_replacing_is_finished_by_the_next(spark, table, monkeypatch):
    inc = spark.createDataFrame([(f"k{i}", "new") for i in range(10)], KV)
    with monkeypatch.context() as m:
        m.setattr(B, "_replace", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            W.upsert_table(spark, table, inc, ["key"])
    assert set(as_dict(spark, table).values()) == {"old"}
    root = table.replace("file://", "")  # a bucket that was already taken away when the run stopped
    lay = B.layout(spark, table)
    gone = inc.select(B.bucket_of(lay)).first()[0]
    for f in os.listdir(f"{root}/bucket={gone}"):
        os.remove(f"{root}/bucket={gone}/{f}")
    W.upsert_table(spark, table, spark.createDataFrame([("other", "z")], KV), ["key"])
    got = as_dict(spark, table)
    assert len(got) == 2001 and {k for k, v in got.items() if v == "new"} == {f"k{i}" for i in range(10)}


def test_layout_is_kept_and_keys_are_checked(spark, table):
    assert B.create(spark, table, KV, ["key"], 7).buckets == 64
    with pytest.raises(ValueError):
        W.upsert_table(spark, table, spark.createDataFrame([("a", "b")], KV), ["value"])
    empty = scratch_path(spark, "buckets")
    B.create(spark, empty, KV, ["key"], 3)
    assert W.read_latest(spark, empty).count() == 0
    W.upsert_table(spark, empty, spark.createDataFrame([], KV), ["key"])
    assert W.read_latest(spark, empty).columns == ["key", "value"]


def test_a_hot_key_is_combined_before_it_moves(spark, table):
    inc = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), "id")).alias("key"),
                                     F.col("id").cast("string").alias("value"))
    W.upsert_table(spark, table, inc, ["key"])
    assert as_dict(spark, table)["hot"] == max(str(i) for i in range(30_000) if i % 3)
