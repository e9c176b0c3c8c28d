import os

from keyledger import schemas
from keyledger.functions.constants import OTHER_ID_KEY
from keyledger.session import scratch_path
from keyledger.sinks import writers as W


def test_t8_write_and_read_by_key(spark):
    base = scratch_path(spark, "t8")
    idx = spark.createDataFrame([(f"{OTHER_ID_KEY}:mock:otherId:{i}", f"mock:id:{i}") for i in range(3)],
                                schemas.UNIQUENESS_INDEX)
    lk = spark.createDataFrame([(f"mock:id:{i}", OTHER_ID_KEY, f"mock:otherId:{i}") for i in range(3)],
                               schemas.UNIQUENESS_LOOKUP)
    W.upsert_table(spark, base + "/index", idx, ["key"])
    W.upsert_table(spark, base + "/lookup", lk, ["id", "key"])
    got_i = {r.key: r.value for r in W.read_latest(spark, base + "/index").collect()}
    got_l = {(r.id, r.key): r.value for r in W.read_latest(spark, base + "/lookup").collect()}
    assert got_i == {f"{OTHER_ID_KEY}:mock:otherId:{i}": f"mock:id:{i}" for i in range(3)}
    assert got_l == {(f"mock:id:{i}", OTHER_ID_KEY): f"mock:otherId:{i}" for i in range(3)}


def test_t9_upsert_replaces_by_key(spark):
    base = scratch_path(spark, "t9")
    W.upsert_table(spark, base + "/index", spark.createDataFrame(
        [(f"{OTHER_ID_KEY}:mock:otherId:0", "mock:id:0")], schemas.UNIQUENESS_INDEX), ["key"])
    W.upsert_table(spark, base + "/lookup", spark.createDataFrame(
        [("mock:id:0", OTHER_ID_KEY, "mock:otherId:0")], schemas.UNIQUENESS_LOOKUP), ["id", "key"])
    W.upsert_table(spark, base + "/index", spark.createDataFrame(
        [(f"{OTHER_ID_KEY}:mock:otherId:1", "mock:id:0"), (f"{OTHER_ID_KEY}:mock:otherId:2", "mock:id:1")],
        schemas.UNIQUENESS_INDEX), ["key"])
    W.upsert_table(spark, base + "/lookup", spark.createDataFrame(
        [("mock:id:0", OTHER_ID_KEY, "mock:otherId:1"), ("mock:id:1", OTHER_ID_KEY, "mock:otherId:2")],
        schemas.UNIQUENESS_LOOKUP), ["id", "key"])
    lk = {(r.id, r.key): r.value for r in W.read_latest(spark, base + "/lookup").collect()}
    assert lk[("mock:id:0", OTHER_ID_KEY)] == "mock:otherId:1"
    idx = {r.key: r.value for r in W.read_latest(spark, base + "/index").collect()}
    assert idx[f"{OTHER_ID_KEY}:mock:otherId:1"] == "mock:id:0"
    assert idx[f"{OTHER_ID_KEY}:mock:otherId:2"] == "mock:id:1"
    assert idx[f"{OTHER_ID_KEY}:mock:otherId:0"] == "mock:id:0"  # stale key left alone (K12)
    assert len(W.list_versions(spark, base + "/index")) == 2       # earlier version kept whole


def test_insert_only_mode(spark):
    old = spark.createDataFrame([("k", "old")], schemas.UNIQUENESS_INDEX)
    new = spark.createDataFrame([("k", "new"), ("k2", "v")], schemas.UNIQUENESS_INDEX)
    got = {r.key: r.value for r in W.upsert(old, new, ["key"], insert_only=True).collect()}
    assert got == {"k": "old", "k2": "v"}
    got = {r.key: r.value for r in W.upsert(old, new, ["key"]).collect()}
    assert got == {"k": "new", "k2": "v"}


def test_text_table_and_create(spark):
    base = scratch_path(spark, "io")
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    W.write_text(ids, base + "/ids", "id")
    W.write_text(ids.limit(1), base + "/ids", "id")  # B8: cleared before writing
    assert spark.read.text(base + "/ids").count() == 1
    W.create_table(spark, schemas.KEY_VALUE, base + "/kv")
    assert spark.read.parquet(base + "/kv").count() == 0
    kv = spark.createDataFrame([("key3", 3), ("key4", 4)], schemas.KEY_VALUE)
    W.append(kv, base + "/kv")
    back = spark.read.parquet(base + "/kv")
    r = back.agg({"value": "sum", "*": "count"}).collect()[0]
    assert (r["count(1)"], r["sum(value)"]) == (2, 7)                       # T12
    W.create_table(spark, schemas.KEY_VALUE, base + "/kv", truncate=True)
    assert spark.read.parquet(base + "/kv").count() == 0
    users = spark.createDataFrame([("1", "Ann", "A"), ("2", "Bob", "B")], schemas.USER)
    W.write_table(users, base + "/user", columns=["id", "firstName", "lastName"])
    u = spark.read.parquet(base + "/user")
    assert u.count() == 2 and u.where("firstName = 'Ann'").count() == 1    # T13
    assert os.path.isdir(base.replace("file://", ""))


def test_upsert_matches_a_dict_model(spark):
    import random
    rnd = random.Random(5)
    for insert_only in (False, True):
        existing = {f"k{i}": f"old{i}" for i in range(0, 40, 2)}
        incoming = [(f"k{rnd.randrange(60)}", rnd.choice([None, f"v{rnd.randrange(5)}"])) for _ in range(80)]
        model = dict(existing)
        per_key = {}
        for k, v in incoming:
            per_key.setdefault(k, []).append(v)
        for k, vs in per_key.items():
            nn = [v for v in vs if v is not None]
            best = max(nn) if nn else None
            if insert_only and k in existing:
                continue
            model[k] = best
        ex = spark.createDataFrame(sorted(existing.items()), schemas.UNIQUENESS_INDEX)
        inc = spark.createDataFrame(incoming, schemas.UNIQUENESS_INDEX)
        got = {r.key: r.value for r in W.upsert(ex, inc, ["key"], insert_only=insert_only).collect()}
        assert got == model, insert_only


def test_upsert_multi_column_key(spark):
    ex = spark.createDataFrame([("a", "k1", "x"), ("a", "k2", "y")], schemas.UNIQUENESS_LOOKUP)
    inc = spark.createDataFrame([("a", "k1", "z"), ("b", "k1", "w")], schemas.UNIQUENESS_LOOKUP)
    got = {(r.id, r.key): r.value for r in W.upsert(ex, inc, ["id", "key"]).collect()}
    assert got == {("a", "k1"): "z", ("a", "k2"): "y", ("b", "k1"): "w"}


def test_upsert_never_mixes_rows(spark):
    inc = spark.createDataFrame([("k", "z", "1"), ("k", "a", "9")], "key string, x string, y string")
    assert [tuple(r) for r in W.upsert(None, inc, ["key"]).collect()] == [("k", "z", "1")]
    old = spark.createDataFrame([("k", "zz", "0"), ("l", None, None)], "key string, x string, y string")
    assert sorted(map(str, W.upsert(old, inc, ["key"]).collect())) == sorted(
        map(str, spark.createDataFrame([("k", "z", "1"), ("l", None, None)], "key string, x string, y string").collect()))


def test_versions_are_numbered_and_an_uncommitted_table_raises(spark, tmp_path):
    import pytest
    table = f"{tmp_path}/t"
    kv = spark.createDataFrame([("k", "v")], schemas.UNIQUENESS_INDEX)
    names = [os.path.basename(W.upsert_table(spark, table, kv, ["key"])) for _ in range(12)]
    assert [int(n[2:14]) for n in names] == list(range(1, 13))
    assert [os.path.basename(v) for v in W.list_versions(spark, table)] == names
    for n in names:
        os.remove(f"{table}/{n}/_SUCCESS")
    with pytest.raises(RuntimeError):
        W.upsert_table(spark, table, kv, ["key"])


def test_objects_put_again_replace_and_others_stay(spark):
    path = scratch_path(spark, "objects")
    put = lambda rows: W.write_objects(spark.createDataFrame(rows, "object_key string, content string"), path)
    put([("a", "1"), ("b", "1")])
    put([("b", "0"), ("c", "2")])
    assert {r.object_key: r.content for r in W.read_objects(spark, path).collect()} == {"a": "1", "b": "0", "c": "2"}
