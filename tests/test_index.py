from keyledger import schemas
from keyledger.functions.constants import OTHER_ID_KEY, PHONE_KEY, USERNAME_KEY
from keyledger.operators import index as X


def fields(spark, rows):
    return spark.createDataFrame(rows, schemas.UNIQUE_FIELDS)


def full(i, owner=None):
    return (f"mock:id:{owner if owner is not None else i}", f"mock:otherId:{i}", f"mock:username:{i}",
            f"mock:verifiedPhone:{i}")


def status(frame):
    return {r.id: r for r in frame.collect()}


def test_t3_all_pass(spark):
    f = fields(spark, [full(i) for i in range(100)])
    idx, lk = X.index_rows(f), X.lookup_rows(f)
    assert idx.count() == 300 and lk.count() == 300
    st = status(X.audit(f, idx, lk))
    assert len(st) == 100
    for r in st.values():
        for c in schemas.STATUS_COLUMNS:
            assert r[c]["pass"] is True and r[c]["reason"] == "Pass"


def test_t4_missing(spark):
    f = fields(spark, [full(0)])
    empty_i = spark.createDataFrame([], schemas.UNIQUENESS_INDEX)
    empty_l = spark.createDataFrame([], schemas.UNIQUENESS_LOOKUP)
    assert X.index_rows(f).count() == 3 and X.lookup_rows(f).count() == 3
    r = status(X.audit(f, empty_i, empty_l))["mock:id:0"]
    for c in schemas.STATUS_COLUMNS:
        assert r[c]["pass"] is False and r[c]["reason"] == "Missing"


def test_t5_conflicts(spark):
    f = fields(spark, [full(0)])
    other = fields(spark, [full(1)])
    idx = X.index_rows(fields(spark, [(("mock:id:1",) + full(0)[1:])]))  # keys of user 0 owned by id:1
    lk = X.lookup_rows(other).select(
        __import__("pyspark.sql.functions", fromlist=["lit"]).lit("mock:id:0").alias("id"), "key", "value")
    r = status(X.audit(f, idx, lk))["mock:id:0"]
    assert r.otherId["reason"] == "Conflict: existing [mock:id:1] populated [mock:id:0]"
    assert r.otherIdLookup["reason"] == "Conflict: existing [mock:otherId:1] populated [mock:otherId:0]"
    assert r.usernameLookup["reason"] == "Conflict: existing [mock:username:1] populated [mock:username:0]"
    assert all(r[c]["pass"] is False for c in schemas.STATUS_COLUMNS)


def test_t6_bare_user(spark):
    f = fields(spark, [("mock:id:0", None, None, None)])
    assert X.index_rows(f).count() == 0 and X.lookup_rows(f).count() == 0
    r = status(X.audit(f, spark.createDataFrame([], schemas.UNIQUENESS_INDEX),
                       spark.createDataFrame([], schemas.UNIQUENESS_LOOKUP)))
    assert list(r) == ["mock:id:0"]
    assert all(r["mock:id:0"][c] is None for c in schemas.STATUS_COLUMNS)
    line = X.status_lines(X.audit(f, X.index_rows(f), X.lookup_rows(f))).collect()[0].value
    assert line == "mock:id:0, , , , , , "


def test_t7_quoted_value(spark):
    f = fields(spark, [("mock:id:0", None, "mock:corrupt:':0", None)])
    idx, lk = X.index_rows(f), X.lookup_rows(f)
    assert idx.count() == 1 and lk.count() == 1
    r = status(X.audit(f, idx, lk))["mock:id:0"]
    assert r.username["reason"] == "Pass" and r.usernameLookup["reason"] == "Pass"
    assert idx.collect()[0].key == USERNAME_KEY + ":mock:corrupt:':0"


def test_n11_two_users_one_username(spark):
    f = fields(spark, [("mock:id:0", None, "same", None), ("mock:id:1", None, "same", None)])
    rows = X.index_rows(f).collect()
    assert len(rows) == 2
    from keyledger.sinks.writers import upsert
    after = upsert(None, X.index_rows(f), ["key"]).collect()
    assert [(r.key, r.value) for r in after] == [(USERNAME_KEY + ":same", "mock:id:1")]


def test_n12_partial_status_line(spark):
    f = fields(spark, [("mock:id:0", "mock:otherId:0", None, None)])
    line = X.status_lines(X.audit(f, X.index_rows(f), X.lookup_rows(f))).collect()[0].value
    assert line == "mock:id:0, Pass, Pass, , , , "


def test_n18_unreadable_index(spark):
    f = fields(spark, [("mock:id:0", "mock:otherId:0", None, "mock:verifiedPhone:0")])
    r = status(X.audit(f, None, X.lookup_rows(f)))["mock:id:0"]
    assert r.otherId["reason"] == "Query Exception" and r.verifiedPhone["reason"] == "Query Exception"
    assert r.username is None
    assert r.otherIdLookup["reason"] == "Pass"


def test_lookup_keys_are_bare_prefixes(spark):
    f = fields(spark, [full(3)])
    assert sorted(r.key for r in X.lookup_rows(f).collect()) == sorted([OTHER_ID_KEY, USERNAME_KEY, PHONE_KEY])
    assert sorted(r.key for r in X.index_rows(f).collect()) == sorted(
        [OTHER_ID_KEY + ":mock:otherId:3", USERNAME_KEY + ":mock:username:3", PHONE_KEY + ":mock:verifiedPhone:3"])


def test_uniqueness_fields_merge(spark):
    f = fields(spark, [full(7), ("mock:id:8", None, "a:b", None)])
    idx = X.index_rows(f)
    extra = spark.createDataFrame([(OTHER_ID_KEY + ":mock:otherId:9", "mock:id:7")], schemas.UNIQUENESS_INDEX)
    got = {r.id: r for r in X.uniqueness_fields(idx.unionByName(extra)).collect()}
    assert got["mock:id:7"].otherIds == ["7", "9"]
    assert got["mock:id:7"].usernames == ["7"] and got["mock:id:7"].verifiedPhones == ["7"]
    assert got["mock:id:8"].usernames == ["b"] and got["mock:id:8"].otherIds == []
