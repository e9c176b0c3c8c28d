from pyspark.sql import functions as F

from keyledger.functions import columns as C
from keyledger.functions.constants import OTHER_ID_KEY, PHONE_KEY, USERNAME_KEY

from conftest import timeuuid


def one(spark, *cols):
    return spark.range(1).select(*cols).collect()[0]


def test_timeuuid_to_millis_n15(spark):
    r = one(spark, C.timeuuid_millis(F.lit("8a3efbc0-a5a1-11e6-8000-000000000000")).alias("ms"))
    assert r.ms == 1478602390908


def test_millis_to_timeuuid_roundtrip_n15(spark):
    r = one(spark, C.timeuuid_from_millis(F.lit(1478602390908)).alias("u"))
    assert r.u == "8a3efbc0-a5a1-11e6-8000-000000000000"
    assert r.u == timeuuid(1478602390908)
    back = one(spark, C.timeuuid_millis(C.timeuuid_from_millis(F.lit(1478602390908), node=F.lit(7))).alias("m"))
    assert back.m == 1478602390908


def test_timeuuid_rejects_other_versions(spark):
    r = one(spark, C.timeuuid_millis(F.lit("8a3efbc0-a5a1-41e6-8000-000000000000")).alias("ms"))
    assert r.ms is None


def test_timeuuid_timestamp(spark):
    r = one(spark, C.timeuuid_timestamp(F.lit(timeuuid(1704067200000))).alias("t"),
            C.to_epoch_millis(C.from_epoch_millis(F.lit(1704067200123))).alias("m"))
    assert r.t.year == 2024 and r.m == 1704067200123


def test_key_for_and_value_from_n13(spark):
    r = one(spark,
            C.key_for(OTHER_ID_KEY, F.lit("mock:otherId:7")).alias("k"),
            C.value_from(F.lit("__U:core:1:otherId:mock:otherId:7")).alias("v"),
            C.value_after_prefix(F.lit("__U:core:1:otherId:mock:otherId:7")).alias("lossless"),
            C.field_of_key(F.lit(USERNAME_KEY + ":x")).alias("f2"),
            C.field_of_key(F.lit(PHONE_KEY + ":x")).alias("f3"),
            C.field_of_key(F.lit("other:key"), strict=False).alias("unknown"))
    assert r.k == "__U:core:1:otherId:mock:otherId:7"
    assert r.v == "7"
    assert r.lossless == "mock:otherId:7"
    assert (r.f2, r.f3, r.unknown) == ("username", "verifiedPhone", None)


def test_unknown_key_is_an_error_n13(spark):
    import pytest
    with pytest.raises(Exception, match="unknown uniqueness key"):
        one(spark, C.field_of_key(F.lit("nope")).alias("f"))


def test_clean_key_s7(spark):
    r = one(spark, C.clean_key(F.lit("__U:core:1:username:mock:corrupt:':0")).alias("k"))
    assert r.k == "__U:core:1:username:mock:corrupt:'':0"


def test_conflict_and_csv_n12(spark):
    r = one(spark, C.conflict_text(F.lit("mock:id:1"), F.lit("mock:id:0")).alias("c"),
            C.csv_line(F.lit("mock:id:0"), F.lit("Pass"), F.lit("Pass"), F.lit(None), F.lit(None), F.lit(None),
                       F.lit(None)).alias("line"))
    assert r.c == "Conflict: existing [mock:id:1] populated [mock:id:0]"
    assert r.line == "mock:id:0, Pass, Pass, , , , "


def test_md5_base64_and_length(spark):
    import base64
    import hashlib
    r = one(spark, C.md5_base64(F.lit("héllo")).alias("m"), C.utf8_length(F.lit("héllo")).alias("n"),
            C.md5_base64(F.lit("")).alias("empty"), C.object_key(F.lit("mock:id:1")).alias("k"))
    assert r.m == base64.b64encode(hashlib.md5("héllo".encode()).digest()).decode()
    assert r.n == 6
    assert r.empty == "1B2M2Y8AsgTpgAmY7PhCfg=="
    assert r.k == "output/id/mock:id:1"


def test_chunks_n17(spark):
    df = spark.range(100).select(C.chunk_of(F.col("id"), 100, 3).alias("c"))
    sizes = sorted((r.c, r["count"]) for r in df.groupBy("c").count().collect())
    assert [s for _, s in sizes] == [33, 33, 34]
    incl = spark.range(101).select(C.chunk_of(F.col("id"), 100, 3).alias("c"))
    assert sorted(r["count"] for r in incl.groupBy("c").count().collect()) == [33, 33, 35]
    few = spark.range(2).select(C.chunk_of(F.col("id"), 2, 5).alias("c")).collect()
    assert sorted(r.c for r in few) == [0, 1]


def test_ntz_epoch_is_session_tz_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = one(spark, C.ntz_epoch_millis(F.lit("2024-01-01 00:00:07.179575").cast("timestamp_ntz")).alias("m"),
                C.ntz_epoch_micros(F.lit("1969-12-31 23:59:59.999999").cast("timestamp_ntz")).alias("u"),
                C.ntz_epoch_micros(F.lit("2024-07-01 12:00:00.000001").cast("timestamp_ntz")).alias("summer"),
                C.ntz_epoch_micros(F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")).alias("gap"))
        assert r.m == 1704067207179 and r.u == -1
        assert r.summer == 1719835200000001      # 2024-07-01T12:00:00.000001Z
        assert r.gap == 1710037800000000         # a wall time that does not exist in Los Angeles
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_timeuuid_agrees_with_python_uuid(spark):
    import random
    import uuid
    rnd = random.Random(9)
    cases = [(rnd.randrange(0, 4_000_000_000_000), rnd.randrange(0, 1 << 48), rnd.randrange(0, 1 << 14))
             for _ in range(200)]
    df = spark.createDataFrame(cases, "ms long, node long, clock long")
    out = df.select("ms", "node", "clock",
                    C.timeuuid_from_millis(F.col("ms"), node=F.col("node"), clock_seq=F.col("clock")).alias("u"))
    out = out.select("*", C.timeuuid_millis(F.col("u")).alias("back")).collect()
    for r in out:
        u = uuid.UUID(r.u)
        assert u.version == 1 and u.variant == uuid.RFC_4122
        assert u.time == r.ms * 10000 + 0x01B21DD213814000
        assert u.node == r.node and u.clock_seq == r.clock
        assert r.back == r.ms


def test_timeuuid_millis_exact_at_boundaries(spark):
    from keyledger.functions.constants import UUID_EPOCH_OFFSET
    rows = []
    for ms in (1478602390908, 1704067207179, 4102444800000):
        for r in (0, 1, 9998, 9999):
            rows.append((ms, ms * 10000 + UUID_EPOCH_OFFSET + r))
    df = spark.createDataFrame(rows, "ms long, ticks long")
    out = df.select("ms", C.timeuuid_millis(C.timeuuid_from_ticks(F.col("ticks"))).alias("back")).collect()
    assert all(r.back == r.ms for r in out)
