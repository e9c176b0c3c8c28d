from pyspark.sql import functions as F

from keyledger import schemas
from keyledger.operators import generate as G
from keyledger.operators import ids as I
from keyledger.operators.objects import keyed_objects

from conftest import raw


def test_n16_extraction_diff(spark):
    a = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    b = spark.createDataFrame([("2",), ("3",), ("4",)], "id string")
    d = I.extraction_diff(a, b)
    assert [r.id for r in d.collect()] == ["1"]
    assert "LeftAnti" in d._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_counts_and_repeats(spark):
    ev = spark.createDataFrame([raw(f"mock:id:{i % 3}", 1000 + i, {"id": "x"}, node=i) for i in range(7)],
                               schemas.RAW_EVENT)
    assert sorted(r.id for r in I.distinct_ids(ev).collect()) == ["mock:id:0", "mock:id:1", "mock:id:2"]
    assert {r.id: r.n for r in I.id_counts(ev).collect()} == {"mock:id:0": 3, "mock:id:1": 2, "mock:id:2": 2}
    c = I.extraction_counts(ev).collect()[0]
    assert (c.n_rows, c.n_ids, c.n_repeated) == (7, 3, 4)
    b = I.bare_fields(I.distinct_ids(ev)).collect()
    assert all(r.otherId is None and r.username is None and r.verifiedPhone is None for r in b)


def test_t10_keyed_objects(spark):
    data = spark.createDataFrame([(str(i),) for i in (1, 2, 2, 3, 3, 3)], "id string")
    obj = keyed_objects(data).collect()
    assert sorted(r.object_key for r in obj) == ["output/id/1", "output/id/2", "output/id/3"]
    assert all(r.content == "" and r.content_length == 0 and r.content_md5 == "1B2M2Y8AsgTpgAmY7PhCfg=="
               for r in obj)
    assert data.count() == 6  # the input itself is unchanged


def test_seed_generator(spark):
    users = G.mock_ids(10, spark)
    n = G.events_per_user(1)
    assert 5 <= n <= 14
    ev = G.seed_core_events(users, n, 1_706_745_600_000, seed=3)
    assert ev.count() == 10 * n
    from keyledger.operators.events import parse_events
    p = parse_events(ev, "core")
    r = p.agg(F.min("time_ms").alias("lo"), F.max("time_ms").alias("hi"),
              F.count_distinct("time").alias("d"), F.count("*").alias("n")).collect()[0]
    assert r.hi <= 1_706_745_600_000 - 86_400_000 and r.lo >= 1_706_745_600_000 - 100 * 86_400_000
    assert r.d == r.n  # every event has its own time uuid
    again = G.seed_core_events(users, n, 1_706_745_600_000, seed=3)
    assert sorted(ev.collect()) == sorted(again.collect())


def test_approx_distinct_option(spark):
    ev = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("id"))
    exact = I.extraction_counts(ev).collect()[0]
    approx = I.extraction_counts(ev, approx=True).collect()[0]
    assert exact.n_ids == 1000 and abs(approx.n_ids - 1000) <= 50


def test_mock_ids_inclusive_end_k19(spark):
    assert G.mock_ids(10, spark).count() == 10
    assert G.mock_ids(10, spark, inclusive_end=True).count() == 11


def test_seeded_events_do_not_depend_on_partitions(spark):
    users = G.mock_ids(300, spark)
    seed = lambda u: sorted(map(tuple, G.seed_core_events(u, 20, 1_706_745_600_000, seed=3).collect()))
    rows = seed(users.repartition(3))
    assert rows == seed(users.repartition(7, "id"))
    assert len({(i, t) for i, t, _ in rows}) == len(rows) == 6000
    # more events of one user and instant than a clock sequence can tell apart
    many = G.seed_core_events(G.mock_ids(1, spark), 40_000, 1_706_745_600_000, max_days=1)
    assert many.select("time").distinct().count() == 40_000
