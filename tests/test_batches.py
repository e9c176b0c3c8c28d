from pyspark.sql import functions as F

from keyledger.operators import batches as B
from keyledger.operators.ranking import rank_within
from keyledger.session import scratch_path
from keyledger.sinks.writers import write_outbox
from keyledger.sources.tables import read_message_ids


def ids(spark, n, prefix="mock:id:"):
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("id"))


def test_t11_thousand_ids_read_back(spark):
    msgs = B.queue_messages(ids(spark, 1000))
    path = write_outbox(msgs.select("entry_id", "body"), scratch_path(spark, "outbox"), "a")
    back = read_message_ids(spark, path)
    got = sorted(r.id for r in back.collect())
    assert got == sorted(f"mock:id:{i}" for i in range(1000))
    assert max(r.n_ids for r in msgs.collect()) <= 50


def test_n14_batch_sizes(spark):
    one_bucket = F.lit(0)
    m = B.topic_messages(ids(spark, 101), bucket=one_bucket).collect()
    assert sorted(r.n_ids for r in m) == [1, 50, 50]
    m = sorted(m, key=lambda r: r.batch_no)
    all_ids = [i for r in m for i in r.ids]
    assert all_ids == sorted(all_ids)   # batches follow id order
    q = B.queue_messages(ids(spark, 1001), bucket=one_bucket)
    req = B.queue_requests(q).collect()
    assert sorted(r.n_ids for r in req) == [1, 500, 500]
    assert max(len(r.entries) for r in req) == 10


def test_body_is_json_array(spark):
    m = B.topic_messages(ids(spark, 3), bucket=F.lit(0)).collect()[0]
    assert m.body == '["mock:id:0","mock:id:1","mock:id:2"]'


def test_rank_within_hot_key_is_spread(spark):
    # One key holds most rows; it must be numbered 1..n across many partitions.
    hot = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").alias("o"))
    cold = spark.range(300).select(F.concat(F.lit("c"), (F.col("id") % 30).cast("string")).alias("k"),
                                   F.col("id").alias("o"))
    r = rank_within(hot.unionByName(cold), ["k"], ["o"], rows_per_range=2500)
    bad = (r.groupBy("k").agg(F.count("*").alias("n"), F.max("seq").alias("mx"), F.min("seq").alias("mn"),
                              F.countDistinct("seq").alias("d"))
           .where("mx != n OR mn != 1 OR d != n").count())
    assert bad == 0
    # the hot key spans several partitions
    parts = (hot.repartitionByRange(8, "k", "o").select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1
    # order within the key follows o
    wrong = r.where("k = 'hot'").where(F.col("seq") != F.col("o") + 1).count()
    assert wrong == 0


def test_messages_do_not_depend_on_the_settings(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(map(tuple, B.queue_messages(ids(spark, 1000).repartition(int(n))).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]


def test_entry_ids_of_a_run_repeat_and_differ_between_runs(spark):
    m = lambda run: {r.entry_id for r in B.queue_messages(ids(spark, 400), run_id=run).collect()}
    a, again, b = m("a"), m("a"), m("b")
    assert a == again and not a & b and all(len(x) == 36 for x in a)
    assert len(a) == B.queue_messages(ids(spark, 400)).count()


def test_second_run_keeps_the_first_runs_messages(spark):
    path = scratch_path(spark, "outbox")
    msgs = B.queue_messages(ids(spark, 100)).select("entry_id", "body")
    for run in ("a", "b", "b"):
        write_outbox(msgs, path, run)
    assert read_message_ids(spark, path).count() == 200
