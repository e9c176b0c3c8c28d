"""The delivering sinks and the consumer: each message once, whatever fails."""

import os

import pytest
from pyspark.sql import functions as F

from keyledger.session import scratch_path
from keyledger.sinks import delivery as D
from keyledger.streaming import consume as C


def messages(spark, n, start=0):
    return spark.range(start, start + n, numPartitions=3).select(
        F.col("id").cast("string").alias("entry_id"), F.concat(F.lit('["u'), "id", F.lit('"]')).alias("body"))


def visible(spark, path):
    return sorted((r.run, r.entry_id) for r in spark.read.json(path).select("run", "entry_id").collect())


def test_a_run_is_delivered_once(spark):
    path = scratch_path(spark, "outbox")
    for _ in range(2):
        D.deliver(messages(spark, 10), path, "a")
    D.deliver(messages(spark, 4, 100), path, "b")
    assert visible(spark, path) == sorted([("a", str(i)) for i in range(10)] + [("b", str(i)) for i in range(100, 104)])
    assert os.listdir(path.replace("file://", "") + "/_pending") == []


def test_a_failing_task_leaves_no_message_and_a_retry_delivers_each(spark):
    path = scratch_path(spark, "outbox")
    bad = messages(spark, 30).select("entry_id", F.when(F.col("entry_id") == "29", F.raise_error(F.lit("broken"))).otherwise(F.col("body")).cast("string").alias("body"))
    with pytest.raises(Exception, match="broken"):
        D.deliver(bad, path, "a")
    root = path.replace("file://", "")
    assert not os.path.exists(f"{root}/run=a") and os.listdir(f"{root}/_pending") == []
    D.deliver(messages(spark, 30), path, "a")
    assert visible(spark, path) == sorted(("a", str(i)) for i in range(30))


def test_files_of_attempts_that_failed_are_not_kept(spark, tmp_path):
    rows = [("1", '["x"]'), ("2", '["y"]')]
    w = D.OutboxWriter({"path": str(tmp_path), "run_id": "r"}, ["entry_id", "body"])
    lost, kept = w.write(iter(rows)), w.write(iter(rows))  # the first attempt's message never came
    assert lost.name != kept.name
    w.commit([kept, None])
    assert [r[1] for r in visible(spark, str(tmp_path))] == ["1", "2"]
    w2 = D.OutboxWriter({"path": str(tmp_path), "run_id": "s"}, ["entry_id", "body"])
    w2.write(iter(rows))
    w2.abort([None])
    assert len(visible(spark, str(tmp_path))) == 2
    with pytest.raises(Exception):
        messages(spark, 1).write.format("keyledger_outbox").mode("append").save(str(tmp_path))


def test_objects_are_put_one_per_key(spark):
    path = scratch_path(spark, "store")
    put = lambda rows: D.put_objects(spark.createDataFrame(rows, "object_key string, content string"), path)
    put([("output/id/a", "1"), ("_b %2F+c", "é\nx"), (".hidden", None)])
    put([("output/id/a", "2"), ("d", "")])
    assert {r.object_key: r.content for r in D.read_delivered(spark, path).collect()} == {
        "output/id/a": "2", "_b %2F+c": "é\nx", ".hidden": "", "d": ""}
    root = path.replace("file://", "")
    assert sum(len([f for f in os.listdir(f"{root}/{d}") if not f.startswith(".")]) for d in os.listdir(root)) == 4  # no put left half done


def test_consumer_reads_each_run_once(spark):
    base = scratch_path(spark, "consumer")
    run = lambda: C.consume(spark, f"{base}/outbox", f"{base}/ids", f"{base}/ck", 1)
    got = lambda: sorted((r.run, r.id) for r in C.read_consumed(spark, f"{base}/ids").collect())
    D.deliver(messages(spark, 6), f"{base}/outbox", "a")
    run()
    assert got() == [("a", f"u{i}") for i in range(6)]
    D.deliver(messages(spark, 6), f"{base}/outbox", "a")  # again: nothing new
    run()
    assert len(got()) == 6
    D.deliver(messages(spark, 5, 10), f"{base}/outbox", "b")
    D.deliver(messages(spark, 3, 20), f"{base}/outbox", "c")
    q = C.start_consumer(spark, f"{base}/outbox", f"{base}/ids", f"{base}/ck", 1)
    q.stop()  # stopped at once, somewhere between its batches
    run()
    run()
    assert got() == sorted([("a", f"u{i}") for i in range(6)] + [("b", f"u{i}") for i in range(10, 15)] + [("c", f"u{i}") for i in range(20, 23)])
