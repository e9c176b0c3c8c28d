import time

from keyledger.operators.events import parse_events
from keyledger.session import scratch_path
from keyledger.streaming import live_insert as L


def test_bounded_batches_are_deterministic(spark):
    base = scratch_path(spark, "live")
    L.insert_batches(spark, 100, base + "/t", base + "/ck", rows_per_batch=25, batches=3)
    got = L.read_inserted(spark, base + "/t")
    rows = got.collect()
    assert len(rows) == 75
    assert sorted(r.seq_no for r in rows) == list(range(75))
    assert {r.id for r in rows} == {f"mock:id:{100 + v}" for v in range(75)}
    assert got.select("batch_id").distinct().count() == 3
    p = parse_events(got.select("id", "time", "payload"), "core").collect()
    assert all(r.payload_id == r.id for r in p)


def test_continuous_trigger_then_stop(spark):
    base = scratch_path(spark, "live2")
    q = L.start_live_insert(spark, 10, base + "/t", base + "/ck", rows_per_batch=5, trigger_seconds=0.5)
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            p = q.lastProgress
            if p is not None and p.get("batchId", -1) >= 1:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    n = L.read_inserted(spark, base + "/t").count()
    assert n >= 10 and n % 5 == 0
