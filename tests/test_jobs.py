import os

from keyledger import schemas
from keyledger.plans import jobs as J
from keyledger.session import scratch_path
from keyledger.sinks import writers as W
from keyledger.sources import eventlog

SF = "/root/testdata/sf0.001"


def test_j1_j2_j8(spark):
    core, _ = eventlog.event_logs(spark, SF)
    base = scratch_path(spark, "j1")
    J.extract_ids_to_text(core, base + "/ids")
    n = core.select("id").distinct().count()
    assert spark.read.text(base + "/ids").count() == n
    J.extract_ids_to_objects(core, base + "/objects")
    assert W.read_objects(spark, base + "/objects").count() == n
    J.send_ids(core, base + "/queue", "a", "queue", n_buckets=4)
    from keyledger.sources.tables import read_message_ids
    assert read_message_ids(spark, base + "/queue").count() == n
    J.send_ids(core, base + "/topic", "a", "topic", n_buckets=4)
    assert read_message_ids(spark, base + "/topic").count() == n


def test_j3_j4(spark):
    base = scratch_path(spark, "j4")
    seen = []
    r = J.live_extraction_compare(spark, 40, base, rows_per_batch=10, batches_during=2,
                                  watch=lambda q: seen.append((q.isActive, q.lastProgress["batchId"])))
    assert seen[0][0] and r["stream_active"]  # inserts went on when the second extraction was done
    assert r["first"]["ids_in_table"] == 40 and r["first"]["ids_read_back"] == 40
    assert r["first"]["events"] == 40 * r["first"]["events_per_user"]
    assert r["lost"].collect() == []
    assert r["ids_second"] >= 60 and r["new_ids"] == r["ids_second"] - 40
    lost = J.ids.extraction_diff(spark.read.text(base + "/ids-2").withColumnRenamed("value", "id"),
                                 spark.read.text(base + "/ids-1").withColumnRenamed("value", "id"))
    assert lost.count() == r["new_ids"]  # the ids themselves, not only how many


def test_j5_j6_j7(spark):
    core, contact = eventlog.event_logs(spark, SF)
    old_core, old_contact = eventlog.event_logs(spark, SF, before="2024-01-29")
    base = scratch_path(spark, "j6")
    J.generate_index(spark, old_core, old_contact, base + "/old-index", base + "/old-lookup")
    out = J.generate_and_audit(spark, core, contact, base + "/old-index", base + "/old-lookup",
                               base + "/index", base + "/lookup", base + "/report")
    lines = [r.value for r in spark.read.text(out["report"]).collect()]
    assert len(lines) == core.select("id").distinct().count()
    assert all(len(line.split(", ")) >= 7 for line in lines)
    assert any("Pass" in line for line in lines)
    # unreadable old tables -> Query Exception
    out2 = J.generate_and_audit(spark, core, contact, base + "/missing-i", base + "/missing-l",
                                base + "/index2", base + "/lookup2", base + "/report2")
    lines2 = [r.value for r in spark.read.text(out2["report"]).collect()]
    assert len(lines2) == len(lines)
    assert all("Missing" not in x and "Pass" not in x for x in lines2)
    assert any("Query Exception" in x for x in lines2)
    J.populate_and_write(spark, core, contact, base + "/old-index", base + "/old-lookup")
    assert len(W.list_versions(spark, base + "/old-index")) == 2
    latest = W.read_latest(spark, base + "/old-index")
    assert latest.groupBy("key").count().where("count > 1").count() == 0


def test_j9(spark):
    kv = spark.createDataFrame([("key3", 3), ("key4", 4)], schemas.KEY_VALUE)
    users = spark.createDataFrame([("1", "Ann", "A"), ("2", "Bob", "B")], schemas.USER)
    r = J.connector_roundtrip(spark, kv, users, scratch_path(spark, "j9"), "Ann")
    assert r == {"kv_count": 2, "kv_sum": 7, "users": 2, "matching_first_name": 1}


def test_staged_fields_are_removed(spark):
    from keyledger.session import checkpoint_root
    core, contact = eventlog.event_logs(spark, SF)
    base = scratch_path(spark, "j5")
    J.generate_index(spark, core, contact, base + "/index", base + "/lookup")
    root = checkpoint_root(spark).replace("file://", "")
    held = lambda: {d for d in os.listdir(os.path.join(root, "keyledger")) if d.startswith(("fields-", "rank-"))}
    before = held()
    J.generate_index(spark, core, contact, base + "/index", base + "/lookup")
    J.send_ids(core, base + "/queue", "a")
    assert held() <= before  # neither run left a staged table behind


def test_objects_keyed_by_a_pandas_udf(spark):
    """The key function may be a vectorised one of the caller's."""
    import pandas as pd
    from pyspark.sql import functions as F
    from keyledger.operators import objects

    @F.pandas_udf("string")
    def key(ids: pd.Series) -> pd.Series:
        return "by-md5/" + ids.str[-1]

    rows = spark.createDataFrame([("a1", "x"), ("b1", "z"), ("a2", "y")], "id string, v string")
    got = {r.object_key: r.content for r in objects.keyed_objects(rows, key=key(F.col("id")), content=F.col("v")).collect()}
    assert got == {"by-md5/1": "z", "by-md5/2": "y"}
