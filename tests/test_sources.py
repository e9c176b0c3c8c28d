from pyspark.sql import functions as F

from keyledger import schemas
from keyledger.session import scratch_path
from keyledger.sources import eventlog
from keyledger.sources.tables import TableRef, TableRegistry, read_text_lines

SF = "/root/testdata/sf0.001"


def test_registry_reads_declared_columns(spark):
    path = scratch_path(spark, "reg")
    spark.createDataFrame([("a", "t", "{}", "extra")], "id string, time string, payload string, x string") \
        .write.parquet(path)
    reg = TableRegistry()
    reg.add(TableRef("mock", "core_events", path))
    df = reg.read(spark, "mock", "core_events")
    assert df.columns == ["id", "time", "payload"]
    reg.register_views(spark)
    assert spark.sql("SELECT count(*) AS n FROM mock_core_events").collect()[0].n == 1


def test_text_lines(spark):
    path = scratch_path(spark, "txt")
    spark.createDataFrame([("x",), ("y",)], "v string").write.text(path)
    assert sorted(r.id for r in read_text_lines(spark, path, "id").collect()) == ["x", "y"]


def test_event_log_derivation(spark):
    core, contact = eventlog.event_logs(spark, SF)
    ev = spark.read.parquet(f"{SF}/events.parquet")
    assert core.count() == ev.where(F.col("event_type").isin("signup", "purchase", "error")).count()
    assert contact.count() == ev.where(F.col("event_type").isin("view", "click")).count()
    assert core.schema.fieldNames() == schemas.RAW_EVENT.fieldNames()
    # every time uuid is distinct (event id in the node bits)
    assert core.select("time").distinct().count() == core.count()
    old_core, _ = eventlog.event_logs(spark, SF, before="2024-01-15")
    assert old_core.count() < core.count()

