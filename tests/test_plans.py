"""Plan checks: no Python on rows, pruning reaches the scan, the anti join is
an anti join, the fold aggregates partially before its shuffle."""

import re

from pyspark.sql import functions as F

from keyledger import schemas
from keyledger.operators import events, ids
from keyledger.operators import index as X
from keyledger.plans.queries import QUERIES
from keyledger.session import scratch_path

SF = "/root/testdata/sf0.001"
PY = re.compile(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF")


def test_no_python_in_any_plan(spark):
    for name, fn in QUERIES.items():
        if name in ("live_insert", "live_compare") or name.startswith("job_"):
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not PY.search(plan), name


def test_id_extraction_reads_only_the_id(spark):
    path = scratch_path(spark, "raw")
    spark.createDataFrame([("a", "t", "{}")], schemas.RAW_EVENT).write.parquet(path)
    plan = ids.distinct_ids(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan


def test_fold_is_partial_then_final(spark):
    core, contact = __import__("keyledger.sources.eventlog", fromlist=["x"]).event_logs(spark, SF)
    plan = events.populate_from_logs(core, contact)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert plan.count("hashpartitioning(id") == 1


def test_diff_is_anti_join(spark):
    plan = QUERIES["extraction_diff"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_event_filters_reach_the_scan(spark):
    plan = QUERIES["index_upsert"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in plan and "In(event_type, [click,view])" in plan and "In(event_type, [error,purchase,signup])" in plan
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>", plan)


def test_a_value_that_many_users_claim(spark):
    """20,000 users hold one username on both sides: the join gives one row for
    each claim, and AQE can split that value (nothing lies between the staged
    index's shuffle and the join)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        f = spark.range(22000).select(
            F.concat(F.lit("mock:id:"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("id"),
            F.concat(F.lit("o"), F.col("id").cast("string")).alias("otherId"),
            F.when(F.col("id") < 20000, F.lit("")).otherwise(F.concat(F.lit("u"), F.col("id").cast("string")))
            .alias("username"),
            F.lit(None).cast("string").alias("verifiedPhone"))
        st = X.audit(f, X.index_rows(f), X.lookup_rows(f))
        rows = st.collect()
        assert len(rows) == 22000
        assert sum(1 for r in rows if r.username["reason"] == "Pass") == 2001
        plan = st._jdf.queryExecution().executedPlan()
        assert "skew=true" in plan.toString()
        counts = [m.value() for m in _join_rows(plan)]
        assert max(counts) <= 44000  # the claims, and no more
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _join_rows(plan):
    """The output-row metrics of all joins of an executed (adaptive) plan."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if "Join" in name:
            out.append(node.metrics().get("numOutputRows").get())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_repeated_ids_keep_their_own_statuses(spark):
    f = spark.createDataFrame([("u0", "a", None, None), ("u0", "b", None, None), ("u0", "b", None, None)], schemas.UNIQUE_FIELDS)
    index = X.index_rows(spark.createDataFrame([("u0", "a", None, None), ("u9", "b", None, None)], schemas.UNIQUE_FIELDS))
    got = sorted(r.otherId["reason"] for r in X.audit(f, index, None).collect())
    assert got == ["Conflict: existing [u9] populated [u0]"] * 2 + ["Pass"]
