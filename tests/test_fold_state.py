"""The stored fold state: any split of a log into batches gives the fold of the
whole, and a batch reads neither the log before it nor untouched buckets."""

import random


from keyledger import schemas
from keyledger.operators import events, fold_state as S
from keyledger.operators.families import CONTACT, CORE, IDENTITY_FIELDS
from keyledger.plans import jobs
from keyledger.session import scratch_path, stage
from keyledger.sinks import buckets
from keyledger.sources import eventlog

from conftest import raw

SF = "/root/testdata/sf0.001"
FAMILIES = ["core", "contact"]


def logs_of(spark, rows):
    core = spark.createDataFrame([r for f, r in rows if f == "core"], schemas.RAW_EVENT)
    contact = spark.createDataFrame([r for f, r in rows if f == "contact"], schemas.RAW_EVENT)
    return [("core", core), ("contact", contact)]


def test_any_split_and_order_of_batches(spark):
    rnd = random.Random(4)
    rows = []
    for k in range(160):
        uid, ms = f"mock:id:{rnd.randrange(12)}", 1_704_067_200_000 + 1000 * rnd.randrange(20)
        if rnd.random() < 0.3:
            body, rem = ({"phone": f"p{k}"}, []) if rnd.random() < 0.6 else ({}, ["phone"])
            rows.append(("contact", raw(uid, ms, body, rem, node=k)))
        else:
            body = {n: f"{n}{k}" for n in ("otherId", "username") if rnd.random() < 0.5}
            rows.append(("core", raw(uid, ms, body, [n for n in ("otherId", "username") if rnd.random() < 0.3], node=k)))
    rows.append(("core", ("mock:id:nothing", rows[0][1][1], None)))  # a user without a payload
    rows.append(("contact", raw("mock:id:no-user", 1, {"phone": "p"})))
    (_, core), (_, contact) = logs_of(spark, rows)
    want = sorted(events.populate_from_logs(core, contact).collect(), key=str)
    path = scratch_path(spark, "state")
    S.create_state(spark, path, FAMILIES, 4)
    rnd.shuffle(rows)
    for a, b in ((0, 5), (5, 90), (90, 90), (60, 100), (100, len(rows))):  # one empty, one that repeats events
        S.update_state(spark, path, stage(S.fold_state(logs_of(spark, rows[a:b])), "batch"), IDENTITY_FIELDS)
    got = S.current_fields(S.read_state(spark, path), IDENTITY_FIELDS)
    assert sorted(got.collect(), key=str) == want


def test_state_keeps_removed_and_untouched_apart(spark):
    rows = [("core", raw("a", 5, {}, ["otherId"])), ("core", raw("b", 5, {"username": "n"}))]
    state = {r.id: r for r in S.fold_state(logs_of(spark, rows)).collect()}
    assert state["a"].o_otherId is not None and state["a"].v_otherId is None
    assert state["b"].o_otherId is None and state["b"].v_username == "n"
    late = S.fold_state(logs_of(spark, [("core", raw("a", 4, {"otherId": "older"}))]))
    merged = S.merge_states(S.fold_state(logs_of(spark, rows)).unionByName(late), IDENTITY_FIELDS)
    assert S.current_fields(merged.where("id = 'a'"), IDENTITY_FIELDS).first().otherId is None


def test_a_batch_reads_only_new_events_and_touched_buckets(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    base = scratch_path(spark, "inc")
    S.create_state(spark, f"{base}/state", FAMILIES, 32)
    jobs.create_index_tables(spark, f"{base}/index", f"{base}/lookup", 32)
    old, new = ev.where("ts < timestamp_ntz '2024-01-29'"), ev.where("ts >= timestamp_ntz '2024-01-29' and user_id % 5 = 1")
    logs = lambda e: [("core", eventlog.core_event_log(e)), ("contact", eventlog.contact_event_log(e))]
    jobs.update_indexes(spark, logs(old), f"{base}/state", f"{base}/index", f"{base}/lookup")
    plan = S.fold_state(logs(new))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(ts") == 2  # the scan is cut to the new events
    out = jobs.update_indexes(spark, logs(new), f"{base}/state", f"{base}/index", f"{base}/lookup")
    ids = S.fold_state(logs(new)).select("id")
    want = {r[0] for r in ids.select(buckets.bucket_of(buckets.layout(spark, f"{base}/state"))).distinct().collect()}
    assert set(out["state"]) == want and len(want) < 32
    again = jobs.update_indexes(spark, logs(new), f"{base}/state", f"{base}/index", f"{base}/lookup")
    assert set(again["state"]) == want
    whole = events.populate_from_logs(*eventlog_pair(old.unionByName(new)))
    got = S.current_fields(S.read_state(spark, f"{base}/state"), CORE.fields + CONTACT.fields)
    assert sorted(got.collect(), key=str) == sorted(whole.collect(), key=str)


def eventlog_pair(ev):
    return eventlog.core_event_log(ev), eventlog.contact_event_log(ev)


def test_partial_then_final(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    plan = S.fold_state([("core", eventlog.core_event_log(ev))])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and plan.count("hashpartitioning(id") == 1
