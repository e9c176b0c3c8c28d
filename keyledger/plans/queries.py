"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the given tables (or data Spark derives from them), with flat columns
named as in ``oracle.ORACLE_SQL``.

The old index of the audit queries is the same pipeline run on the event log
cut at ``OLD_CUT`` (the log as it stood then); ``extraction_diff`` compares,
for every day, the users active that day with those active the next day.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyledger import schemas
from keyledger.functions import columns as C
from keyledger.functions.constants import MOCK_ID
from keyledger.operators import batches, events, fold_state, generate, ids, index, objects, sketches
from keyledger.operators.families import EventFamily, TrackedField
from keyledger.plans import jobs
from keyledger.session import scratch_path, stage, stage_all
from keyledger.sinks import buckets, delivery, sorted_index, writers
from keyledger.sources import catalog, eventlog, stored_logs, tables
from keyledger.streaming import consume
from keyledger.streaming import live_insert as live

OLD_CUT = "2024-01-29"
BATCH_BUCKETS = 2
MOCK_OLD = "mock:old:value"
PAGE_SIZE = 16  # events per page in populate_arrays: small, so users span several pages
MERGE_PAGE = 2  # keys per page in uniqueness_fields_merge: small, so owners span several pages
ENTRY_IDS = 5   # ids per queue entry in queue_requests: small, so a bucket needs several requests
RUN_ID = "run-1"
LATE = 7            # of so many events one arrives after all others in the incremental queries
STATE_BUCKETS = 8   # of the bucketed tables that queries write
INSERT_START_MS = 1_704_067_200_000
SEED_EVENTS = generate.events_per_user(42)
SEED_ANCHOR_MS = 1_706_745_600_000  # 2024-02-01T00:00:00Z


def _logs(spark, sf, before=None):
    return eventlog.event_logs(spark, sf, before)


def _events(spark, sf):
    return tables.read_parquet_table(spark, sf, "events")


def _pop(spark, sf, before=None) -> DataFrame:
    core, contact = _logs(spark, sf, before)
    return events.populate_from_logs(core, contact)


def _user_num(col="id"):
    return C.value_from(F.col(col)).cast("bigint")


def _batch_bucket():
    return F.pmod(_user_num("id"), F.lit(BATCH_BUCKETS))


# ------------------------------------------------------------------ extraction

def q_distinct_ids(spark, sf):
    core, _ = _logs(spark, sf)
    return ids.distinct_ids(core)


def q_id_counts(spark, sf):
    core, _ = _logs(spark, sf)
    return ids.id_counts(core)


def q_extraction_counts(spark, sf):
    core, _ = _logs(spark, sf)
    return ids.extraction_counts(events.parse_events(core, "core"), sum_col="time_ms")


def q_extraction_diff(spark, sf):
    # For every day of the log: users active that day (first extraction) and
    # not the next day (second extraction, the same log shifted back a day).
    core, _ = _logs(spark, sf)
    day = F.floor(C.timeuuid_millis(F.col("time")) / F.lit(86_400_000)).cast("bigint")
    active = core.select("id", day.alias("day"))
    next_day = active.select("id", (F.col("day") - 1).alias("day"))
    return ids.extraction_diff(active, next_day, ["id", "day"])


def q_extraction_sketches(spark, sf):
    # A stored sketch per day, merged into running counts; the exact
    # count of the same days beside the question whether the estimate is near.
    core, _ = _logs(spark, sf)
    day = F.floor(C.timeuuid_millis(F.col("time")) / F.lit(86_400_000)).cast("bigint")
    active = core.select("id", day.alias("day"))
    stored = stage(sketches.extraction_sketches(active, ["day"]), "sketches")
    so_far = sketches.running(stored, "day").select("day", "n_rows", sketches.estimate().alias("estimate"))
    first = active.groupBy("id").agg(F.min("day").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n_new"))
    exact = so_far.join(first, "day", "left").select("day", "n_rows", "estimate", F.sum(F.coalesce("n_new", F.lit(0))).over(
        Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)).alias("n_ids"))
    near = F.abs(F.col("estimate") - F.col("n_ids")) <= F.greatest(F.lit(1.0), F.col("n_ids") * sketches.MAX_ERROR)
    return exact.select("day", "n_rows", "n_ids", near.alias("near"))


def q_typed_filter(spark, sf):
    cust = tables.read_parquet_table(spark, sf, "customer")
    return cust.where(F.col("c_mktsegment") == "HOUSEHOLD").select("c_custkey", "c_name")


# ------------------------------------------------------------------ events

def q_relevant_core_events(spark, sf):
    core, _ = _logs(spark, sf)
    ev = events.relevant(events.parse_events(core, "core"), "core")
    return ev.select("id", "time_ms", F.col("set_otherId"), F.col("set_username"),
                     F.array_contains("rem", "otherId").alias("rem_otherId"),
                     F.array_contains("rem", "username").alias("rem_username"))


def q_relevant_contact_events(spark, sf):
    _, contact = _logs(spark, sf)
    ev = events.relevant(events.parse_events(contact, "contact"), "contact")
    return ev.select("id", "time_ms", "set_phone", F.array_contains("rem", "phone").alias("rem_phone"))


def q_parsed_payload(spark, sf):
    core, contact = _logs(spark, sf)
    cols = ["id", "payload_id", "time_ms", "model", "source", "version", "snapshot",
            F.size("rem").cast("bigint").alias("n_rem")]
    a = events.parse_events(core, "core").select(F.lit("core").alias("family"), *cols)
    b = events.parse_events(contact, "contact").select(F.lit("contact").alias("family"), *cols)
    return a.unionByName(b)


def q_collected_events(spark, sf):
    core, _ = _logs(spark, sf)
    return events.ordered_events(core, "core").select("id", "seq", "time_ms")


# ------------------------------------------------------------------ populate

def q_populate(spark, sf):
    return _pop(spark, sf)


def q_populate_users(spark, sf):
    core, contact = _logs(spark, sf)
    users = ids.bare_fields(ids.distinct_ids(core))
    return events.populate(users, core, contact)


def q_populate_arrays(spark, sf):
    # E7 -> E6 in list form: pages of at most PAGE_SIZE events per user, each
    # folded with `aggregate`, pages combined in order.  Same result as populate.
    core, contact = _logs(spark, sf)
    users = ids.bare_fields(ids.distinct_ids(core))
    return events.populate_from_pages(users, events.event_pages(core, "core", PAGE_SIZE),
                                      events.event_pages(contact, "contact", PAGE_SIZE))


def q_populate_partial(spark, sf):
    core, contact = _logs(spark, sf)
    return events.populate(_partial_users(core), core, contact)


def _partial_users(core):
    n = _user_num("id")
    return ids.distinct_ids(core).select(
        "id",
        F.when(n % 3 == 0, F.lit(MOCK_OLD)).alias("otherId"),
        F.when(n % 5 == 0, F.lit(MOCK_OLD)).alias("username"),
        F.when(n % 2 == 0, F.lit(MOCK_OLD)).alias("verifiedPhone"))


def q_populate_only_needed(spark, sf):
    # The events of users that miss nothing of a family are not folded.
    core, contact = _logs(spark, sf)
    return events.populate(_partial_users(core), core, contact, only_needed=True)


BIO = EventFamily("bio", (TrackedField("nickname", "nickname", "__U:bio:1:nickname", ("alias",)),
                          TrackedField("city", "address.city", "__U:bio:1:city", ("home",))))


def q_open_family(spark, sf):
    # A family described here, without a declared schema, through parse,
    # fold and index.
    fields = events.fold_logs([(BIO, eventlog.bio_event_log(_events(spark, sf)))])
    return index.index_rows(fields, BIO.fields)


def q_families_together(spark, sf):
    # Three families folded in one shuffle.
    core, contact = _logs(spark, sf)
    bio = eventlog.bio_event_log(_events(spark, sf))
    return events.fold_logs([("core", core), ("contact", contact), (BIO, bio)], members=("core",))


def _batches(spark, sf):
    """The logs in three batches: before the cut but for some events, after it,
    and last the events held back (late by up to the whole log)."""
    ev = _events(spark, sf)
    early = F.col("ts") < F.lit(OLD_CUT).cast("timestamp_ntz")
    late = F.col("event_id") % LATE == 3
    for part in (early & ~late, ~early & ~late, late):
        rows = ev.where(part)
        yield [("core", eventlog.core_event_log(rows)), ("contact", eventlog.contact_event_log(rows))]


def q_populate_incremental(spark, sf):
    # The state of each batch merged into the stored one, late events last.
    path = scratch_path(spark, "fold-state")
    families = ["core", "contact"]
    fold_state.create_state(spark, path, families, STATE_BUCKETS)
    for logs in _batches(spark, sf):
        fold_state.update_state(spark, path, stage(fold_state.fold_state(logs), "fold-batch"), fold_state.tracked(families))
    return fold_state.current_fields(fold_state.read_state(spark, path), fold_state.tracked(families))


def q_populate_stored(spark, sf):
    # Logs and users stored by id.
    core, contact = _logs(spark, sf)
    kept = catalog.CatalogTables(spark, f"keyledger_{uuid.uuid4().hex[:12]}", scratch_path(spark, "stored"))
    names = {"core": core, "contact": contact, "users": _partial_users(core)}
    for name, rows in names.items():
        names[name] = stored_logs.store_by_id(rows, kept.name(name), STATE_BUCKETS, ["time"] if name != "users" else None)
    return stored_logs.populate_stored(spark, names["users"], names["core"], names["contact"])


# ------------------------------------------------------------------ index

def q_uniqueness_index(spark, sf):
    return index.index_rows(_pop(spark, sf))


def q_uniqueness_lookup(spark, sf):
    return index.lookup_rows(_pop(spark, sf))


def _staged_pops(spark, sf):
    """The current fields and the fields at ``OLD_CUT``, each folded once and
    staged (written side by side), for plans that read each of them twice."""
    s = stage_all({"fields": _pop(spark, sf), "fields-old": _pop(spark, sf, OLD_CUT)})
    return s["fields"], s["fields-old"]


def _status(spark, sf):
    pop, old = _staged_pops(spark, sf)
    return index.audit(pop, index.index_rows(old), index.lookup_rows(old))


def q_index_status(spark, sf):
    return index.status_flat(_status(spark, sf))


def q_index_status_csv(spark, sf):
    return index.status_lines(_status(spark, sf)).withColumnRenamed("value", "line")


def q_audit_few_users(spark, sf):
    # The users of the log's last day against sorted old indexes.
    base = scratch_path(spark, "sorted")
    old = stage(_pop(spark, sf, OLD_CUT), "fields-old")
    sorted_index.write_sorted(writers.upsert(None, index.index_rows(old), ["key"]), f"{base}/index", "key", 1000)
    sorted_index.write_sorted(writers.upsert(None, index.lookup_rows(old), ["id", "key"]), f"{base}/lookup", "id", 1000)
    core, _ = _logs(spark, sf)
    ms = C.timeuuid_millis(F.col("time"))
    last = core.agg(F.max(ms)).first()[0]
    recent = core.where(ms > (last or 0) - 86_400_000).select("id").distinct()
    fields = stage(_pop(spark, sf).join(recent, "id", "left_semi"), "fields")
    return index.status_flat(sorted_index.audit_few(spark, fields, f"{base}/index", f"{base}/lookup"))


def _index_upsert(pop, old):
    existing = writers.upsert(None, index.index_rows(old), ["key"])
    return writers.upsert(existing, index.index_rows(pop), ["key"])


def _lookup_upsert(pop, old):
    existing = writers.upsert(None, index.lookup_rows(old), ["id", "key"])
    return writers.upsert(existing, index.lookup_rows(pop), ["id", "key"])


def q_index_upsert(spark, sf):
    # Each snapshot is read once here: no staging needed.
    return _index_upsert(_pop(spark, sf), _pop(spark, sf, OLD_CUT))


def q_lookup_upsert(spark, sf):
    return _lookup_upsert(_pop(spark, sf), _pop(spark, sf, OLD_CUT))


def q_populate_write(spark, sf):
    pop, old = _staged_pops(spark, sf)
    a = _index_upsert(pop, old).select(F.lit("index").alias("target"), F.lit(None).cast("string").alias("id"),
                                       "key", "value")
    b = _lookup_upsert(pop, old).select(F.lit("lookup").alias("target"), "id", "key", "value")
    return a.unionByName(b)


def q_uniqueness_fields_merge(spark, sf):
    # The upserted index keeps stale keys, so owners hold several keys of a kind.
    u = index.uniqueness_fields(_index_upsert(*_staged_pops(spark, sf)), MERGE_PAGE)
    return u.select("id", "page", *[F.array_join(c, ",").alias(n) for c, n in
                            [("otherIds", "other_ids"), ("usernames", "usernames"),
                             ("verifiedPhones", "verified_phones")]])


def q_clean_key(spark, sf):
    # Values as users type them: with quotes, single and doubled.
    key = F.concat("key", F.lit("'s "), F.repeat(F.lit("'"), F.length("value") % 3))
    idx = index.index_rows(_pop(spark, sf)).select(key.alias("key"))
    return idx.select("key", C.clean_key(F.col("key")).alias("cleaned"))


# ------------------------------------------------------------------ objects, batches

def q_keyed_objects(spark, sf):
    core, _ = _logs(spark, sf)
    return objects.keyed_objects(core, content=F.col("id"))


def q_topic_batches(spark, sf):
    core, _ = _logs(spark, sf)
    m = batches.topic_messages(ids.distinct_ids(core), bucket=_batch_bucket())
    return m.select("bucket", "batch_no", "n_ids", "body")


def q_queue_batches(spark, sf):
    core, _ = _logs(spark, sf)
    return batches.queue_messages(ids.distinct_ids(core), bucket=_batch_bucket())


def q_batch_readback(spark, sf):
    core, _ = _logs(spark, sf)
    msgs = batches.queue_messages(ids.distinct_ids(core), bucket=_batch_bucket())
    path = writers.write_outbox(msgs.select("entry_id", "body"), scratch_path(spark, "outbox"), RUN_ID)
    return tables.read_message_ids(spark, path)


def q_queue_requests(spark, sf):
    core, _ = _logs(spark, sf)
    msgs = batches.queue_messages(ids.distinct_ids(core), batch_size=ENTRY_IDS, bucket=_batch_bucket(), run_id=RUN_ID)
    r = batches.queue_requests(msgs)
    return r.select("bucket", "request_no", "n_ids", F.size("entries").cast("bigint").alias("n_entries"),
                    F.array_join(F.transform("entries", lambda e: F.concat_ws(" ", e["entry_id"], e["body"])), "\n").alias("entries"))


def q_object_upsert(spark, sf):
    # Objects of the log as it stood at the cut, then of the whole log: an id's
    # object is replaced where it is put again, and the others stay.
    path = scratch_path(spark, "objects")
    for name, cut in (("old", OLD_CUT), ("new", None)):
        core, _ = _logs(spark, sf, cut)
        part = core if name == "old" else core.where(_user_num() % 2 == 0)
        writers.write_objects(objects.keyed_objects(part, content=F.concat(F.lit(f"{name}:"), F.col("id"))), path)
    return writers.read_objects(spark, path)


def q_upsert_versions(spark, sf):
    path = scratch_path(spark, "versions")
    for cut in (OLD_CUT, None):
        writers.upsert_table(spark, path, index.lookup_rows(_pop(spark, sf, cut)), ["id", "key"])
    return writers.read_latest(spark, path, schemas.UNIQUENESS_LOOKUP)


def q_upsert_touched_buckets(spark, sf):
    # B1: the old lookup in buckets, then the rows that changed.
    path = scratch_path(spark, "buckets")
    buckets.create(spark, path, schemas.UNIQUENESS_LOOKUP, ["id", "key"], STATE_BUCKETS)
    pop, old = _staged_pops(spark, sf)
    writers.upsert_table(spark, path, index.lookup_rows(old), ["id", "key"])
    new = index.lookup_rows(pop)
    writers.upsert_table(spark, path, new.join(index.lookup_rows(old), ["id", "key", "value"], "left_anti"), ["id", "key"])
    return writers.read_latest(spark, path, schemas.UNIQUENESS_LOOKUP)


# ------------------------------------------------------------------ scalar functions

def q_timeuuid_roundtrip(spark, sf):
    ev = _events(spark, sf)
    ms = C.ntz_epoch_millis(F.col("ts"))
    u = C.timeuuid_from_millis(ms, node=F.col("event_id"))
    return ev.select("event_id", ms.alias("time_ms"), u.alias("time_uuid"),
                     C.timeuuid_millis(u).alias("ms_back"))


def q_range_chunks(spark, sf):
    ev = _events(spark, sf)
    n = ev.count()  # one scalar to the driver; the chunking itself is a column
    ch = C.chunk_of(F.col("event_id"), n, 3)
    return ev.groupBy(ch.alias("chunk")).agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.min("event_id").alias("first_id"),
                                             F.max("event_id").alias("last_id"))


# ------------------------------------------------------------------ storage round trips

def q_table_roundtrip(spark, sf):
    cust = tables.read_parquet_table(spark, sf, "customer")
    kv = cust.select(F.col("c_name").alias("key"), F.col("c_nationkey").cast("int").alias("value"),
                     F.col("c_acctbal"))
    negative = F.col("c_acctbal") < 0
    path = scratch_path(spark, "kv")
    writers.write_table(kv.where(negative), path, columns=["key", "value"])         # B3 default mode, B4
    writers.append(kv.where(~negative | negative.isNull()).select("key", "value"), path)  # B2
    return spark.read.parquet(path).select("key", "value")                         # A1 read back


def q_text_roundtrip(spark, sf):
    core, _ = _logs(spark, sf)
    path = scratch_path(spark, "ids")
    writers.write_text(core.select("id"), path, "id")        # B8: cleared by the write that follows
    writers.write_text(ids.distinct_ids(core), path, "id")
    return tables.read_text_lines(spark, path, "id")


def q_epoch_roundtrip(spark, sf):
    # Time uuid -> timestamp -> epoch milliseconds -> timestamp.
    ms = C.ntz_epoch_millis(F.col("ts"))
    t = C.timeuuid_timestamp(C.timeuuid_from_millis(ms, node=F.col("event_id")))
    return _events(spark, sf).select("event_id", C.to_epoch_millis(t).alias("time_ms"),
                                     C.to_epoch_millis(C.from_epoch_millis(ms)).alias("ms_back"))


def q_catalog_tables(spark, sf):
    # A10, B12 in the session catalog: created twice, filled, one emptied and
    # filled again, read by name.
    kept = catalog.CatalogTables(spark, f"keyledger_{uuid.uuid4().hex[:12]}", scratch_path(spark, "catalog"))
    counts = None
    for family, log in zip(("core", "contact"), _logs(spark, sf), strict=True):
        name = f"{family}_events"
        kept.create(name)
        kept.append(log, name)
        kept.create(name)  # is there: its rows stay
        if family == "contact":
            kept.truncate(name)
            kept.append(log.where(F.col("id") > MOCK_ID), name)
        n = kept.read(name).groupBy("id").agg(F.count(F.lit(1)).alias("n_events")).withColumn("family", F.lit(family))
        counts = n if counts is None else counts.unionByName(n)
    return counts.select("family", "id", "n_events")


def q_registered_tables(spark, sf):
    # Event tables created empty, filled, read by logical name.
    base = scratch_path(spark, "registry")
    registry = tables.TableRegistry()
    for family, log in zip(("core", "contact"), _logs(spark, sf), strict=True):
        path = f"{base}/{family}"
        writers.create_table(spark, schemas.RAW_EVENT, path)
        writers.append(log, path)
        registry.add(tables.TableRef("identity", f"{family}_events", path))
    names = tables.from_rows(spark, [("core",), ("contact",)], schemas.T.StructType([schemas.T.StructField("family", schemas.S)]))
    counts = None
    for family in ("core", "contact"):
        n = registry.read(spark, "identity", f"{family}_events").groupBy("id").agg(F.count(F.lit(1)).alias("n_events"))
        n = n.withColumn("family", F.lit(family))
        counts = n if counts is None else counts.unionByName(n)
    return names.join(counts, "family").select("family", "id", "n_events")


def q_lenient_payloads(spark, sf):
    # S8 over a log whose payloads vary: times as numbers, decimals, exponents,
    # text and null, missing payloads (C4), events that remove and set one field
    # (K1), events of equal time (K2), empty text (K10), null scalars.
    ev = _events(spark, sf).where(F.col("event_type").isin(*eventlog.CORE_TYPES))
    core = eventlog.lenient_core_log(ev)
    return events.populate_from_logs(core, None).select("id", "otherId", "username")


def q_lenient_fields(spark, sf):
    ev = _events(spark, sf).where(F.col("event_type").isin(*eventlog.CORE_TYPES))
    p = events.parse_events(eventlog.lenient_core_log(ev), "core")
    return p.select("id", "time", "time_ms", "model", "source", "version", "snapshot")


# ------------------------------------------------------------------ jobs

def _job_dir(spark, name):
    return scratch_path(spark, f"job-{name}")


def q_job_ids_text(spark, sf):  # J1
    core, _ = _logs(spark, sf)
    return tables.read_text_lines(spark, jobs.extract_ids_to_text(core, _job_dir(spark, "ids-text")), "id")


def q_job_ids_objects(spark, sf):  # J2
    core, _ = _logs(spark, sf)
    path = _job_dir(spark, "ids-objects")
    jobs.extract_ids_to_objects(core, path)
    return writers.read_objects(spark, path).select("object_key", "content_length")


def q_job_seed_verify(spark, sf):  # J3
    core, _ = _logs(spark, sf)
    n = ids.distinct_ids(core).count()
    base = _job_dir(spark, "seed")
    r = jobs.seed_extract_verify(spark, n, f"{base}/events", f"{base}/ids", seed=42)
    back = tables.read_text_lines(spark, f"{base}/ids", "id")
    return back.select("id", F.lit(r["events"]).alias("events"), F.lit(r["ids_read_back"]).alias("ids_read_back"))


def q_live_compare(spark, sf):  # J4, F2
    core, _ = _logs(spark, sf)
    n = ids.distinct_ids(core).count()
    r = jobs.live_extraction_compare(spark, n, _job_dir(spark, "live"), max(1, n // 3), batches_during=1)
    none = r["lost"].agg(F.count(F.lit(1)).alias("lost_ids"))
    return none.select(F.lit(r["ids_first"]).cast("bigint").alias("ids_first"), "lost_ids",
                       F.lit(r["new_ids"] > 0).alias("found_new"), F.lit(r["stream_active"]).alias("stream_active"))


def _job_indexes(spark, sf, name):
    base = _job_dir(spark, name)
    core, contact = _logs(spark, sf, OLD_CUT)
    jobs.generate_index(spark, core, contact, f"{base}/index", f"{base}/lookup")
    return base


def q_job_generate_index(spark, sf):  # J5
    return writers.read_latest(spark, f"{_job_indexes(spark, sf, 'index')}/index", schemas.UNIQUENESS_INDEX)


def q_job_update_indexes(spark, sf):  # J5 on new events
    base = _job_dir(spark, "update")
    fold_state.create_state(spark, f"{base}/state", ["core", "contact"], STATE_BUCKETS)
    jobs.create_index_tables(spark, f"{base}/index", f"{base}/lookup", STATE_BUCKETS)
    ev, cut = _events(spark, sf), F.lit(OLD_CUT).cast("timestamp_ntz")
    for part in (F.col("ts") < cut, F.col("ts") >= cut):
        logs = [("core", eventlog.core_event_log(ev.where(part))), ("contact", eventlog.contact_event_log(ev.where(part)))]
        jobs.update_indexes(spark, logs, f"{base}/state", f"{base}/index", f"{base}/lookup")
    read = lambda t, schema: writers.read_latest(spark, f"{base}/{t}", schema)
    a = read("index", schemas.UNIQUENESS_INDEX).select(F.lit("index").alias("target"), F.lit(None).cast("string").alias("id"), "key", "value")
    return a.unionByName(read("lookup", schemas.UNIQUENESS_LOOKUP).select(F.lit("lookup").alias("target"), "id", "key", "value"))


def q_job_audit_no_lookup(spark, sf):  # J6 without an old lookup table: Query Exception (C13)
    base = _job_indexes(spark, sf, "audit-no-lookup")
    core, contact = _logs(spark, sf)
    out = jobs.generate_and_audit(spark, core, contact, f"{base}/index", f"{base}/absent", f"{base}/new-index",
                                  f"{base}/new-lookup", f"{base}/report")
    return tables.read_text_lines(spark, out["report"], "line")


def q_job_audit_report(spark, sf):  # J6
    base = _job_indexes(spark, sf, "audit")
    core, contact = _logs(spark, sf)
    out = jobs.generate_and_audit(spark, core, contact, f"{base}/index", f"{base}/lookup", f"{base}/new-index",
                                  f"{base}/new-lookup", f"{base}/report")
    return tables.read_text_lines(spark, out["report"], "line")


def q_job_populate_write(spark, sf):  # J7
    base = _job_indexes(spark, sf, "populate")
    core, contact = _logs(spark, sf)
    jobs.populate_and_write(spark, core, contact, f"{base}/index", f"{base}/lookup")
    return writers.read_latest(spark, f"{base}/lookup", schemas.UNIQUENESS_LOOKUP)


def q_job_send_ids(spark, sf):  # J8
    core, _ = _logs(spark, sf)
    path = _job_dir(spark, "send")
    jobs.send_ids(core, path, "a", "topic")
    jobs.send_ids(core, path, "b", "queue")  # another run: the first one's messages stay
    return tables.read_message_ids(spark, path)


def q_outbox_consumed(spark, sf):  # J8, A11: delivered by the sink, consumed as a stream
    core, _ = _logs(spark, sf)
    base = _job_dir(spark, "deliver")
    for run_id, mode in (("a", "topic"), ("b", "queue"), ("a", "topic")):  # run a is sent twice
        jobs.send_ids(core, f"{base}/outbox", run_id, mode, deliver=True)
        consume.consume(spark, f"{base}/outbox", f"{base}/ids", f"{base}/checkpoint")
    return consume.read_consumed(spark, f"{base}/ids")


def q_objects_put(spark, sf):  # B9: one object per key, put again where the key comes again
    core, _ = _logs(spark, sf)
    path = scratch_path(spark, "store")
    for name, rows in (("old", core), ("new", core.where(_user_num() % 2 == 0))):
        delivery.put_objects(objects.keyed_objects(rows, content=F.concat(F.lit(f"{name}:"), F.col("id"))), path)
    return delivery.read_delivered(spark, path)


def q_job_roundtrip(spark, sf):  # J9
    cust = tables.read_parquet_table(spark, sf, "customer")
    kv = cust.select(F.col("c_name").alias("key"), F.col("c_nationkey").cast("int").alias("value"))
    users = cust.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("firstName"),
                        F.col("c_name").alias("lastName"))
    r = jobs.connector_roundtrip(spark, kv, users, _job_dir(spark, "roundtrip"), "BUILDING")
    one = cust.agg(F.count(F.lit(1)).alias("n_customers"))
    return one.select("n_customers", *[F.lit(r[k]).cast("bigint").alias(k)
                                       for k in ("kv_count", "kv_sum", "users", "matching_first_name")])


# ------------------------------------------------------------------ generation, streaming

def q_seed_events(spark, sf):
    core, _ = _logs(spark, sf)
    return generate.seed_core_events(ids.distinct_ids(core), SEED_EVENTS, SEED_ANCHOR_MS)


def q_live_insert(spark, sf):
    core, _ = _logs(spark, sf)
    n = ids.distinct_ids(core).count()  # one scalar: the number of existing users
    per_batch = math.ceil(n / 3)
    target = scratch_path(spark, "live")
    live.insert_batches(spark, n, target + "/events", target + "/checkpoint", per_batch, 3, INSERT_START_MS)
    return live.read_inserted(spark, target + "/events").select("id", "seq_no")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "populate": q_populate,
    "populate_users": q_populate_users,
    "populate_partial": q_populate_partial,
    "populate_arrays": q_populate_arrays,
    "distinct_ids": q_distinct_ids,
    "id_counts": q_id_counts,
    "extraction_counts": q_extraction_counts,
    "extraction_diff": q_extraction_diff,
    "typed_filter": q_typed_filter,
    "relevant_core_events": q_relevant_core_events,
    "relevant_contact_events": q_relevant_contact_events,
    "parsed_payload": q_parsed_payload,
    "collected_events": q_collected_events,
    "uniqueness_index": q_uniqueness_index,
    "uniqueness_lookup": q_uniqueness_lookup,
    "index_status": q_index_status,
    "index_status_csv": q_index_status_csv,
    "index_upsert": q_index_upsert,
    "lookup_upsert": q_lookup_upsert,
    "populate_write": q_populate_write,
    "uniqueness_fields_merge": q_uniqueness_fields_merge,
    "clean_key": q_clean_key,
    "keyed_objects": q_keyed_objects,
    "topic_batches": q_topic_batches,
    "queue_batches": q_queue_batches,
    "batch_readback": q_batch_readback,
    "timeuuid_roundtrip": q_timeuuid_roundtrip,
    "range_chunks": q_range_chunks,
    "table_roundtrip": q_table_roundtrip,
    "text_roundtrip": q_text_roundtrip,
    "seed_events": q_seed_events,
    "live_insert": q_live_insert,
    "populate_only_needed": q_populate_only_needed,
    "queue_requests": q_queue_requests,
    "object_upsert": q_object_upsert,
    "upsert_versions": q_upsert_versions,
    "epoch_roundtrip": q_epoch_roundtrip,
    "registered_tables": q_registered_tables,
    "lenient_payloads": q_lenient_payloads,
    "lenient_fields": q_lenient_fields,
    "live_compare": q_live_compare,
    "job_ids_text": q_job_ids_text,
    "job_ids_objects": q_job_ids_objects,
    "job_seed_verify": q_job_seed_verify,
    "job_generate_index": q_job_generate_index,
    "job_audit_report": q_job_audit_report,
    "job_populate_write": q_job_populate_write,
    "job_send_ids": q_job_send_ids,
    "job_roundtrip": q_job_roundtrip,
    "upsert_touched_buckets": q_upsert_touched_buckets,
    "populate_incremental": q_populate_incremental,
    "job_update_indexes": q_job_update_indexes,
    "job_audit_no_lookup": q_job_audit_no_lookup,
    "open_family": q_open_family,
    "families_together": q_families_together,
    "populate_stored": q_populate_stored,
    "catalog_tables": q_catalog_tables,
    "extraction_sketches": q_extraction_sketches,
    "outbox_consumed": q_outbox_consumed,
    "objects_put": q_objects_put,
    "audit_few_users": q_audit_few_users,
}
