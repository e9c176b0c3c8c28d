"""The submitted jobs (J1-J9), each a function of a session and plain
arguments.  Event tables are passed as DataFrames of ``(id, time, payload)``
(read them with ``sources.tables.read_table`` or derive them with
``sources.eventlog``); outputs go to the paths given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyledger import schemas
from keyledger.operators import batches, events, fold_state, generate, ids, index, objects
from keyledger.session import stage, staging
from keyledger.sinks import buckets, delivery, writers
from keyledger.sources import tables
from keyledger.streaming import live_insert as live


def extract_ids_to_text(core: DataFrame, out_path: str) -> str:
    """Distinct user ids of an event table, one per line."""
    return writers.write_text(ids.distinct_ids(core), out_path, "id")


def extract_ids_to_objects(core: DataFrame, out_path: str) -> str:
    """One keyed object ``output/id/<id>`` per user id."""
    return writers.write_objects(objects.keyed_objects(core), out_path)


def seed_extract_verify(spark: SparkSession, n_users: int, table_dir: str, text_dir: str,
                        seed: int = 7, anchor_ms: int = 1_706_745_600_000) -> dict:
    """Create the event table, seed ``n_users`` users with one random
    number of events each, extract distinct ids to text, read the text back
    and count.  Returns the counts the original logs."""
    writers.create_table(spark, schemas.RAW_EVENT, table_dir, truncate=True)
    n_events = generate.events_per_user(seed)
    seeded = generate.seed_core_events(generate.mock_ids(n_users, spark), n_events, anchor_ms, seed=seed)
    writers.append(seeded, table_dir)
    core = spark.read.parquet(table_dir)
    extract_ids_to_text(core, text_dir)
    back = tables.read_text_lines(spark, text_dir, "id")
    c = ids.extraction_counts(core).collect()[0]
    n_read = back.agg(F.count_distinct("id").alias("n")).collect()[0].n
    return {"events": c.n_rows, "ids_in_table": c.n_ids, "ids_read_back": n_read, "events_per_user": n_events}


def live_extraction_compare(spark: SparkSession, n_users: int, base_dir: str, rows_per_batch: int,
                            batches_during: int = 2, seed: int = 7, trigger_seconds: float = 1.0,
                            watch=None) -> dict:
    """Seed and extract (J3), start inserting new users into the same event
    table, extract again while the inserts go on, stop them, and compare.

    The second extraction starts once ``batches_during`` batches are in and runs
    with the stream active (``watch``, if given, is called with the running query
    right after it).  ``lost`` is a frame of the ids that the first extraction
    found and the second did not (expected: none)."""
    table = f"{base_dir}/events"
    first = seed_extract_verify(spark, n_users, f"{table}/batch_id=-1", f"{base_dir}/ids-1", seed)
    live.commit_batch(spark, table, -1)
    query = live.start_live_insert(spark, n_users, table, f"{base_dir}/checkpoint", rows_per_batch,
                                   trigger_seconds=trigger_seconds)
    try:
        live.await_batches(query, batches_during)
        extract_ids_to_text(live.event_table(spark, table), f"{base_dir}/ids-2")
        active = query.isActive
        if watch is not None:
            watch(query)
    finally:
        live.stop_between_batches(query)
    one = tables.read_text_lines(spark, f"{base_dir}/ids-1", "id")
    two = tables.read_text_lines(spark, f"{base_dir}/ids-2", "id")
    n1 = one.agg(F.count_distinct("id")).collect()[0][0]
    n2 = two.agg(F.count_distinct("id")).collect()[0][0]
    return {"first": first, "ids_first": n1, "ids_second": n2, "new_ids": n2 - n1, "stream_active": active,
            "lost": ids.extraction_diff(one, two)}


def _fields(core: DataFrame, contact: DataFrame | None, on_bad: str) -> DataFrame:
    return stage(events.populate_from_logs(core, contact, on_bad), "fields")


def generate_index(spark: SparkSession, core: DataFrame, contact: DataFrame | None, index_dir: str,
                   lookup_dir: str, on_bad: str = "fail") -> dict:
    """Fold the logs into current fields, build both index tables and
    upsert them: as new versions, or where ``create_index_tables`` has laid them
    out by buckets, into the buckets touched."""
    with staging(spark):
        f = _fields(core, contact, on_bad)
        return {"index": writers.upsert_table(spark, index_dir, index.index_rows(f), ["key"]),
                "lookup": writers.upsert_table(spark, lookup_dir, index.lookup_rows(f), ["id", "key"])}


def create_index_tables(spark: SparkSession, index_dir: str, lookup_dir: str, n_buckets: int = buckets.N_BUCKETS) -> None:
    """Empty index tables of which an upsert rewrites only the buckets touched."""
    buckets.create(spark, index_dir, schemas.UNIQUENESS_INDEX, ["key"], n_buckets)
    buckets.create(spark, lookup_dir, schemas.UNIQUENESS_LOOKUP, ["id", "key"], n_buckets)


def update_indexes(spark: SparkSession, logs: list, state_dir: str, index_dir: str, lookup_dir: str,
                   members: tuple[str, ...] = ("core",), on_bad: str = "fail") -> dict:
    """J5 for new events only: fold them, merge the result into the stored fold
    state, and upsert the index rows of the users they touch.  ``logs``: (family,
    new raw events) of every family of the state (``fold_state.create_state``);
    the index tables are those of ``create_index_tables`` or versioned ones.
    Neither the log read before nor untouched buckets are read."""
    families = [family for family, _ in logs]
    fields = fold_state.tracked(families)
    with staging(spark):
        batch = stage(fold_state.fold_state(logs, members, on_bad), "fold-batch")
        touched = fold_state.update_state(spark, state_dir, batch, fields)
        state = fold_state.read_state(spark, state_dir, touched).join(batch.select("id"), "id", "left_semi")
        f = stage(fold_state.current_fields(state, fields), "fields")
        return {"state": touched, "index": writers.upsert_table(spark, index_dir, index.index_rows(f, fields), ["key"]),
                "lookup": writers.upsert_table(spark, lookup_dir, index.lookup_rows(f, fields), ["id", "key"])}


def _try_read(spark: SparkSession, table_dir: str, schema) -> DataFrame | None:
    """The newest committed version of an index table (or a bucketed table), or
    None when it cannot be read: absent, no committed version, or files whose
    schema cannot be resolved.  Its fields are then reported as ``Query Exception``
    (K15).  A data file that breaks off while it is being read still fails the job."""
    try:
        df = writers.read_latest(spark, table_dir, schema)
        if df is not None:
            df.schema  # noqa: B018 - resolve now, so an unreadable table is caught here
        return df
    except Exception:  # noqa: BLE001 - any read failure is reported per field
        return None


def generate_and_audit(spark: SparkSession, core: DataFrame, contact: DataFrame | None, old_index_dir: str,
                       old_lookup_dir: str, new_index_dir: str, new_lookup_dir: str, report_path: str,
                       on_bad: str = "fail") -> dict:
    """J5 into new tables, plus the audit of the old tables against the
    folded fields, written as ``id, status x 6`` text lines."""
    with staging(spark):
        f = _fields(core, contact, on_bad)
        old_i = _try_read(spark, old_index_dir, schemas.UNIQUENESS_INDEX)
        old_l = _try_read(spark, old_lookup_dir, schemas.UNIQUENESS_LOOKUP)
        status = index.audit(f, old_i, old_l, unique=True)  # upserted tables have one row per key
        return {"index": writers.upsert_table(spark, new_index_dir, index.index_rows(f), ["key"]),
                "lookup": writers.upsert_table(spark, new_lookup_dir, index.lookup_rows(f), ["id", "key"]),
                "report": writers.write_text(index.status_lines(status), report_path)}


def populate_and_write(spark: SparkSession, core: DataFrame, contact: DataFrame | None, index_dir: str,
                       lookup_dir: str, on_bad: str = "fail") -> dict:
    """Fold and upsert both indexes in one job (the fold is shared)."""
    return generate_index(spark, core, contact, index_dir, lookup_dir, on_bad)


def send_ids(core: DataFrame, outbox: str, run_id: str, mode: str = "queue",
             n_buckets: int = batches.N_BUCKETS, deliver: bool = False) -> str:
    """Distinct ids cut into topic messages or queue entries, written to
    the run's folder of a JSON outbox for the sender.  ``deliver``: by the outbox
    data source, once, however often the run is tried."""
    with staging(core.sparkSession):
        u = ids.distinct_ids(core)
        if mode == "topic":
            m = batches.topic_messages(u, n_buckets=n_buckets).drop("ids")
        elif mode == "queue":
            m = batches.queue_messages(u, n_buckets=n_buckets, run_id=run_id)
        else:
            raise ValueError("mode is 'topic' or 'queue'")
        return delivery.deliver(m, outbox, run_id) if deliver else writers.write_outbox(m, outbox, run_id)


def connector_roundtrip(spark: SparkSession, kv: DataFrame, users: DataFrame, base_dir: str,
                        first_name: str) -> dict:
    """Save key/value rows (chosen columns) and users (default mode),
    load them back, count, sum and filter."""
    writers.write_table(kv, f"{base_dir}/kv", columns=["key", "value"])
    writers.write_table(users, f"{base_dir}/user")
    k = spark.read.parquet(f"{base_dir}/kv")
    u = spark.read.parquet(f"{base_dir}/user")
    agg = k.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")).collect()[0]
    return {"kv_count": agg.n, "kv_sum": agg.s, "users": u.count(),
            "matching_first_name": u.where(F.col("firstName") == first_name).count()}

