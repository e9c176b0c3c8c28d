"""DuckDB SQL for each registered query, over the pre-registered views of the
given tables.  Column names equal those of the Spark queries."""

from __future__ import annotations

from keyledger.functions.constants import FIELDS, FIELD_ORDER, UUID_EPOCH_OFFSET
from keyledger.plans.queries import (
    BATCH_BUCKETS, ENTRY_IDS, MERGE_PAGE, MOCK_OLD, OLD_CUT, RUN_ID, SEED_ANCHOR_MS, SEED_EVENTS,
)

CORE = "('signup','purchase','error')"


def _fold(cut: str | None) -> str:
    """Per user_id the last touching event's value of each field, wrapped in a
    struct so that 'removed' (struct with null) differs from 'untouched' (null)."""
    where = f"WHERE ts < TIMESTAMP '{cut}'" if cut else ""
    return f"""SELECT user_id,
  max_by(struct_pack(v := CASE WHEN event_type='signup' THEN 'mock:otherId:'||(event_id%400) END), (ts,event_id))
    FILTER (event_type='signup' OR (event_type='error' AND event_id%2=0)) AS o,
  max_by(struct_pack(v := CASE WHEN event_type IN ('signup','purchase') THEN 'mock:username:'||event_id END), (ts,event_id))
    FILTER (event_type IN ('signup','purchase') OR (event_type='error' AND event_id%2=1)) AS n,
  max_by(struct_pack(v := CASE WHEN event_type='view' THEN 'mock:verifiedPhone:'||event_id END), (ts,event_id))
    FILTER (event_type IN ('view','click')) AS p
  FROM events {where} GROUP BY 1"""


def _users(cut: str | None) -> str:
    extra = f" AND ts < TIMESTAMP '{cut}'" if cut else ""
    return f"SELECT DISTINCT user_id FROM events WHERE event_type IN {CORE}{extra}"


def _pop(cut: str | None = None) -> str:
    """(id, otherId, username, verifiedPhone) of every core-log user."""
    return f"""SELECT 'mock:id:'||u.user_id AS id, f.o.v AS "otherId", f.n.v AS username, f.p.v AS "verifiedPhone"
  FROM ({_users(cut)}) u LEFT JOIN ({_fold(cut)}) f USING (user_id)"""


def _index(pop: str) -> str:
    parts = []
    for field in FIELD_ORDER:
        prefix = FIELDS[field][2]
        parts.append(f"""SELECT '{prefix}:'||"{field}" AS key, id AS value FROM ({pop}) WHERE "{field}" IS NOT NULL""")
    return " UNION ALL ".join(parts)


def _lookup(pop: str) -> str:
    parts = []
    for field in FIELD_ORDER:
        prefix = FIELDS[field][2]
        parts.append(f"""SELECT id, '{prefix}' AS key, "{field}" AS value FROM ({pop}) WHERE "{field}" IS NOT NULL""")
    return " UNION ALL ".join(parts)


def _dedup_index(rows: str) -> str:
    return f"SELECT key, max(value) AS value FROM ({rows}) GROUP BY key"


def _dedup_lookup(rows: str) -> str:
    return f"SELECT id, key, max(value) AS value FROM ({rows}) GROUP BY id, key"


def _status_sql() -> str:
    new, old = _pop(), _pop(OLD_CUT)
    joins, cols = [], ["p.id AS id"]
    for i, field in enumerate(FIELD_ORDER):
        prefix = FIELDS[field][2]
        joins.append(f"LEFT JOIN oi k{i} ON k{i}.key = '{prefix}:'||p.\"{field}\"")
        joins.append(f"LEFT JOIN ol l{i} ON l{i}.id = p.id AND l{i}.key = '{prefix}'")
        v = f'p."{field}"'
        for suffix, ex, populated, same in [("", f"k{i}.value", "p.id", f"k{i}.value = p.id"),
                                            ("Lookup", f"l{i}.value", v, f"l{i}.value = {v}")]:
            name = field + suffix
            cols.append(f"CASE WHEN {v} IS NULL THEN NULL WHEN {ex} IS NULL THEN false WHEN {same} THEN true "
                        f"ELSE false END AS \"{name}_pass\"")
            cols.append(f"CASE WHEN {v} IS NULL THEN NULL WHEN {ex} IS NULL THEN 'Missing' WHEN {same} THEN 'Pass' "
                        f"ELSE 'Conflict: existing [' || {ex} || '] populated [' || {populated} || ']' END "
                        f"AS \"{name}_reason\"")
    return f"""WITH p AS ({new}), oi AS ({_dedup_index(_index(old))}), ol AS ({_dedup_lookup(_lookup(old))})
SELECT {', '.join(cols)} FROM p {' '.join(joins)}"""


def _status_csv_sql() -> str:
    reasons = [f'coalesce("{f}{s}_reason", \'\')' for f in FIELD_ORDER for s in ("", "Lookup")]
    return f"SELECT concat_ws(', ', id, {', '.join(reasons)}) AS line FROM ({_status_sql()})"


def _upsert_index_sql() -> str:
    return f"""WITH inc AS ({_dedup_index(_index(_pop()))}), old AS ({_dedup_index(_index(_pop(OLD_CUT)))})
SELECT key, value FROM old WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.key = old.key)
UNION ALL SELECT key, value FROM inc"""


def _upsert_lookup_sql() -> str:
    return f"""WITH inc AS ({_dedup_lookup(_lookup(_pop()))}), old AS ({_dedup_lookup(_lookup(_pop(OLD_CUT)))})
SELECT id, key, value FROM old WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.id = old.id AND inc.key = old.key)
UNION ALL SELECT id, key, value FROM inc"""


def _partial_sql() -> str:
    init = f"""SELECT user_id,
  CASE WHEN user_id % 3 = 0 THEN '{MOCK_OLD}' END AS io,
  CASE WHEN user_id % 5 = 0 THEN '{MOCK_OLD}' END AS iname,
  CASE WHEN user_id % 2 = 0 THEN '{MOCK_OLD}' END AS iphone
  FROM ({_users(None)})"""
    return f"""SELECT 'mock:id:'||u.user_id AS id,
  CASE WHEN (io IS NULL OR iname IS NULL) AND f.o IS NOT NULL THEN f.o.v ELSE io END AS "otherId",
  CASE WHEN (io IS NULL OR iname IS NULL) AND f.n IS NOT NULL THEN f.n.v ELSE iname END AS username,
  CASE WHEN iphone IS NULL AND f.p IS NOT NULL THEN f.p.v ELSE iphone END AS "verifiedPhone"
  FROM ({init}) u LEFT JOIN ({_fold(None)}) f USING (user_id)"""


def _merge_sql() -> str:
    k = f"""SELECT value AS id, (row_number() OVER (PARTITION BY value ORDER BY key) - 1) // {MERGE_PAGE} AS page,
  CASE WHEN contains(key, '{FIELDS['otherId'][2]}') THEN 'otherId'
       WHEN contains(key, '{FIELDS['username'][2]}') THEN 'username'
       WHEN contains(key, '{FIELDS['verifiedPhone'][2]}') THEN 'verifiedPhone' END AS field,
  split_part(key, ':', -1) AS v FROM ({_upsert_index_sql()})"""
    aggs = [f"coalesce(string_agg(v, ',' ORDER BY v) FILTER (WHERE field = '{f}'), '') AS {n}"
            for f, n in [("otherId", "other_ids"), ("username", "usernames"), ("verifiedPhone", "verified_phones")]]
    return f"SELECT id, page, {', '.join(aggs)} FROM ({k}) GROUP BY id, page"


def _batches(per_request: bool) -> str:
    r = f"""SELECT user_id % {BATCH_BUCKETS} AS bucket, 'mock:id:'||user_id AS id,
  row_number() OVER (PARTITION BY user_id % {BATCH_BUCKETS} ORDER BY 'mock:id:'||user_id) AS seq
  FROM ({_users(None)})"""
    g = f"""SELECT bucket, (seq - 1) // 50 AS batch_no, count(*) AS n_ids,
  '[' || string_agg('"' || id || '"', ',' ORDER BY seq) || ']' AS body FROM ({r}) GROUP BY 1, 2"""
    if not per_request:
        return g
    return f"""SELECT bucket, batch_no // 10 AS request_no, batch_no AS entry_no,
  CAST(bucket AS VARCHAR) || '-' || CAST(batch_no AS VARCHAR) AS entry_id, n_ids, body FROM ({g})"""


def _requests_sql() -> str:
    h = f"md5(concat_ws('|', '{RUN_ID}', bucket, entry_no))"
    entry_id = f"concat_ws('-', {h}[1:8], {h}[9:12], {h}[13:16], {h}[17:20], {h}[21:32])"
    r = f"""SELECT user_id % {BATCH_BUCKETS} AS bucket, 'mock:id:'||user_id AS id,
  row_number() OVER (PARTITION BY user_id % {BATCH_BUCKETS} ORDER BY 'mock:id:'||user_id) AS seq
  FROM ({_users(None)})"""
    e = f"""SELECT bucket, (seq - 1) // {ENTRY_IDS} AS entry_no, count(*) AS n,
  '[' || string_agg('"' || id || '"', ',' ORDER BY seq) || ']' AS body FROM ({r}) GROUP BY 1, 2"""
    return f"""SELECT bucket, entry_no // 10 AS request_no, sum(n)::BIGINT AS n_ids, count(*) AS n_entries,
  string_agg({entry_id} || ' ' || body, chr(10) ORDER BY entry_no) AS entries FROM ({e}) GROUP BY 1, 2"""


def _seed_sql(users: str, n_events: int, seed: int) -> str:
    day = f"(('0x' || md5(concat_ws('|', '{seed}', id, n))[1:8])::BIGINT % 100 + 1)"
    t = f"(ms * 10000 + {UUID_EPOCH_OFFSET})"
    return f"""SELECT id, printf('%08x-%04x-%04x-%04x-%012x', {t} & 4294967295, ({t} >> 32) & 65535,
  (({t} >> 48) & 4095) | 4096, (('0x' || md5(id)[1:4])::BIGINT & 16383) | 32768, n) AS time,
  '{{"$rem":[],"model":"","id":"' || id || '","time":' || ms || ',"source":"","$set":{{"id":"' || id ||
  '"}},"version":1,"snapshot":false}}' AS payload
  FROM (SELECT id, n, {SEED_ANCHOR_MS} - {day} * 86400000 AS ms
        FROM ({users}), (SELECT unnest(range({n_events})) AS n))"""


def _lenient(cols: str) -> str:
    """The loose core log's rows: the values its payloads stand for."""
    return f"""SELECT {cols} FROM (SELECT *, CASE event_id % 7 WHEN 5 THEN 0 WHEN 6 THEN 0
    ELSE (epoch_us(ts) // 1000) // 3600000 * 3600000 END AS time_ms
  FROM events WHERE event_type IN {CORE} AND event_id % 11 <> 0)"""


def _lenient_fold_sql() -> str:
    order = "(time_ms, ts, event_id)"
    fold = f"""SELECT user_id,
  max_by(struct_pack(v := CASE WHEN event_type='signup' THEN 'mock:otherId:'||(event_id%400) END), {order})
    FILTER (event_type='signup' OR (event_type='error' AND event_id%2=0)) AS o,
  max_by(struct_pack(v := CASE WHEN event_type IN ('signup','purchase') THEN
    CASE WHEN event_id % 13 = 0 THEN '' ELSE 'mock:username:'||event_id END END), {order})
    FILTER (event_type IN ('signup','purchase') OR (event_type='error' AND event_id%2=1)) AS n
  FROM ({_lenient('*')}) GROUP BY 1"""
    return f"""SELECT 'mock:id:'||u.user_id AS id, f.o.v AS "otherId", f.n.v AS username
  FROM ({_users(None)}) u LEFT JOIN ({fold}) f USING (user_id)"""


def _lenient_fields_sql() -> str:
    t = f"(epoch_us(ts) * 10 + {UUID_EPOCH_OFFSET})"
    return _lenient(f"""'mock:id:'||user_id AS id,
  printf('%08x-%04x-%04x-%04x-%012x', {t} & 4294967295, ({t} >> 32) & 65535, (({t} >> 48) & 4095) | 4096, 32768, event_id) AS time,
  time_ms, ['m', 'null', '7'][event_id % 3 + 1] AS model, ['null', 's'][event_id % 2 + 1] AS source,
  [1, 2, 0, 3][event_id % 4 + 1] AS version, [true, true, false, true, false][event_id % 5 + 1] AS snapshot""")


def _objects_sql() -> str:
    ids = f"SELECT DISTINCT user_id, 'mock:id:'||user_id AS id FROM events WHERE event_type IN {CORE}"
    content = "content AS content, base64(unhex(md5(content))) AS content_md5, strlen(content) AS content_length"
    return f"""WITH new AS ({ids} AND user_id % 2 = 0), old AS ({ids} AND ts < TIMESTAMP '{OLD_CUT}')
SELECT 'output/id/' || id AS object_key, {content} FROM (
  SELECT id, 'new:' || id AS content FROM new
  UNION ALL SELECT id, 'old:' || id FROM old WHERE id NOT IN (SELECT id FROM new))"""


def _timeuuid_sql() -> str:
    t = f"((epoch_us(ts) // 1000) * 10000 + {UUID_EPOCH_OFFSET})"
    return f"""SELECT event_id, (epoch_us(ts) // 1000) AS time_ms,
  printf('%08x-%04x-%04x-%04x-%012x', {t} & 4294967295, ({t} >> 32) & 65535,
         (({t} >> 48) & 4095) | 4096, 32768, event_id) AS time_uuid,
  (epoch_us(ts) // 1000) AS ms_back FROM events"""


def _bio() -> str:
    """(user_id, nickname, city) as structs: null where no event touches the field."""
    return """SELECT user_id,
  max_by(struct_pack(v := CASE WHEN event_type='view' THEN (event_id % 50)::VARCHAR END), (ts,event_id))
    FILTER (event_type IN ('view','click')) AS n,
  max_by(struct_pack(v := CASE WHEN event_type IN ('view','purchase') THEN 'mock:city:'||(event_id%9) END), (ts,event_id))
    FILTER (event_type IN ('purchase','error') OR (event_type='view' AND event_id%3=0)) AS c
  FROM events WHERE event_type IN ('view','click','purchase','error') GROUP BY 1"""


def _update_sql() -> str:
    """The indexes after the old log's rows and then those of the users with newer events."""
    new = f"""SELECT * FROM ({_pop()}) WHERE id IN (SELECT 'mock:id:'||user_id FROM events
  WHERE ts >= TIMESTAMP '{OLD_CUT}' AND event_type IN ('signup','purchase','error','view','click'))"""
    return f"""WITH ni AS ({_dedup_index(_index(new))}), oi AS ({_dedup_index(_index(_pop(OLD_CUT)))}),
  nl AS ({_dedup_lookup(_lookup(new))}), ol AS ({_dedup_lookup(_lookup(_pop(OLD_CUT)))})
SELECT 'index' AS target, CAST(NULL AS VARCHAR) AS id, key, value FROM (
  SELECT * FROM ni UNION ALL SELECT * FROM oi WHERE key NOT IN (SELECT key FROM ni))
UNION ALL SELECT 'lookup', id, key, value FROM (
  SELECT * FROM nl UNION ALL SELECT * FROM ol WHERE NOT EXISTS (SELECT 1 FROM nl WHERE nl.id = ol.id AND nl.key = ol.key))"""


def _no_lookup_sql() -> str:
    reasons = []
    for f in FIELD_ORDER:
        reasons += [f'coalesce("{f}_reason", \'\')', f'CASE WHEN "{f}_reason" IS NULL THEN \'\' ELSE \'Query Exception\' END']
    return f"SELECT concat_ws(', ', id, {', '.join(reasons)}) AS line FROM ({_status_sql()})"


def _core(cols: str) -> str:
    return f"SELECT {cols} FROM events WHERE event_type IN {CORE}"


ORACLE_SQL: dict[str, str] = {
    "populate": _pop(),
    "populate_users": _pop(),
    "populate_arrays": _pop(),
    "populate_partial": _partial_sql(),
    "distinct_ids": _core("DISTINCT 'mock:id:'||user_id AS id"),
    "id_counts": _core("'mock:id:'||user_id AS id, count(*) AS n") + " GROUP BY 1",
    "extraction_counts": _core("count(*) AS n_rows, count(DISTINCT user_id) AS n_ids, "
                               "CAST(sum((epoch_us(ts) // 1000)) AS BIGINT) AS sum_value, "
                               "count(*) - count(DISTINCT user_id) AS n_repeated"),
    "extraction_diff": f"""WITH a AS (SELECT DISTINCT 'mock:id:'||user_id AS id, (epoch_us(ts) // 1000) // 86400000 AS day
  FROM events WHERE event_type IN {CORE})
SELECT id, day FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.id = a.id AND b.day = a.day + 1)""",
    "typed_filter": "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'HOUSEHOLD'",
    "relevant_core_events": _core(
        "'mock:id:'||user_id AS id, (epoch_us(ts) // 1000) AS time_ms, "
        "CASE WHEN event_type='signup' THEN 'mock:otherId:'||(event_id%400) END AS \"set_otherId\", "
        "CASE WHEN event_type IN ('signup','purchase') THEN 'mock:username:'||event_id END AS set_username, "
        "(event_type='error' AND event_id%2=0) AS \"rem_otherId\", "
        "(event_type='error' AND event_id%2=1) AS rem_username"),
    "relevant_contact_events": """SELECT 'mock:id:'||user_id AS id, (epoch_us(ts) // 1000) AS time_ms,
  CASE WHEN event_type='view' THEN 'mock:verifiedPhone:'||event_id END AS set_phone,
  (event_type='click') AS rem_phone FROM events WHERE event_type IN ('view','click')""",
    "parsed_payload": f"""SELECT CASE WHEN event_type IN {CORE} THEN 'core' ELSE 'contact' END AS family,
  'mock:id:'||user_id AS id, 'mock:id:'||user_id AS payload_id, (epoch_us(ts) // 1000) AS time_ms, '' AS model, '' AS source,
  1 AS version, false AS snapshot,
  CAST(CASE WHEN event_type IN ('error','click') THEN 1 ELSE 0 END AS BIGINT) AS n_rem
  FROM events WHERE event_type IN ('signup','purchase','error','view','click')""",
    "collected_events": _core("'mock:id:'||user_id AS id, "
                              "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, "
                              "(epoch_us(ts) // 1000) AS time_ms"),
    "uniqueness_index": _index(_pop()),
    "uniqueness_lookup": _lookup(_pop()),
    "index_status": _status_sql(),
    "index_status_csv": _status_csv_sql(),
    "index_upsert": _upsert_index_sql(),
    "lookup_upsert": _upsert_lookup_sql(),
    "populate_write": f"""SELECT 'index' AS target, CAST(NULL AS VARCHAR) AS id, key, value FROM ({_upsert_index_sql()})
UNION ALL SELECT 'lookup' AS target, id, key, value FROM ({_upsert_lookup_sql()})""",
    "uniqueness_fields_merge": _merge_sql(),
    "clean_key": f"""SELECT key, replace(key, '''', '''''') AS cleaned
  FROM (SELECT key || '''s ' || repeat('''', length(value) % 3) AS key FROM ({_index(_pop())}))""",
    "keyed_objects": _core("'output/id/mock:id:'||user_id AS object_key, max('mock:id:'||user_id) AS content, "
                           "base64(unhex(md5(max('mock:id:'||user_id)))) AS content_md5, "
                           "strlen(max('mock:id:'||user_id)) AS content_length") + " GROUP BY 1",
    "topic_batches": _batches(False),
    "queue_batches": _batches(True),
    "batch_readback": _core("DISTINCT 'mock:id:'||user_id AS id"),
    "timeuuid_roundtrip": _timeuuid_sql(),
    "range_chunks": """WITH c AS (SELECT count(*) AS n FROM events)
SELECT least(event_id // greatest(c.n // 3, 1), 2) AS chunk, count(*) AS n_rows,
  min(event_id) AS first_id, max(event_id) AS last_id FROM events, c GROUP BY 1""",
    "table_roundtrip": "SELECT c_name AS key, CAST(c_nationkey AS INTEGER) AS value FROM customer",
    "text_roundtrip": _core("DISTINCT 'mock:id:'||user_id AS id"),
    "live_insert": f"""WITH c AS (SELECT count(DISTINCT user_id) AS n FROM events WHERE event_type IN {CORE})
SELECT 'mock:id:' || (n + v % n) AS id, v AS seq_no FROM (SELECT n, unnest(range(3 * ((n + 2) // 3))) AS v FROM c)""",
    "populate_only_needed": _partial_sql(),
    "queue_requests": _requests_sql(),
    "object_upsert": _objects_sql(),
    "upsert_versions": _upsert_lookup_sql(),
    "epoch_roundtrip": "SELECT event_id, epoch_us(ts) // 1000 AS time_ms, epoch_us(ts) // 1000 AS ms_back FROM events",
    "registered_tables": f"""SELECT CASE WHEN event_type IN {CORE} THEN 'core' ELSE 'contact' END AS family,
  'mock:id:'||user_id AS id, count(*) AS n_events
  FROM events WHERE event_type IN ('signup','purchase','error','view','click') GROUP BY 1, 2""",
    "lenient_payloads": _lenient_fold_sql(),
    "lenient_fields": _lenient_fields_sql(),
    "seed_events": _seed_sql(_core("DISTINCT 'mock:id:'||user_id AS id"), SEED_EVENTS, 17),
    "live_compare": f"SELECT count(DISTINCT user_id) AS ids_first, 0::BIGINT AS lost_ids, true AS found_new, "
                    f"true AS stream_active FROM events WHERE event_type IN {CORE}",
    "job_ids_text": _core("DISTINCT 'mock:id:'||user_id AS id"),
    "job_ids_objects": _core("DISTINCT 'output/id/mock:id:'||user_id AS object_key, 0::BIGINT AS content_length"),
    "job_seed_verify": f"""WITH c AS (SELECT count(DISTINCT user_id) AS n FROM events WHERE event_type IN {CORE})
SELECT 'mock:id:' || unnest(range(n)) AS id, (n * {SEED_EVENTS})::INT AS events, n::INT AS ids_read_back FROM c""",
    "job_generate_index": _dedup_index(_index(_pop(OLD_CUT))),
    "job_audit_report": _status_csv_sql(),
    "job_populate_write": _upsert_lookup_sql(),
    "job_send_ids": f"SELECT id FROM ({_core("DISTINCT 'mock:id:'||user_id AS id")}), (SELECT unnest([1, 2]))",
    "job_roundtrip": """SELECT count(*) AS n_customers, count(*) AS kv_count, sum(c_nationkey)::BIGINT AS kv_sum,
  count(*) AS users, count(*) FILTER (c_mktsegment = 'BUILDING') AS matching_first_name FROM customer""",
    "upsert_touched_buckets": _upsert_lookup_sql(),
    "populate_incremental": _pop(),
    "job_update_indexes": _update_sql(),
    "job_audit_no_lookup": _no_lookup_sql(),
    "open_family": f"""SELECT '__U:bio:1:nickname:'||n.v AS key, 'mock:id:'||user_id AS value FROM ({_bio()}) WHERE n.v IS NOT NULL
UNION ALL SELECT '__U:bio:1:city:'||c.v, 'mock:id:'||user_id FROM ({_bio()}) WHERE c.v IS NOT NULL""",
    "families_together": f"""SELECT p.*, b.n.v AS nickname, b.c.v AS city FROM ({_pop()}) p
  LEFT JOIN ({_bio()}) b ON p.id = 'mock:id:'||b.user_id""",
    "populate_stored": _partial_sql(),
    "catalog_tables": f"""SELECT CASE WHEN event_type IN {CORE} THEN 'core' ELSE 'contact' END AS family,
  'mock:id:'||user_id AS id, count(*) AS n_events
  FROM events WHERE event_type IN ('signup','purchase','error','view','click') GROUP BY 1, 2""",
    "extraction_sketches": f"""WITH e AS (SELECT user_id, (epoch_us(ts) // 1000) // 86400000 AS day FROM events WHERE event_type IN {CORE}),
  d AS (SELECT day, count(*) AS n FROM e GROUP BY 1)
SELECT d.day, (SELECT sum(x.n) FROM d x WHERE x.day <= d.day)::BIGINT AS n_rows,
  (SELECT count(DISTINCT e.user_id) FROM e WHERE e.day <= d.day) AS n_ids, true AS near FROM d""",
    "outbox_consumed": f"SELECT run, id FROM ({_core("DISTINCT 'mock:id:'||user_id AS id")}), (SELECT unnest(['a', 'b']) AS run)",
    "objects_put": f"""SELECT 'output/id/mock:id:'||user_id AS object_key,
  CASE WHEN user_id % 2 = 0 THEN 'new:' ELSE 'old:' END || 'mock:id:' || user_id AS content
  FROM (SELECT DISTINCT user_id FROM events WHERE event_type IN {CORE})""",
    "audit_few_users": f"""SELECT * FROM ({_status_sql()}) WHERE id IN (
  SELECT 'mock:id:'||user_id FROM events WHERE event_type IN {CORE} AND epoch_us(ts) // 1000 >
    (SELECT max(epoch_us(ts) // 1000) FROM events WHERE event_type IN {CORE}) - 86400000)""",
}
