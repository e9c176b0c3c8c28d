import json
import random

import pytest

from keyledger import schemas
from keyledger.operators import events as E
from keyledger.operators.ids import bare_fields

from conftest import payload, raw, timeuuid

NOW = 1_704_067_200_000
DAY = 86_400_000


def df(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_EVENT)


def users(spark, rows):
    return spark.createDataFrame(rows, schemas.UNIQUE_FIELDS)


def as_dict(frame):
    return {r.id: (r.otherId, r.username, r.verifiedPhone) for r in frame.collect()}


def test_t1_new_events_win(spark):
    rnd = random.Random(3)
    core, contact, ids = [], [], []
    for i in range(100):
        uid = f"mock:id:{i}"
        ids.append((uid, None, None, None))
        for k in range(rnd.randint(1, 5)):
            ms = NOW - rnd.randint(1, 1000) * DAY
            core.append(raw(uid, ms, {"otherId": "mock:old:value", "username": "mock:old:value"}, node=k))
            contact.append(raw(uid, ms, {"phone": "mock:old:value"}, node=k))
        core.append(raw(uid, NOW, {"otherId": f"mock:otherId:{i}", "username": f"mock:username:{i}"}, node=99))
        contact.append(raw(uid, NOW, {"phone": f"mock:verifiedPhone:{i}"}, node=99))
    out = as_dict(E.populate(users(spark, ids), df(spark, core), df(spark, contact)))
    assert len(out) == 100
    for i in range(100):
        assert out[f"mock:id:{i}"] == (f"mock:otherId:{i}", f"mock:username:{i}", f"mock:verifiedPhone:{i}")


def test_t2_removal_clears_all(spark):
    core = [raw("mock:id:0", NOW - DAY, {"otherId": "a", "username": "b"}),
            raw("mock:id:0", NOW, {}, ["otherId", "username"])]
    contact = [raw("mock:id:0", NOW - DAY, {"phone": "p"}), raw("mock:id:0", NOW, {}, ["phone"])]
    out = as_dict(E.populate(users(spark, [("mock:id:0", None, None, None)]), df(spark, core), df(spark, contact)))
    assert out == {"mock:id:0": (None, None, None)}
    fused = as_dict(E.populate_from_logs(df(spark, core), df(spark, contact)))
    assert fused == {"mock:id:0": (None, None, None)}


def test_n1_remove_then_set_in_one_event(spark):
    core = [raw("u", NOW, {"otherId": "x"}, ["otherId"])]
    assert as_dict(E.populate_from_logs(df(spark, core), None))["u"][0] == "x"


def test_n2_equal_payload_time_orders_by_timeuuid(spark):
    # Same payload time; the table time uuid decides (node bits make them differ).
    core = [("u", timeuuid(NOW, node=2), payload("u", NOW, {"username": "second"})),
            ("u", timeuuid(NOW, node=1), payload("u", NOW, {"username": "first"}))]
    assert as_dict(E.populate_from_logs(df(spark, core), None))["u"][1] == "second"
    # Payload time beats the table time (K2).
    core = [("u", timeuuid(NOW + 5000), payload("u", NOW, {"username": "older"})),
            ("u", timeuuid(NOW), payload("u", NOW + 1, {"username": "newer"}))]
    assert as_dict(E.populate_from_logs(df(spark, core), None))["u"][1] == "newer"


def test_n3_n4_core_events_only_when_a_core_field_is_missing(spark):
    core = [raw("a", NOW, {"otherId": "b"}), raw("c", NOW, {"otherId": "b2"})]
    u = users(spark, [("a", "a0", None, None), ("c", "c0", "n", None)])
    out = as_dict(E.populate(u, df(spark, core), None))
    assert out["a"][0] == "b"          # N3: username missing -> core events read, otherId overwritten
    assert out["c"] == ("c0", "n", None)  # N4: both present -> untouched


def test_n5_contact_events_only_when_phone_missing(spark):
    contact = [raw("a", NOW, {}, ["phone"])]
    u = users(spark, [("a", None, None, "p0")])
    assert as_dict(E.populate(u, None, df(spark, contact)))["a"][2] == "p0"


def test_n6_no_events_keeps_incoming(spark):
    u = users(spark, [("a", "x", None, None)])
    assert as_dict(E.populate(u, df(spark, [raw("zz", NOW, {"otherId": "q"})]), None))["a"] == ("x", None, None)


def test_n7_null_payload_ignored_but_user_kept(spark):
    core = [("a", timeuuid(NOW), None), raw("b", NOW, {"otherId": "o"})]
    out = as_dict(E.populate_from_logs(df(spark, core), None))
    assert out == {"a": (None, None, None), "b": ("o", None, None)}


def test_n8_malformed_payloads(spark):
    bad = [("a", timeuuid(NOW), "{not json"), raw("b", NOW, {"otherId": "o"})]
    no_set = [("a", timeuuid(NOW), '{"$rem": [], "model": "", "id": "a", "time": 1, "source": "", '
                                   '"version": 1, "snapshot": false}'), raw("b", NOW, {"otherId": "o"})]
    for rows in (bad, no_set):
        with pytest.raises(Exception):
            E.parse_events(df(spark, rows), "core").collect()
        assert [r.id for r in E.parse_events(df(spark, rows), "core", on_bad="drop").collect()] == ["b"]
        q = E.parse_events(df(spark, rows), "core", on_bad="quarantine").collect()
        assert sorted((r.id, r._bad) for r in q) == [("a", True), ("b", False)]


def test_n9_lenient_scalars(spark):
    rows = [("a", timeuuid(NOW), payload("a", "123", {"otherId": "x"})),
            ("b", timeuuid(NOW), payload(5, NOW, {"otherId": "x"})),
            ("c", timeuuid(NOW), payload("c", "x", {"otherId": "x"}, version="2", snapshot="true"))]
    got = {r.id: r for r in E.parse_events(df(spark, rows), "core").collect()}
    assert got["a"].time_ms == 123
    assert got["b"].payload_id == "5"
    assert got["c"].time_ms == 0 and got["c"].version == 2 and got["c"].snapshot is True


def test_n10_empty_string_is_a_value(spark):
    core = [raw("a", NOW - 1, {"username": "n"}), raw("a", NOW, {"username": ""})]
    assert as_dict(E.populate_from_logs(df(spark, core), None))["a"][1] == ""


def test_relevance_filters(spark):
    core = [raw("a", NOW, {"id": "a"}), raw("a", NOW + 1, {"username": "u"}), raw("a", NOW + 2, {}, ["otherId"]),
            raw("a", NOW + 3, {}, ["model"])]
    rel = E.relevant(E.parse_events(df(spark, core), "core"), "core").collect()
    assert sorted(r.time_ms for r in rel) == [NOW + 1, NOW + 2]
    contact = [raw("a", NOW, {"phone": "p"}), raw("a", NOW + 1, {}, ["phone"]), raw("a", NOW + 2, {}, [])]
    rel = E.relevant(E.parse_events(df(spark, contact), "contact"), "contact").collect()
    assert len(rel) == 2


def _sequential_fold(events, start):
    """The original algorithm: sort one user's events, apply $rem then $set."""
    state = dict(start)
    for ev in sorted(events, key=lambda e: (e[0], e[1])):
        _, _, set_, rem = ev
        for f in rem:
            if f in state:
                state[f] = None
        for f, v in set_.items():
            if v is not None and f in state:
                state[f] = v
    return state


def test_fold_matches_sequential_oracle_on_random_logs(spark):
    rnd = random.Random(11)
    rows, expect = [], {}
    for u in range(60):
        uid = f"u{u}"
        evs = []
        for k in range(rnd.randint(0, 12)):
            ms = NOW + rnd.randint(0, 20)  # many equal times: the uuid node breaks ties
            set_ = {f: rnd.choice([None, f"{f}-{u}-{k}", ""]) for f in ("otherId", "username")}
            rem = rnd.sample(["otherId", "username", "model"], rnd.randint(0, 2))
            evs.append((ms, k, {f: v for f, v in set_.items() if v is not None}, rem))
            rows.append(("" + uid, timeuuid(ms, node=k), payload(uid, ms, set_, rem)))
        rows.append((uid, timeuuid(NOW - 5, node=999), None))  # every user has at least a null-payload row
        expect[uid] = _sequential_fold(evs, {"otherId": None, "username": None})
    got = {r.id: {"otherId": r.otherId, "username": r.username}
           for r in E.populate_from_logs(df(spark, rows), None).collect()}
    assert got == expect
    via_join = as_dict(E.populate(bare_fields(spark.createDataFrame([(k,) for k in expect], "id string")),
                                  df(spark, rows), None))
    assert {k: {"otherId": v[0], "username": v[1]} for k, v in via_join.items()} == expect


def test_ordered_events_sequence(spark):
    rows = [raw("a", NOW + i, {"username": str(i)}, node=i) for i in range(50)] + \
           [raw("b", NOW + i, {"username": str(i)}, node=i) for i in range(3)]
    out = E.ordered_events(df(spark, rows), "core").collect()
    seqs = {}
    for r in out:
        seqs.setdefault(r.id, []).append((r.seq, r.time_ms))
    for k, v in seqs.items():
        v.sort()
        assert [s for s, _ in v] == list(range(1, len(v) + 1))
        assert [t for _, t in v] == sorted(t for _, t in v)


def test_only_needed_prefilter_gives_same_result(spark):
    core = [raw("a", NOW, {"otherId": "o1", "username": "n1"}), raw("b", NOW, {"otherId": "o2"}),
            raw("c", NOW, {"username": "n3"})]
    contact = [raw("a", NOW, {"phone": "p1"}), raw("b", NOW, {}, ["phone"])]
    u = users(spark, [("a", "x", "y", None), ("b", None, "nb", "pb"), ("c", None, None, None)])
    plain = as_dict(E.populate(u, df(spark, core), df(spark, contact)))
    pre = E.populate(u, df(spark, core), df(spark, contact), only_needed=True)
    assert as_dict(pre) == plain
    assert plain == {"a": ("x", "y", "p1"), "b": ("o2", "nb", "pb"), "c": (None, "n3", None)}
    assert "LeftSemi" in pre._jdf.queryExecution().optimizedPlan().toString()


def test_hot_user_fold_across_partitions(spark):
    # One user holds most of the log; its events arrive shuffled over many
    # partitions, so the fold must combine partial results correctly.
    rnd = random.Random(21)
    evs, rows = [], []
    for k in range(3000):
        ms = NOW + rnd.randint(0, 100000)
        set_ = {"otherId": f"o{k}"} if rnd.random() < 0.5 else {}
        rem = ["otherId"] if rnd.random() < 0.3 else []
        evs.append((ms, k, set_, rem))
        rows.append(("hot", timeuuid(ms, node=k), payload("hot", ms, set_, rem)))
    rows += [raw(f"cold{i}", NOW, {"username": f"u{i}"}) for i in range(50)]
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, schemas.RAW_EVENT).repartition(16)
    got = as_dict(E.populate_from_logs(frame, None))
    want = _sequential_fold(evs, {"otherId": None, "username": None})
    assert got["hot"][0] == want["otherId"] and got["hot"][1] is None
    assert got["cold7"] == (None, "u7", None) and len(got) == 51


def test_pages_fold_equals_sequential_fold(spark):
    rnd = random.Random(33)
    rows, evs = [], {}
    for u in ("hot", "b", "c"):
        n = 400 if u == "hot" else rnd.randint(0, 9)
        for k in range(n):
            ms = NOW + rnd.randint(0, 500)
            set_ = {f: f"{f}-{u}-{k}" for f in ("otherId", "username") if rnd.random() < 0.4}
            rem = rnd.sample(["otherId", "username"], rnd.randint(0, 1))
            evs.setdefault(u, []).append((ms, k, set_, rem))
            rows.append((u, timeuuid(ms, node=k), payload(u, ms, set_, rem)))
    frame = spark.createDataFrame(rows, schemas.RAW_EVENT).repartition(8)
    pages = E.event_pages(frame, "core", page_size=7)
    assert pages.agg({"page": "max"}).collect()[0][0] >= 30          # the hot user spans many pages
    assert max(len(r.events) for r in pages.collect()) <= 7            # no page is larger than asked
    u = bare_fields(spark.createDataFrame([("hot",), ("b",), ("c",), ("none",)], "id string"))
    got = {r.id: (r.otherId, r.username) for r in E.populate_from_pages(u, pages, None).collect()}
    for name in ("hot", "b", "c"):
        want = _sequential_fold(evs.get(name, []), {"otherId": None, "username": None})
        assert got[name] == (want["otherId"], want["username"]), name
    assert got["none"] == (None, None)


def test_times_and_versions_of_any_form(spark):
    forms = {"1700000000000": 1700000000000, "1700000000000.0": 1700000000000, "1.7E12": 1700000000000, "1.7e+12": 1700000000000,
             '"1700000000000"': 1700000000000, '"1700000000000.5"': 1700000000000, '"x"': 0, "null": 0, "true": 0, '""': 0, "-5.9": -5}
    rows = [(f, timeuuid(1), '{"$rem":[],"model":null,"id":"a","time":%s,"source":null,"$set":{},"version":2.0,"snapshot":null}' % f)
            for f in forms]
    got = {r.id: r for r in E.parse_events(df(spark, rows), "core").collect()}
    assert {k: r.time_ms for k, r in got.items()} == forms
    assert all((r.version, r.snapshot, r.model, r.source) == (2, False, "null", "null") for r in got.values())


def test_null_is_not_absent(spark):
    import pytest
    full = {"$rem": [], "model": "", "id": "a", "time": 1, "source": "", "$set": {}, "version": 1, "snapshot": False}
    for name in full:
        null = df(spark, [("a", timeuuid(1), json.dumps({**full, name: None}))])
        assert E.parse_events(null, "core").count() == 1, name
        absent = df(spark, [("a", timeuuid(1), json.dumps({k: v for k, v in full.items() if k != name}))])
        with pytest.raises(Exception, match="malformed event payload"):
            E.parse_events(absent, "core").collect()
        assert E.parse_events(absent, "core", "drop").count() == 0
        assert [r._bad for r in E.parse_events(absent.unionByName(null), "core", "quarantine").orderBy("_bad").collect()] == [False, True]


def test_no_log_at_all_leaves_the_users(spark):
    u = users(spark, [("a", "x", None, None)])
    assert as_dict(E.populate(u, None, None))["a"] == ("x", None, None)
    assert as_dict(E.populate_from_pages(u, None, None))["a"] == ("x", None, None)
