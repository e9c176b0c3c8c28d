"""Event families described by the caller (U2): declared or VARIANT bodies, names
of removals, several families in one fold."""

import pytest
from pyspark.sql import types as T

from keyledger import schemas
from keyledger.operators import events as E
from keyledger.operators import index as X
from keyledger.operators.families import CONTACT, CORE, EventFamily, TrackedField, family_of
from keyledger.sources import eventlog

from conftest import raw

SF = "/root/testdata/sf0.001"
FIELDS = (TrackedField("lang", "locale.lang", "__U:settings:1:lang", ("locale",)),
          TrackedField("theme", "theme", "__U:settings:1:theme"))
OPEN = EventFamily("settings", FIELDS)
DECLARED = EventFamily("settings", FIELDS, T.StructType([
    T.StructField("locale", T.StructType([T.StructField("lang", T.StringType()), T.StructField("region", T.StringType())])),
    T.StructField("theme", T.StringType()), T.StructField("other", T.StringType())]))


def log(spark):
    rows = [raw("a", 1, {"locale": {"lang": "fr", "region": "FR"}, "theme": 7, "other": "x"}), raw("a", 2, {}, ["locale"], node=1),
            raw("a", 3, {"locale": {"region": "CH"}}, node=2), raw("b", 1, {"locale": {"lang": "de"}}, ["theme"]),
            raw("b", 2, {"locale": None, "theme": None}, node=1), raw("c", 1, {"unknown": [1, {"x": None}]}), raw("c", 2, {}, ["lang"], node=1)]
    return spark.createDataFrame(rows, schemas.RAW_EVENT)


@pytest.mark.parametrize("family", [OPEN, DECLARED], ids=["variant", "declared"])
def test_parse_fold_and_index(spark, family):
    parsed = {(r.id, r.time_ms): r for r in E.parse_events(log(spark), family).collect()}
    assert parsed["a", 1].set_locale_lang == "fr" and parsed["a", 1].set_theme == "7"
    assert parsed["a", 3].set_locale_lang is None
    assert E.relevant(E.parse_events(log(spark), family), family).count() == 3
    folded = E.fold_logs([(family, log(spark))])
    assert {r.id: (r.lang, r.theme) for r in folded.collect()} == {"a": (None, "7"), "b": ("de", None), "c": (None, None)}
    assert sorted(tuple(r) for r in X.index_rows(folded, family.fields).collect()) == [
        ("__U:settings:1:lang:de", "b"), ("__U:settings:1:theme:7", "a")]
    assert sorted(tuple(r) for r in X.lookup_rows(folded, family.fields).collect()) == [
        ("a", "__U:settings:1:theme", "7"), ("b", "__U:settings:1:lang", "de")]


def test_ordered_events_and_pages_of_a_family(spark):
    got = E.ordered_events(log(spark), OPEN).where("id = 'a'").orderBy("seq").collect()
    assert [(r.seq, r.set_locale_lang) for r in got] == [(1, "fr"), (2, None)]
    pages = E.event_pages(log(spark), OPEN, 1).where("id = 'a'").collect()
    assert sorted(len(p.events) for p in pages) == [1, 1]


def test_bad_payloads_of_an_open_family(spark):
    bad = spark.createDataFrame([("a", raw("a", 1)[1], "{not json"), ("b", raw("b", 1)[1], '{"$set":{}}')], schemas.RAW_EVENT)
    assert E.parse_events(bad, OPEN, on_bad="drop").count() == 0
    with pytest.raises(Exception):
        E.parse_events(bad, OPEN).collect()


def test_families_in_one_fold(spark):
    core, contact = eventlog.event_logs(spark, SF)
    one = E.fold_logs([("core", core), (CONTACT, contact), (OPEN, log(spark))], members=("core",))
    assert one.columns == ["id", "otherId", "username", "verifiedPhone", "lang", "theme"]
    want = E.populate_from_logs(core, contact)
    assert sorted(map(str, one.select(want.columns).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        E.fold_logs([(CORE, core), ("core", core)])
    with pytest.raises(KeyError):
        family_of("bio")
