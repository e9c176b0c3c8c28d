"""Event logs in the raw ``(id, time, payload)`` form.

``event_logs`` derives the two identity event tables (core and contact) from
a generic activity table ``events(event_id, ts, user_id, event_type, ...)``.
The derivation is a narrow projection: no shuffle, filters and the optional
time cut are pushed into the parquet scan.

Mapping (event_type -> family, `$set`, `$rem`):
  signup   -> core:    otherId = mock:otherId:(event_id % 400), username = mock:username:event_id
  purchase -> core:    username = mock:username:event_id
  error    -> core:    removes otherId (even event_id) or username (odd)
  view     -> contact: phone = mock:verifiedPhone:event_id
  click    -> contact: removes phone
The table ``time`` is a version-1 uuid of the event instant at 100 ns grain
with the event id in the node bits, so (payload time, uuid ticks, uuid text)
orders a user's events exactly as (ts, event_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyledger.functions.columns import ntz_epoch_micros, ntz_epoch_millis, timeuuid_from_micros
from keyledger.functions.constants import MOCK_ID, MOCK_OTHER_ID, MOCK_PHONE, MOCK_USERNAME
from keyledger.sources.tables import read_parquet_table

CORE_TYPES = ("signup", "purchase", "error")
CONTACT_TYPES = ("view", "click")


def _envelope(id_col: Column, ms: Column, set_struct: Column, rem: Column) -> Column:
    # The text of a struct is never null; saying so (coalesce) lets Catalyst
    # drop later `payload is not null` filters instead of serializing twice.
    return F.coalesce(F.to_json(F.struct(
        rem.alias("$rem"),
        F.lit("").alias("model"),
        id_col.alias("id"),
        ms.alias("time"),
        F.lit("").alias("source"),
        set_struct.alias("$set"),
        F.lit(1).alias("version"),
        F.lit(False).alias("snapshot"),
    )), F.lit(""))


def _base(events: DataFrame, types, before: str | None) -> DataFrame:
    df = events.where(F.col("event_type").isin(*types))
    if before is not None:
        df = df.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    # events.ts is TIMESTAMP_NTZ: read as UTC wall time, independent of the
    # session time zone.
    return df.select(
        F.concat(F.lit(MOCK_ID), F.col("user_id").cast("string")).alias("id"),
        F.col("event_id"),
        F.col("event_type"),
        ntz_epoch_millis(F.col("ts")).alias("_ms"),
        timeuuid_from_micros(ntz_epoch_micros(F.col("ts")), node=F.col("event_id")).alias("time"),
    )


def core_event_log(events: DataFrame, before: str | None = None) -> DataFrame:
    """Core identity events ``(id, time, payload)`` derived from ``events``."""
    b = _base(events, CORE_TYPES, before)
    et, eid = F.col("event_type"), F.col("event_id")
    other = F.when(et == "signup", F.concat(F.lit(MOCK_OTHER_ID), (eid % 400).cast("string")))
    user = F.when(et.isin("signup", "purchase"), F.concat(F.lit(MOCK_USERNAME), eid.cast("string")))
    rem = (F.when(et != "error", F.array().cast("array<string>"))
           .when(eid % 2 == 0, F.array(F.lit("otherId")))
           .otherwise(F.array(F.lit("username"))))
    set_struct = F.struct(F.col("id").alias("id"), other.alias("otherId"), user.alias("username"))
    return b.select("id", "time", _envelope(F.col("id"), F.col("_ms"), set_struct, rem).alias("payload"))


def contact_event_log(events: DataFrame, before: str | None = None) -> DataFrame:
    """Contact identity events ``(id, time, payload)`` derived from ``events``."""
    b = _base(events, CONTACT_TYPES, before)
    et, eid = F.col("event_type"), F.col("event_id")
    phone = F.when(et == "view", F.concat(F.lit(MOCK_PHONE), eid.cast("string")))
    rem = F.when(et == "click", F.array(F.lit("phone"))).otherwise(F.array().cast("array<string>"))
    set_struct = F.struct(phone.alias("phone"))
    return b.select("id", "time", _envelope(F.col("id"), F.col("_ms"), set_struct, rem).alias("payload"))


def event_logs(spark: SparkSession, sf_dir: str, before: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(core, contact) raw event logs of the given ``events`` table."""
    events = read_parquet_table(spark, sf_dir, "events")
    return core_event_log(events, before), contact_event_log(events, before)


def lenient_core_log(events: DataFrame) -> DataFrame:
    """A core log as loose writers leave it, derived from core-type rows of
    ``events``: payload text whose scalars vary with the event id.

    time: cut to the hour (so events tie) and written as a number, a decimal, an
    exponent, text, decimal text, null or other text; version as a number, a
    decimal or null; model and source as text or null; snapshot as a boolean, its
    text, a number or null; every eleventh payload missing.  A signup whose id
    divides by five also removes the otherId it sets; a username whose event id
    divides by thirteen is empty.
    """
    eid, et = F.col("event_id"), F.col("event_type")
    whole = F.floor(ntz_epoch_millis(F.col("ts")) / F.lit(3_600_000)).cast("bigint") * F.lit(3_600_000)
    n = whole.cast("string")
    exponent = F.concat(F.floor(whole / F.lit(1000)).cast("string"), F.lit(".0E3"))
    pick = lambda choices: F.element_at(F.array(*choices), (eid % len(choices) + 1).cast("int"))
    time = pick([n, F.concat(n, F.lit(".0")), exponent, F.concat(F.lit('"'), n, F.lit('"')),
                 F.concat(F.lit('"'), n, F.lit('.5"')), F.lit("null"), F.lit('"soon"')])
    text = F.lit("")
    other = F.when(et == "signup", F.concat(F.lit(f',"otherId":"{MOCK_OTHER_ID}'), (eid % 400).cast("string"), F.lit('"'))).otherwise(text)
    user = (F.when(~et.isin("signup", "purchase"), text).when(eid % 13 == 0, F.lit(',"username":""'))
            .otherwise(F.concat(F.lit(f',"username":"{MOCK_USERNAME}'), eid.cast("string"), F.lit('"'))))
    rem = (F.when((et == "error") & (eid % 2 == 0), F.lit('"otherId"')).when(et == "error", F.lit('"username"'))
           .when((et == "signup") & (eid % 5 == 0), F.lit('"otherId"')).otherwise(text))
    id_col = F.concat(F.lit(MOCK_ID), F.col("user_id").cast("string"))
    payload = F.concat(
        F.lit('{"$rem":['), rem, F.lit('],"model":'), pick([F.lit('"m"'), F.lit("null"), F.lit("7")]),
        F.lit(',"id":"'), id_col, F.lit('","time":'), time, F.lit(',"source":'), pick([F.lit("null"), F.lit('"s"')]),
        F.lit(',"$set":{"id":"'), id_col, F.lit('"'), other, user, F.lit('},"version":'),
        pick([F.lit("1"), F.lit("2.0"), F.lit("null"), F.lit('"3"')]), F.lit(',"snapshot":'),
        pick([F.lit("true"), F.lit('"true"'), F.lit("0"), F.lit("2"), F.lit("null")]), F.lit("}"))
    return events.select(
        id_col.alias("id"), timeuuid_from_micros(ntz_epoch_micros(F.col("ts")), node=eid).alias("time"),
        F.when(eid % 11 != 0, payload).alias("payload"))


def bio_event_log(events: DataFrame) -> DataFrame:
    """A log of a family that the library does not know (nickname and city of a
    user), derived from ``events``: its `$set` bodies are nested, carry numbers
    and properties nobody tracks, and remove under names of their own.

    view     -> nickname = event_id % 50 (a number), in every third a city
    click    -> removes the nickname (as `alias`)
    purchase -> city = mock:city:(event_id % 9)
    error    -> removes the city
    """
    eid, et = F.col("event_id"), F.col("event_type")
    id_col = F.concat(F.lit(MOCK_ID), F.col("user_id").cast("string"))
    city = F.concat(F.lit(',"address":{"zip":1,"city":"mock:city:'), (eid % 9).cast("string"), F.lit('"}'))
    body = (F.when(et == "view", F.concat(F.lit('{"nickname":'), (eid % 50).cast("string"),
                                          F.when(eid % 3 == 0, city).otherwise(F.lit("")), F.lit("}")))
            .when(et == "purchase", F.concat(F.lit('{"seen":[1,{"x":null}]'), city, F.lit("}"))).otherwise(F.lit("{}")))
    rem = F.when(et == "click", F.lit('["alias"]')).when(et == "error", F.lit('["home","x"]')).otherwise(F.lit("[]"))
    payload = F.concat(F.lit('{"$rem":'), rem, F.lit(',"model":"","id":"'), id_col, F.lit('","time":'),
                       ntz_epoch_millis(F.col("ts")).cast("string"), F.lit(',"source":"","$set":'), body,
                       F.lit(',"version":1,"snapshot":false}'))
    return events.where(et.isin("view", "click", "purchase", "error")).select(
        id_col.alias("id"), timeuuid_from_micros(ntz_epoch_micros(F.col("ts")), node=eid).alias("time"), payload.alias("payload"))
