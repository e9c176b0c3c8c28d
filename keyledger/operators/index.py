"""Uniqueness index: key -> owner rows, (owner, prefix) -> value rows, and the
audit of existing index tables against the folded fields.

The original audit makes up to six point reads per user.  Here it is two
equi-joins of the user's claims with the existing tables (left outer, at most
one match each: the primary-key dedup comes first), then a conditional
aggregation back to one row per input row.  AQE chooses broadcast or sort-merge by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyledger.functions.columns import (
    conflict_text, csv_line, field_of_key, key_for, prefix_of_field, value_from,
)
from keyledger.functions.constants import FIELDS, FIELD_ORDER, MISSING, PASS, QUERY_EXCEPTION
from keyledger.operators.families import IDENTITY_FIELDS, TrackedField
from keyledger.operators.ranking import rank_within
from keyledger.schemas import STATUS_COLUMNS
from keyledger.session import stage


def claims(fields: DataFrame, tracked: tuple[TrackedField, ...] = IDENTITY_FIELDS) -> DataFrame:
    """C11 / C12 core: one row per present field ``(id, field, value)``;
    absent fields give no row."""
    names = [f.name for f in tracked]
    return fields.select("id", *names).unpivot("id", names, "field", "value").where(F.col("value").isNotNull())


def _prefix(tracked: tuple[TrackedField, ...]) -> Column:
    out = F.lit(None).cast("string")
    for f in tracked:
        out = F.when(F.col("field") == f.name, F.lit(f.prefix)).otherwise(out)
    return out


def index_rows(fields: DataFrame, tracked: tuple[TrackedField, ...] = IDENTITY_FIELDS) -> DataFrame:
    """C11: ``(key, value)`` = (prefix:value, owner id).  Two users claiming
    one value give two rows; the upsert keeps one.  ``tracked``: the columns of
    ``fields`` to index, of whatever families."""
    return claims(fields, tracked).select(key_for(_prefix(tracked), F.col("value")).alias("key"), F.col("id").alias("value"))


def lookup_rows(fields: DataFrame, tracked: tuple[TrackedField, ...] = IDENTITY_FIELDS) -> DataFrame:
    """``(id, key, value)`` with the bare prefix as key."""
    return claims(fields, tracked).select("id", _prefix(tracked).alias("key"), "value")


def dedup_index(index: DataFrame) -> DataFrame:
    """One row per key (G3); among rows with equal keys the greatest value."""
    return index.groupBy("key").agg(F.max("value").alias("value"))


def _status(ok: Column, passed: Column, existing: Column, populated: Column) -> Column:
    return (F.when(~ok, F.struct(F.lit(False).alias("pass"), F.lit(QUERY_EXCEPTION).alias("reason")))
            .when(existing.isNull(), F.struct(F.lit(False).alias("pass"), F.lit(MISSING).alias("reason")))
            .when(passed, F.struct(F.lit(True).alias("pass"), F.lit(PASS).alias("reason")))
            .otherwise(F.struct(F.lit(False).alias("pass"), conflict_text(existing, populated).alias("reason"))))


def audit(fields: DataFrame, index: DataFrame | None, lookup: DataFrame | None, *, unique: bool = False) -> DataFrame:
    """Status of every present field in the existing key
    index and lookup index; ``None`` for a table that could not be read makes
    its statuses ``Query Exception`` (K15).

    Output: ``id`` and six nullable ``struct<pass, reason>`` columns, one row
    per input row, also where an id repeats (C15): what is found is brought back
    by the whole input row, so two rows with one id keep their own statuses.  A
    field the user lacks has no status (null, K16), and users without fields
    keep a row.

    Plan: the index is made unique on its key (G3) and staged, unless
    ``unique`` says it is (an upserted table); each claim then joins at most
    one row, so a value that very many users claim gives as many rows as claims,
    and since the staged scan lies directly under the join's shuffle, AQE can
    split that value over many tasks.  The lookup index is read wide, one row
    per owner with the value held under each prefix, and joined on ``id``.
    Statuses are computed at the end, where both tables' findings meet.
    """
    f = fields.select("id", *FIELD_ORDER)
    if index is not None:
        idx = (index if unique else stage(dedup_index(index), "audit-index")).select(
            F.col("key").alias("full_key"), F.col("value").alias("owner"))
        row = [F.col(c).alias(f"r_{c}") for c in FIELD_ORDER]
        c = (f.select("*", *row).unpivot(["id", *[f"r_{c}" for c in FIELD_ORDER]], FIELD_ORDER, "field", "value")
             .where(F.col("value").isNotNull())
             .withColumn("full_key", key_for(prefix_of_field(F.col("field")), F.col("value"))))
        owners = c.join(idx, "full_key", "left").groupBy(F.col("id").alias("r_id"), *[f"r_{c}" for c in FIELD_ORDER]).agg(
            *[F.max(F.when(F.col("field") == name, F.col("owner"))).alias(f"o_{name}") for name in FIELD_ORDER])
        idx_ok = F.lit(True)
    else:
        owners, idx_ok = None, F.lit(False)

    if lookup is not None:
        # One row per owner: the value held under each prefix (greatest, as
        # the primary-key dedup of the lookup table).
        held = lookup.groupBy("id").agg(
            *[F.max(F.when(F.col("key") == FIELDS[name][2], F.col("value"))).alias(f"h_{name}")
              for name in FIELD_ORDER])
        w = f.join(held, "id", "left")
        lk_ok = F.lit(True)
    else:
        w = f.select("*", *[F.lit(None).cast("string").alias(f"h_{name}") for name in FIELD_ORDER])
        lk_ok = F.lit(False)
    if owners is None:
        j = w.select("*", *[F.lit(None).cast("string").alias(f"o_{name}") for name in FIELD_ORDER])
    else:
        same = w["id"] == owners["r_id"]
        for name in FIELD_ORDER:
            same = same & w[name].eqNullSafe(owners[f"r_{name}"])
        j = w.join(owners, same, "left")
    out = [F.col("id")]
    for name in FIELD_ORDER:
        v, h, o = F.col(name), F.col(f"h_{name}"), F.col(f"o_{name}")
        present = v.isNotNull()
        out.append(F.when(present, _status(idx_ok, o == F.col("id"), o, F.col("id"))).alias(name))
        out.append(F.when(present, _status(lk_ok, h == v, h, v)).alias(name + "Lookup"))
    return j.select(*out)


def status_flat(status: DataFrame) -> DataFrame:
    """Status with each struct split into ``<col>_pass`` and ``<col>_reason``."""
    cols = [F.col("id")]
    for c in STATUS_COLUMNS:
        cols += [F.col(c)["pass"].alias(f"{c}_pass"), F.col(c)["reason"].alias(f"{c}_reason")]
    return status.select(*cols)


def status_lines(status: DataFrame) -> DataFrame:
    """``id, r1, ..., r6`` text lines, blank for absent fields."""
    return status.select(csv_line(F.col("id"), *[F.col(c)["reason"] for c in STATUS_COLUMNS]).alias("value"))


def uniqueness_fields(index: DataFrame, page_size: int = 1000) -> DataFrame:
    """Index rows ``(key, owner)`` -> per owner the values held,
    merged per id: ``id, page, otherIds, usernames, verifiedPhones``.

    Stale keys stay in the index (K12), so an owner's list only grows; it is cut
    into pages of at most ``page_size`` keys in key order, and no row gathers
    more.  Values keep the text after the last colon of the key, as the
    original does; each list is sorted so the result repeats."""
    k = rank_within(index.select(F.col("value").alias("id"), "key"), ["id"], ["key"])
    k = k.select("id", F.expr(f"(seq - 1) div {int(page_size)}").alias("page"), field_of_key(F.col("key")).alias("field"),
                 value_from(F.col("key")).alias("v"))
    aggs = []
    for f, name in zip(FIELD_ORDER, ["otherIds", "usernames", "verifiedPhones"]):
        aggs.append(F.array_sort(F.collect_list(F.when(F.col("field") == f, F.col("v")))).alias(name))
    return k.groupBy("id", "page").agg(*aggs)
