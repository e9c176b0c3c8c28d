"""Parsing of event payloads and the fold of `$set` / `$rem` events.

The fold answers, per user and tracked field, "which value does the last
event that touches the field leave?".  An event touches a field when its
`$set` carries the field or its `$rem` names it; inside one event the removal
comes first, so an event that removes and sets a field leaves it set.  This is
``max_by(value, order)`` over the touching events, which Spark aggregates
partially on the map side: only one row per user, field and map task crosses
the shuffle, so a user with a huge log costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyledger import schemas
from keyledger.functions.columns import timeuuid_ticks
from keyledger.functions.constants import FIELDS, FIELD_ORDER
from keyledger.operators.families import IDENTITY_FIELDS, EventFamily, TrackedField, family_of
from keyledger.operators.ranking import rank_within

_REQUIRED = ["$rem", "model", "id", "time", "source", "$set", "version", "snapshot"]


def _lenient_bool(s: Column) -> Column:
    t = F.lower(F.trim(s))
    num = s.try_cast("double")
    return F.when(t == "true", True).when(num.isNotNull(), num != 0).otherwise(False)


def _lenient_whole(s: Column, kind: str) -> Column:
    """A whole number from number or text: decimals are cut, other text is 0."""
    return F.coalesce(s.try_cast(kind), s.try_cast("decimal(38,9)").try_cast(kind), F.lit(0).cast(kind))


def parse_events(raw: DataFrame, family: str | EventFamily, on_bad: str = "fail", keep_null_payload: bool = False) -> DataFrame:
    """Raw ``(id, time, payload)`` -> typed events.

    Output columns: ``id, time, time_ms, ticks, rem, set_<prop>..., payload_id,
    model, source, version, snapshot`` and ``_bad`` when ``on_bad='quarantine'``.

    ``family``: one of the identity families by name, or any described by the
    caller (U2).  Without a declared `$set` schema the body is read as VARIANT
    and ``set_...`` holds the tracked properties as text.

    * null payloads are dropped (C4), or kept with null fields when
      ``keep_null_payload`` (user membership in the fused fold);
    * ``on_bad='fail'`` (default): malformed JSON, or an absent envelope field,
      fails the job; ``'drop'`` drops such rows; ``'quarantine'`` keeps them
      flagged in ``_bad``;
    * ``time`` / ``version`` accept numbers and numeric text, decimals are cut to
      whole numbers, other text reads as 0; ``snapshot`` accepts booleans,
      numbers and their text;
    * a field that is there but null reads as the text ``null`` (``id``,
      ``model``, ``source``), 0, false or empty.
    """
    if on_bad not in ("fail", "drop", "quarantine"):
        raise ValueError(f"on_bad must be fail, drop or quarantine, not {on_bad!r}")
    family = family_of(family)
    df = raw if keep_null_payload else raw.where(F.col("payload").isNotNull())
    opts = {"mode": "FAILFAST"} if on_bad == "fail" else {"mode": "PERMISSIVE"}
    p = F.from_json(F.col("payload"), schemas.payload_schema(family.set_schema or T.VariantType()), opts)
    # The parse sits in a one-row Generate: filters on parsed fields (the
    # check below, relevance later) cannot be pushed beneath it, so the JSON
    # is parsed once per row instead of once per field a filter reads.
    df = df.select("id", "time", "payload", F.explode(F.array(p)).alias("_p"))
    any_null = F.lit(False)
    for name in _REQUIRED:
        any_null = any_null | F.col("_p").getField(name).isNull()
    # Only a row with a null field has its keys read, to tell null from absent.
    absent = F.size(F.array_except(F.array(*[F.lit(n) for n in _REQUIRED]), F.json_object_keys("payload"))) > 0
    bad = F.when(F.col("payload").isNull(), False).when(F.col("_p").isNull(), True).when(
        any_null, F.coalesce(absent, F.lit(True))).otherwise(False)
    if on_bad == "fail":
        df = df.where(F.when(bad, F.raise_error(F.concat(F.lit("malformed event payload: "), F.col("payload"))))
                      .otherwise(F.lit(True)).cast("boolean"))
    elif on_bad == "drop":
        df = df.where(~bad)
    pp = F.col("_p")
    cols = [
        F.col("id"), F.col("time"),
        _lenient_whole(pp.getField("time"), "bigint").alias("time_ms"),
        timeuuid_ticks(F.col("time")).alias("ticks"),
        F.coalesce(pp.getField("$rem"), F.array().cast("array<string>")).alias("rem"),
    ]
    cols += _set_columns(pp.getField("$set"), family)
    cols += [
        *[F.when(F.col("payload").isNotNull(), F.coalesce(pp.getField(n), F.lit("null"))).alias(c)
          for n, c in (("id", "payload_id"), ("model", "model"), ("source", "source"))],
        _lenient_whole(pp.getField("version"), "int").alias("version"),
        _lenient_bool(pp.getField("snapshot")).alias("snapshot"),
    ]
    if on_bad == "quarantine":
        cols.append(bad.alias("_bad"))
    return df.select(*cols)


def _set_columns(body: Column, family: EventFamily) -> list[Column]:
    if family.set_schema is None:
        return [F.try_variant_get(body, f"$.{f.prop}", "string").alias(f.column) for f in family.fields]
    declared = [body.getField(f.name).alias(f"set_{f.name}") for f in family.set_schema.fields]
    deeper = []
    for f in family.fields:
        if "." in f.prop:
            at = body
            for name in f.prop.split("."):
                at = at.getField(name)
            deeper.append(at.cast("string").alias(f.column))
    return declared + deeper


def event_order() -> Column:
    """K2: total order of a user's events: payload time, uuid ticks, uuid text."""
    return F.struct(F.col("time_ms").alias("time_ms"), F.col("ticks").alias("ticks"), F.col("time").alias("time"))


def _touch(field: TrackedField) -> Column:
    removed = F.arrays_overlap(F.col("rem"), F.array(*[F.lit(n) for n in field.removed_by]))
    return F.col(field.column).isNotNull() | F.coalesce(removed, F.lit(False))


def relevant(parsed: DataFrame, family: str | EventFamily) -> DataFrame:
    """Events that set or remove at least one tracked field."""
    cond = None
    for f in family_of(family).fields:
        cond = _touch(f) if cond is None else cond | _touch(f)
    return parsed.where(cond)


def touch_rows(parsed: DataFrame, family: str | EventFamily, member: bool,
               fields: tuple[TrackedField, ...] = IDENTITY_FIELDS) -> DataFrame:
    """One row per event in the shape that several families share:
    ``id, _ord, is_member, t_<field>, v_<field>`` for every one of ``fields``."""
    mine = family_of(family).fields
    cols = [F.col("id"), event_order().alias("_ord"), F.lit(member).alias("is_member")]
    for f in fields:
        if f in mine:
            cols += [_touch(f).alias(f"t_{f.name}"), F.col(f.column).cast("string").alias(f"v_{f.name}")]
        else:
            cols += [F.lit(False).alias(f"t_{f.name}"), F.lit(None).cast("string").alias(f"v_{f.name}")]
    return parsed.select(*cols)


def _fold_aggs(fields: tuple[TrackedField, ...] = IDENTITY_FIELDS) -> list[Column]:
    aggs = []
    for f in fields:
        t = F.col(f"t_{f.name}")
        aggs.append(F.max_by(F.col(f"v_{f.name}"), F.when(t, F.col("_ord"))).alias(f"v_{f.name}"))
        aggs.append(F.max(t).alias(f"t_{f.name}"))
    return aggs


def log_rows(logs: list[tuple[str | EventFamily, DataFrame]], members: tuple[str, ...] = (), on_bad: str = "fail") -> DataFrame:
    """``touch_rows`` of several logs, one under the other.  Every row of a log
    whose family is in ``members`` makes its id a user, payload or not."""
    if not logs:
        raise ValueError("a log is needed")
    families = [family_of(f) for f, _ in logs]
    fields = tuple(f for family in families for f in family.fields)
    if len({f.name for f in fields}) < len(fields):
        raise ValueError("two families track a field of one name")
    rows = None
    for family, (_, raw) in zip(families, logs, strict=True):
        member = family.name in members
        parsed = parse_events(raw, family, on_bad, keep_null_payload=member)
        part = touch_rows(parsed if member else relevant(parsed, family), family, member, fields)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def fold_logs(logs: list[tuple[str | EventFamily, DataFrame]], members: tuple[str, ...] = (), on_bad: str = "fail") -> DataFrame:
    """E6 for any families: per id the current value of every tracked field, null
    where it was removed or never set: ``id, <field>, ...``.  One shuffle for all
    logs.  ``members``: families whose ids are the users (default: all)."""
    fields = tuple(f for family, _ in logs for f in family_of(family).fields)
    members = members or tuple(family_of(f).name for f, _ in logs)
    agg = log_rows(logs, members, on_bad).groupBy("id").agg(F.max("is_member").alias("_member"), *_fold_aggs(fields))
    return agg.where(F.col("_member")).select(
        "id", *[F.when(F.col(f"t_{f.name}"), F.col(f"v_{f.name}")).alias(f.name) for f in fields])


def fold_events(core_raw: DataFrame | None, contact_raw: DataFrame | None, on_bad: str = "fail") -> DataFrame:
    """Per user id, the folded value and a touched flag of each field:
    ``id, v_otherId, t_otherId, v_username, t_username, v_verifiedPhone,
    t_verifiedPhone``.  One shuffle for both logs."""
    parts = []
    if core_raw is None and contact_raw is None:
        raise ValueError("a core or a contact log is needed")
    if core_raw is not None:
        parts.append(touch_rows(relevant(parse_events(core_raw, "core", on_bad), "core"), "core", False))
    if contact_raw is not None:
        parts.append(touch_rows(relevant(parse_events(contact_raw, "contact", on_bad), "contact"), "contact", False))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("id").agg(*_fold_aggs())


def fill(users: DataFrame, folded: DataFrame) -> DataFrame:
    """K3-K5: core events count only for users missing otherId or username,
    contact events only for users missing verifiedPhone; an untouched field
    keeps its incoming value."""
    u = users.alias("u")
    j = u.join(folded.alias("f"), F.col("u.id") == F.col("f.id"), "left")
    need_core = F.col("u.otherId").isNull() | F.col("u.username").isNull()
    need_contact = F.col("u.verifiedPhone").isNull()
    out = [F.col("u.id").alias("id")]
    for f in FIELD_ORDER:
        need = need_core if FIELDS[f][0] == "core" else need_contact
        touched = F.coalesce(F.col(f"f.t_{f}"), F.lit(False))
        out.append(F.when(need & touched, F.col(f"f.v_{f}")).otherwise(F.col(f"u.{f}")).alias(f))
    return j.select(*out)


def populate(users: DataFrame, core_raw: DataFrame | None, contact_raw: DataFrame | None,
             on_bad: str = "fail", only_needed: bool = False) -> DataFrame:
    """Fill each user's missing fields from the event logs.

    ``users``: ``id, otherId, username, verifiedPhone`` (fields nullable).
    Every user row is kept, once per input row (C10, D2).

    ``only_needed`` (C7): first keep only the events of users that still miss
    a field of that family (a left-semi join).  Worth it when few users need
    events: AQE then broadcasts the small id set and the fold reads far less.
    """
    if core_raw is None and contact_raw is None:
        return users.select("id", *FIELD_ORDER)
    if only_needed:
        need_core = users.where(F.col("otherId").isNull() | F.col("username").isNull()).select("id")
        need_contact = users.where(F.col("verifiedPhone").isNull()).select("id")
        core_raw = None if core_raw is None else core_raw.join(need_core, "id", "left_semi")
        contact_raw = None if contact_raw is None else contact_raw.join(need_contact, "id", "left_semi")
    return fill(users, fold_events(core_raw, contact_raw, on_bad))


def populate_from_logs(core_raw: DataFrame, contact_raw: DataFrame | None, on_bad: str = "fail") -> DataFrame:
    """The users of the core log with their current fields, in one aggregate.

    Equivalent to ``populate(bare(distinct ids of core_raw), core_raw,
    contact_raw)``, but membership, both folds and the distinct are one
    shuffle: every core row (null payload included) marks its id as a user.
    """
    if contact_raw is None:
        return fold_logs([("core", core_raw)], ("core",), on_bad).withColumn("verifiedPhone", F.lit(None).cast("string"))
    return fold_logs([("core", core_raw), ("contact", contact_raw)], ("core",), on_bad)


def ordered_events(raw: DataFrame, family: str | EventFamily, on_bad: str = "fail") -> DataFrame:
    """Each user's relevant events in fold order, one row per event
    with its 1-based position ``seq`` in the user's sequence.  Computed
    without gathering a user's events in one task (see ``rank_within``)."""
    ev = relevant(parse_events(raw, family, on_bad), family)
    return rank_within(ev.select("id", "time", "time_ms", "ticks", "rem", *family_of(family).properties), ["id"], ["time_ms", "ticks", "time"])


def event_pages(raw: DataFrame, family: str | EventFamily, page_size: int = 1000, on_bad: str = "fail") -> DataFrame:
    """E7 as lists: each user's relevant events in fold order, cut into pages
    of at most ``page_size`` events: ``id, page, events`` where ``events`` is
    an array of ``struct<seq, time_ms, time, rem, set_...>`` sorted by
    ``seq``.  Positions come from ``ordered_events``, so no page, and no task,
    ever holds more than ``page_size`` events of one user."""
    ev = ordered_events(raw, family, on_bad).withColumn("page", F.expr(f"(seq - 1) div {int(page_size)}"))
    item = F.struct(F.col("seq"), F.col("time_ms"), F.col("time"), F.col("rem"),
                    *[F.col(c) for c in family_of(family).properties])
    return ev.groupBy("id", "page").agg(F.array_sort(F.collect_list(item)).alias("events"))


def fold_pages(pages: DataFrame, family: str) -> DataFrame:
    """E6 over event lists: fold each page with ``aggregate`` (in order:
    `$rem` then `$set` inside an event), giving per page and field a touched
    flag and the value left.  Output rows have the shared shape ``id, page,
    t_<field>, v_<field>`` for every tracked field."""
    mine = [f.name for f in family_of(family).fields]
    init = F.struct(*[F.lit(False).alias(f"t_{f}") for f in mine],
                    *[F.lit(None).cast("string").alias(f"v_{f}") for f in mine])

    def step(acc, e):
        ts, vs = [], []
        for f in mine:
            prop = FIELDS[f][1]
            new = e[f"set_{prop}"]
            touched = new.isNotNull() | F.coalesce(F.array_contains(e["rem"], F.lit(prop)), F.lit(False))
            ts.append((acc[f"t_{f}"] | touched).alias(f"t_{f}"))
            vs.append(F.when(new.isNotNull(), new).when(touched, F.lit(None).cast("string"))
                      .otherwise(acc[f"v_{f}"]).alias(f"v_{f}"))
        return F.struct(*ts, *vs)

    s = pages.select("id", "page", F.aggregate("events", init, step).alias("_s"))
    cols = [F.col("id"), F.col("page")]
    for f in FIELD_ORDER:
        if f in mine:
            cols += [F.col("_s")[f"t_{f}"].alias(f"t_{f}"), F.col("_s")[f"v_{f}"].alias(f"v_{f}")]
        else:
            cols += [F.lit(False).alias(f"t_{f}"), F.lit(None).cast("string").alias(f"v_{f}")]
    return s.select(*cols)


def populate_from_pages(users: DataFrame, core_pages: DataFrame | None, contact_pages: DataFrame | None) -> DataFrame:
    """E8 through the list form: fold every page, then keep per field the
    value of the last page that touched it.  Equal to ``populate``."""
    parts = [fold_pages(p, fam) for p, fam in ((core_pages, "core"), (contact_pages, "contact")) if p is not None]
    if not parts:
        return users.select("id", *FIELD_ORDER)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    aggs = []
    for f in FIELD_ORDER:
        t = F.col(f"t_{f}")
        aggs += [F.max_by(F.col(f"v_{f}"), F.when(t, F.col("page"))).alias(f"v_{f}"), F.max(t).alias(f"t_{f}")]
    return fill(users, rows.groupBy("id").agg(*aggs))
