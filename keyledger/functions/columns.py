"""Scalar column functions: time uuids, index keys, report text, checksums.

All are compositions of built-in expressions, so they stay inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyledger.functions.constants import (
    CONFLICT_FORMAT, FIELDS, FIELD_ORDER, OBJECT_KEY_PREFIX, UUID_EPOCH_OFFSET,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time uuids

def timeuuid_ticks(u) -> Column:
    """100 ns ticks since 1582-10-15 of a version-1 uuid text; null if the
    text is not a version-1 uuid."""
    u = F.lower(_c(u))
    hexs = F.concat(F.substring(u, 16, 3), F.substring(u, 10, 4), F.substring(u, 1, 8))
    ticks = F.conv(hexs, 16, 10).cast("bigint")
    ok = (F.length(u) == 36) & (F.substring(u, 15, 1) == F.lit("1"))
    return F.when(ok, ticks)


def timeuuid_millis(u) -> Column:
    """Epoch milliseconds of a version-1 uuid (floor division)."""
    # Ticks exceed 2^53, so the division is done in exact decimal arithmetic.
    since_epoch = (timeuuid_ticks(u) - F.lit(UUID_EPOCH_OFFSET)).cast("decimal(20,0)")
    return F.floor(since_epoch / F.lit(10000)).cast("bigint")


def timeuuid_timestamp(u) -> Column:
    """Timestamp of a version-1 uuid, millisecond grain."""
    return F.timestamp_millis(timeuuid_millis(u))


def timeuuid_from_ticks(ticks, node=None, clock_seq=None) -> Column:
    """Version-1 uuid text from 100 ns ticks since the uuid epoch.

    ``node`` (48 bits) and ``clock_seq`` (14 bits) default to zero, so the
    same instant always gives the same text and runs repeat."""
    t = _c(ticks).cast("bigint")
    node = F.lit(0) if node is None else _c(node)
    clock_seq = F.lit(0) if clock_seq is None else _c(clock_seq)
    return F.format_string(
        "%08x-%04x-%04x-%04x-%012x",
        t.bitwiseAND(F.lit(0xFFFFFFFF)),
        F.shiftright(t, 32).bitwiseAND(F.lit(0xFFFF)),
        F.shiftright(t, 48).bitwiseAND(F.lit(0x0FFF)).bitwiseOR(F.lit(0x1000)),
        clock_seq.cast("bigint").bitwiseAND(F.lit(0x3FFF)).bitwiseOR(F.lit(0x8000)),
        node.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFFFFFF)),
    )


def timeuuid_from_millis(ms, node=None, clock_seq=None) -> Column:
    """S3: version-1 uuid text of an epoch-millisecond instant."""
    return timeuuid_from_ticks(_c(ms).cast("bigint") * F.lit(10000) + F.lit(UUID_EPOCH_OFFSET), node, clock_seq)


def timeuuid_from_micros(us, node=None, clock_seq=None) -> Column:
    """Version-1 uuid text of an epoch-microsecond instant (keeps sub-ms order)."""
    return timeuuid_from_ticks(_c(us).cast("bigint") * F.lit(10) + F.lit(UUID_EPOCH_OFFSET), node, clock_seq)


def ntz_epoch_micros(ts) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ read as UTC wall time, whatever
    the session time zone is (also across daylight-saving changes): the wall
    fields are rebuilt as an instant in UTC."""
    t = _c(ts).cast("timestamp_ntz")
    instant = F.make_timestamp(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
                               F.date_part(F.lit("SECOND"), t), F.lit("UTC"))
    return F.unix_micros(instant)


def ntz_epoch_millis(ts) -> Column:
    """Epoch milliseconds (floor) of a TIMESTAMP_NTZ read as UTC wall time."""
    return F.floor(ntz_epoch_micros(ts).cast("decimal(20,0)") / F.lit(1000)).cast("bigint")


def to_epoch_millis(ts) -> Column:
    """Timestamp -> epoch milliseconds."""
    return F.unix_millis(_c(ts))


def from_epoch_millis(ms) -> Column:
    """Epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_c(ms))


# ---------------------------------------------------------------- index keys

def key_for(prefix, value) -> Column:
    """Index key ``prefix:value``."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat_ws(":", p, _c(value))


def value_from(key) -> Column:
    """Text after the last colon of a key (lossy for values with colons)."""
    return F.substring_index(_c(key), ":", -1)


def value_after_prefix(key) -> Column:
    """Lossless inverse of ``key_for`` for the three known prefixes."""
    k = _c(key)
    out = None
    for field in FIELD_ORDER:
        prefix = FIELDS[field][2] + ":"
        cond = k.startswith(prefix)
        v = F.substring(k, len(prefix) + 1, 1 << 30)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out


def field_of_key(key, strict: bool = True) -> Column:
    """Which tracked field an index key belongs to, tested by containment
    in the order otherId, username, verifiedPhone.  Unknown keys raise when
    ``strict`` (the original match has no default case), else give null."""
    k = _c(key)
    out = None
    for field in FIELD_ORDER:
        cond = k.contains(FIELDS[field][2])
        out = F.when(cond, F.lit(field)) if out is None else out.when(cond, F.lit(field))
    if strict:
        out = out.otherwise(F.raise_error(F.concat(F.lit("unknown uniqueness key: "), k)).cast("string"))
    return out


def prefix_of_field(field) -> Column:
    """Key prefix of a field name column."""
    f = _c(field)
    out = None
    for name in FIELD_ORDER:
        out = F.when(f == name, F.lit(FIELDS[name][2])) if out is None else out.when(f == name, F.lit(FIELDS[name][2]))
    return out


def clean_key(key) -> Column:
    """Double single quotes, as for a quoted statement literal."""
    return F.replace(_c(key), F.lit("'"), F.lit("''"))


# ---------------------------------------------------------------- report text

def conflict_text(existing, populated) -> Column:
    """``Conflict: existing [x] populated [y]``."""
    return F.format_string(CONFLICT_FORMAT, _c(existing), _c(populated))


def csv_line(*parts) -> Column:
    """Parts joined by ", ", an absent part written as blank."""
    return F.concat_ws(", ", *[F.coalesce(_c(p), F.lit("")) for p in parts])


# ---------------------------------------------------------------- checksums, objects

def md5_base64(content) -> Column:
    """base64 of the binary md5 digest of the UTF-8 bytes."""
    return F.base64(F.unhex(F.md5(_c(content))))


def utf8_length(content) -> Column:
    """Length in UTF-8 bytes."""
    return F.octet_length(_c(content))


def object_key(id_col, prefix: str = OBJECT_KEY_PREFIX) -> Column:
    """Object-store key ``prefix + id``."""
    return F.concat(F.lit(prefix), _c(id_col))


def ids_json(ids) -> Column:
    """JSON array text of an array<string> column."""
    return F.to_json(_c(ids))


# ---------------------------------------------------------------- ranges

def chunk_of(index, n_total, n_chunks) -> Column:
    """Chunk number of position ``index`` when ``[0, n_total)`` is cut
    into ``n_chunks`` chunks of ``n_total // n_chunks``; the remainder joins
    the last chunk."""
    i = _c(index).cast("bigint")
    n = n_total if isinstance(n_total, Column) else F.lit(int(n_total))
    k = n_chunks if isinstance(n_chunks, Column) else F.lit(int(n_chunks))
    size = F.greatest(F.floor(n / k), F.lit(1))
    return F.least(F.floor(i / size), k - 1).cast("bigint")
