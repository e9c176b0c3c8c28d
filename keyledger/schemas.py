"""Record types of the identity-event model as Spark StructTypes."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# RawEvent: one row of an event table, primary key ((id), time).
RAW_EVENT = T.StructType([
    T.StructField("id", S, False),
    T.StructField("time", S, True),      # version-1 time uuid
    T.StructField("payload", S, True),   # JSON text
])

# `$set` bodies of the two event families.
CORE_SET = T.StructType([
    T.StructField("id", S, True),
    T.StructField("otherId", S, True),
    T.StructField("username", S, True),
])
CONTACT_SET = T.StructType([
    T.StructField("phone", S, True),
])


def payload_schema(set_schema: T.DataType) -> T.StructType:
    """Envelope of an event payload.  `time`, `version` and `snapshot` are read
    as text so that numeric text is accepted (lenient scalar reads) and then
    converted by the parser."""
    return T.StructType([
        T.StructField("$rem", T.ArrayType(S), True),
        T.StructField("model", S, True),
        T.StructField("id", S, True),
        T.StructField("time", S, True),
        T.StructField("source", S, True),
        T.StructField("$set", set_schema, True),
        T.StructField("version", S, True),
        T.StructField("snapshot", S, True),
    ])


UNIQUE_FIELDS = T.StructType([
    T.StructField("id", S, False),
    T.StructField("otherId", S, True),
    T.StructField("username", S, True),
    T.StructField("verifiedPhone", S, True),
])

UNIQUENESS_INDEX = T.StructType([
    T.StructField("key", S, False),
    T.StructField("value", S, True),
])

UNIQUENESS_LOOKUP = T.StructType([
    T.StructField("id", S, False),
    T.StructField("key", S, False),
    T.StructField("value", S, True),
])

STATUS_COLUMNS = ["otherId", "otherIdLookup", "username", "usernameLookup",
                  "verifiedPhone", "verifiedPhoneLookup"]

KEY_VALUE = T.StructType([
    T.StructField("key", S, False),
    T.StructField("value", T.IntegerType(), True),
])

USER = T.StructType([
    T.StructField("id", S, False),
    T.StructField("firstName", S, True),
    T.StructField("lastName", S, True),
])
