"""Named tables and plain readers.

A table is addressed by a logical ``(keyspace, table)`` pair, as the original
jobs address theirs, and resolved to a format plus a path or options.  Every
read carries an explicit schema where one is known, so no job infers types.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyledger import schemas


@dataclass(frozen=True)
class TableRef:
    """Where a logical table lives (A10)."""
    keyspace: str
    table: str
    path: str | None = None
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    schema: T.StructType | None = None


class TableRegistry:
    """Logical name -> location.  ``register`` also makes the table a temp view
    named ``keyspace_table`` so it can be used from SQL."""

    # Logical tables of the identity model and the schema each one holds.
    KNOWN = {
        "core_events": schemas.RAW_EVENT,
        "contact_events": schemas.RAW_EVENT,
        "bio_events": schemas.RAW_EVENT,
        "context_events": schemas.RAW_EVENT,
        "settings_events": schemas.RAW_EVENT,
        "subscriptions_events": schemas.RAW_EVENT,
        "uniqueness_index": schemas.UNIQUENESS_INDEX,
        "uniqueness_index_lookup": schemas.UNIQUENESS_LOOKUP,
    }

    def __init__(self) -> None:
        self._refs: dict[tuple[str, str], TableRef] = {}

    def add(self, ref: TableRef) -> TableRef:
        if ref.schema is None and ref.table in self.KNOWN:
            ref = TableRef(ref.keyspace, ref.table, ref.path, ref.fmt, dict(ref.options), self.KNOWN[ref.table])
        self._refs[(ref.keyspace, ref.table)] = ref
        return ref

    def ref(self, keyspace: str, table: str) -> TableRef:
        try:
            return self._refs[(keyspace, table)]
        except KeyError:
            raise KeyError(f"table {keyspace}.{table} is not registered") from None

    def read(self, spark: SparkSession, keyspace: str, table: str) -> DataFrame:
        return read_table(spark, self.ref(keyspace, table))

    def register_views(self, spark: SparkSession) -> None:
        for (ks, t), ref in self._refs.items():
            read_table(spark, ref).createOrReplaceTempView(f"{ks}_{t}")


def read_table(spark: SparkSession, ref: TableRef) -> DataFrame:
    """A1/A2: scan a table and project it to its declared columns."""
    reader = spark.read.format(ref.fmt).options(**ref.options)
    if ref.schema is not None and ref.fmt not in ("parquet", "orc"):
        reader = reader.schema(ref.schema)
    df = reader.load(ref.path) if ref.path else reader.load()
    if ref.schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in ref.schema.fields])
    return df


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_text_lines(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    """One row per line of the text files under ``path``."""
    df = spark.read.text(path)
    return df if column == "value" else df.withColumnRenamed("value", column)


def from_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """Local rows to a distributed frame with an explicit schema (tests,
    fixtures; never for data that grows)."""
    return spark.createDataFrame(rows, schema)


def read_message_ids(spark: SparkSession, path: str, body_col: str = "body") -> DataFrame:
    """Read messages back from a JSON outbox, one row per carried id."""
    msgs = spark.read.schema(T.StructType([T.StructField(body_col, T.StringType())])).json(path)
    return msgs.select(F.explode(F.from_json(F.col(body_col), T.ArrayType(T.StringType()))).alias("id"))
