"""Named tables in the session catalog (A10, B12): a keyspace is a database, and
its tables are created, emptied and read by name; any session that shares the
catalog sees them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyledger.sources.tables import TableRegistry


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


class CatalogTables:
    """The tables of one keyspace.  ``location``: where its managed tables lie
    (default: the warehouse); only used when the keyspace is new."""

    def __init__(self, spark: SparkSession, keyspace: str, location: str | None = None):
        self.spark, self.keyspace = spark, keyspace
        at = "" if location is None else " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(keyspace)}{at}")

    def name(self, table: str) -> str:
        return _quoted(self.keyspace, table)

    def create(self, table: str, schema: T.StructType | None = None, fmt: str = "parquet") -> None:
        """An empty table, if there is none of the name.  A known table needs no schema."""
        schema = schema or TableRegistry.KNOWN[table]
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING {fmt}")

    def truncate(self, table: str) -> None:
        self.spark.sql(f"TRUNCATE TABLE {self.name(table)}")

    def append(self, rows: DataFrame, table: str) -> None:
        """B2, by column name."""
        rows.select(*self.read(table).columns).write.insertInto(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.keyspace) if not t.isTemporary)

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {_quoted(self.keyspace)} CASCADE")
