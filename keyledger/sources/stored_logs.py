"""Event logs and users stored by id (A3, A4, D2): all rows of an id lie in one
bucket of each table, sorted, so folding them and joining users to the result
shuffles nothing.  The shuffle is paid once, when a log is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyledger.functions.constants import FIELD_ORDER
from keyledger.operators import events


def store_by_id(rows: DataFrame, table: str, n_buckets: int, sort: list[str] | None = None, mode: str = "errorifexists") -> str:
    """Write ``rows`` as the catalog table ``table`` in ``n_buckets`` buckets of
    ``id``, one file each (choose their number so that a bucket fits a task; tables
    that are used together need the same).  An id with a large share of all rows
    makes a large bucket, which the fold reads as a stream."""
    rows.repartition(n_buckets, "id").write.mode(mode).bucketBy(n_buckets, "id").sortBy("id", *(sort or [])).saveAsTable(table)
    return table


def populate_stored(spark: SparkSession, users: str, core: str | None, contact: str | None, on_bad: str = "fail") -> DataFrame:
    """E8 over stored tables, without an Exchange: each log is folded where it lies
    and joined to the users' buckets (a union of the logs would lose their layout)."""
    out = spark.table(users)
    if core is not None:
        out = events.fill(out, events.fold_events(spark.table(core), None, on_bad))
    if contact is not None:
        out = events.fill(out, events.fold_events(None, spark.table(contact), on_bad))
    return out.select("id", *FIELD_ORDER)
