"""Sinks.

Upserts never overwrite what they read.  A versioned table: the merged table goes
to a new version directory and readers take the newest version, so a failed write
leaves the previous version whole and a retried job simply writes again.  A
bucketed table (``buckets``): only the buckets touched are rewritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyledger.sinks import buckets

OBJECT_BUCKETS = 16


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet",
                columns: list[str] | None = None, partition_by: list[str] | None = None) -> str:
    """B2 (``mode='append'``), B3 (default mode), B4 (``columns``)."""
    out = df.select(*columns) if columns else df
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def append(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """B2: append rows to a table."""
    return write_table(df, path, "append", fmt)


def write_text(df: DataFrame, path: str, column: str | None = None, overwrite: bool = True) -> str:
    """One line per row of a string column; the target is
    cleared first (``overwrite``)."""
    col = column or df.columns[0]
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite" if overwrite else "errorifexists").text(path)
    return path


def create_table(spark: SparkSession, schema: T.StructType, path: str, truncate: bool = False) -> str:
    """Create an empty table with ``schema`` if absent; ``truncate``
    empties an existing one."""
    empty = spark.createDataFrame([], schema)
    mode = "overwrite" if truncate else "ignore"
    empty.write.mode(mode).parquet(path)
    return path


def upsert(existing: DataFrame | None, incoming: DataFrame, pk: list[str], insert_only: bool = False) -> DataFrame:
    """B1: primary-key upsert as a plan.

    Incoming rows are made unique per key, greatest value winning (K13).
    Default: incoming rows replace existing rows with the same key (the
    behaviour the original's test asserts).  ``insert_only``: existing rows win
    and only new keys are added.  Rows whose value a user has dropped are not
    removed (K12).

    Plan: both sides are unioned with a source tag and grouped once on the
    key, so each input is read once and there is one shuffle, with the
    per-key maxima combined on the map side.
    """
    if existing is None:
        values = [c for c in incoming.columns if c not in pk]
        best = incoming.groupBy(*pk).agg(F.max(_whole(values)).alias("_row"))
        return best.select(*[F.col("_row")[c].alias(c) if c in values else F.col(c) for c in incoming.columns])
    tagged = (existing.select(*incoming.columns).withColumn("_new", F.lit(False))
              .unionByName(incoming.withColumn("_new", F.lit(True))))
    return _newest(tagged, pk, incoming.columns, insert_only)


def _whole(values: list[str]):
    """One struct per row: with several value columns the greatest row wins as a
    whole, never a mixture of two rows."""
    return F.struct(*values) if values else F.struct(F.lit(1))


def _newest(tagged: DataFrame, pk: list[str], columns: list[str], insert_only: bool) -> DataFrame:
    """One row per key of old and incoming rows (``_new``)."""
    values = [c for c in columns if c not in pk]
    row, new = _whole(values), F.col("_new")
    g = tagged.groupBy(*pk).agg(F.max(F.when(new, row)).alias("_n"), F.max(F.when(~new, row)).alias("_o"))
    best = F.coalesce("_o", "_n") if insert_only else F.coalesce("_n", "_o")
    return g.select(*pk, best.alias("_row")).select(
        *[F.col("_row")[c].alias(c) if c in values else F.col(c) for c in columns])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def list_versions(spark: SparkSession, table_dir: str) -> list[str]:
    """Committed version directories of a versioned table, oldest first.

    A table with version folders of which none is committed raises: it was
    written without success markers, and treating it as empty would lose its
    rows at the next upsert."""
    fs, p = _fs(spark, table_dir)
    if not fs.exists(p):
        return []
    found = [st.getPath() for st in fs.listStatus(p) if st.isDirectory() and st.getPath().getName().startswith("v=")]
    names = [v.getName() for v in found if fs.exists(v.suffix("/_SUCCESS"))]
    if found and not names:
        raise RuntimeError(f"{table_dir} has versions but no committed one (is the success marker switched off?)")
    return [f"{table_dir.rstrip('/')}/{n}" for n in sorted(names)]


def read_latest(spark: SparkSession, table_dir: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The newest committed version of a versioned table, or None; the rows of
    a bucketed table."""
    if buckets.layout(spark, table_dir) is not None:
        df = buckets.read(spark, table_dir).drop("bucket")
    elif v := list_versions(spark, table_dir):
        df = spark.read.parquet(v[-1])
    else:
        return None
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]) if schema else df


def write_version(df: DataFrame, table_dir: str) -> str:
    """Write ``df`` as the next version of a versioned table, numbered one above
    the last; never touches the versions it may have been computed from."""
    versions = list_versions(df.sparkSession, table_dir)
    last = int(versions[-1].rsplit("v=", 1)[1].split("-")[0]) if versions else 0
    path = f"{table_dir.rstrip('/')}/v={last + 1:012d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(path)
    return path


def upsert_table(spark: SparkSession, table_dir: str, incoming: DataFrame, pk: list[str],
                 insert_only: bool = False) -> str:
    """B1 on storage.  A table laid out by ``buckets.create``: only the buckets
    that ``incoming`` touches are rewritten.  Any other: ``incoming`` is merged
    into the newest version and the result becomes the next version."""
    if (lay := buckets.layout(spark, table_dir)) is not None:
        if sorted(lay.pk) != sorted(pk):
            raise ValueError(f"{table_dir} is laid out by {lay.pk}, not {pk}")
        columns = ["bucket", *lay.schema.names]
        buckets.put(spark, table_dir, upsert(None, incoming, pk),
                    lambda rows: _newest(rows, ["bucket", *pk], columns, insert_only))
        return table_dir
    return write_version(upsert(read_latest(spark, table_dir), incoming, pk, insert_only), table_dir)


def write_outbox(messages: DataFrame, path: str, run_id: str) -> str:
    """B10 / B11 transport stand-in: messages as JSON lines, in the folder
    ``run=<run_id>`` of the outbox.  Earlier runs stay; a run that is sent again
    replaces itself.  A sender reading the outbox delivers at least once, as the
    original does."""
    messages.write.mode("overwrite").json(f"{path.rstrip('/')}/run={run_id}")
    return path


def write_objects(objects: DataFrame, path: str, n_buckets: int = OBJECT_BUCKETS) -> str:
    """The keyed-object table, one row per object key; putting a key again
    replaces it, and all other objects stay.  A put rewrites the buckets of its
    keys (``n_buckets`` is used when the table is new)."""
    buckets.create(objects.sparkSession, path, objects.schema, ["object_key"], n_buckets)
    return upsert_table(objects.sparkSession, path, objects, ["object_key"])


def read_objects(spark: SparkSession, path: str) -> DataFrame | None:
    """The keyed objects as they are now."""
    return read_latest(spark, path)
