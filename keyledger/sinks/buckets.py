"""Keyed tables laid out by a hash of their key, of which an upsert rewrites only
the buckets it touches (B1, B5, B9).

``bucket=<n>/`` folders hold the rows, ``_layout`` says how they were dealt.  A
merge reads the touched buckets (partition pruning), merges them in one shuffle
by bucket, and writes the result with dynamic partition overwrite, which leaves
all other folders alone.  The merged buckets are first written under ``_redo``:
a run that fails before they are complete leaves the table as it was, and one
that is stopped while folders are being replaced is finished by the next merge
(or ``recover``), from ``_redo``, not from the table.  Readers see neither.

Choose the number of buckets so that one fits a task (some hundred megabytes).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyledger.session import stage

N_BUCKETS = 64


@dataclass(frozen=True)
class Layout:
    schema: T.StructType
    pk: list[str]
    buckets: int


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def create(spark: SparkSession, table_dir: str, schema: T.StructType, pk: list[str], buckets: int = N_BUCKETS) -> Layout:
    """An empty bucketed table; one that is there already keeps its layout and rows."""
    if (have := layout(spark, table_dir)) is None:
        text = json.dumps({"schema": json.loads(schema.json()), "pk": pk, "buckets": int(buckets)})
        fs, p = _fs(spark, f"{table_dir}/_layout.new")
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.rename(p, _fs(spark, f"{table_dir}/_layout")[1])  # there, whole, or not there
        have = Layout(schema, list(pk), int(buckets))
    return have


def layout(spark: SparkSession, table_dir: str) -> Layout | None:
    """How a table is laid out, or None if it is not a bucketed one."""
    fs, p = _fs(spark, f"{table_dir}/_layout")
    if not fs.exists(p):
        return None
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    stream = fs.open(p)
    d = json.loads(text.toString(stream, "UTF-8"))
    stream.close()
    return Layout(T.StructType.fromJson(d["schema"]), d["pk"], d["buckets"])


def bucket_of(lay: Layout) -> Column:
    return F.pmod(F.xxhash64(*lay.pk), F.lit(lay.buckets)).cast("int").alias("bucket")


def read(spark: SparkSession, table_dir: str, only: list[int] | None = None) -> DataFrame:
    """The rows, or those of some buckets, with the column ``bucket``."""
    lay = layout(spark, table_dir)
    schema = T.StructType([*lay.schema.fields, T.StructField("bucket", T.IntegerType())])
    fs, p = _fs(spark, table_dir)
    if not any(s.getPath().getName().startswith("bucket=") for s in fs.listStatus(p)):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(table_dir)
    return rows if only is None else rows.where(F.col("bucket").isin(only))


def merge(spark: SparkSession, table_dir: str, incoming: DataFrame, combine: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Merge ``incoming`` (unique per key, staged by the caller) into the table;
    returns the buckets rewritten.

    ``combine`` gets old and incoming rows with ``bucket`` and the flag ``_new``,
    already dealt by bucket, and returns one row per key with ``bucket``: an
    aggregate over ``bucket`` and the key needs no further shuffle."""
    recover(spark, table_dir)
    lay = layout(spark, table_dir)
    dealt = incoming.select(*lay.schema.names, bucket_of(lay))
    touched = sorted(r[0] for r in dealt.select("bucket").distinct().collect())  # at most lay.buckets numbers
    if not touched:
        return []
    old = read(spark, table_dir, touched)
    rows = old.withColumn("_new", F.lit(False)).unionByName(dealt.withColumn("_new", F.lit(True)))
    merged = combine(rows.repartition("bucket")).select(*[F.col(f.name).cast(f.dataType) for f in lay.schema.fields], "bucket")
    redo = f"{table_dir}/_redo/{uuid.uuid4().hex}"
    merged.write.partitionBy("bucket").parquet(redo)
    _replace(spark, table_dir, redo)
    return touched


def _replace(spark: SparkSession, table_dir: str, redo: str) -> None:
    """Put the complete buckets under ``redo`` in the place of the table's."""
    lay = layout(spark, table_dir)
    schema = T.StructType([*lay.schema.fields, T.StructField("bucket", T.IntegerType())])
    (spark.read.schema(schema).parquet(redo).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(table_dir))
    _drop(spark, redo)


def recover(spark: SparkSession, table_dir: str) -> int:
    """Finish merges that were stopped while replacing buckets, and forget those
    that never got so far; returns how many were finished."""
    fs, p = _fs(spark, f"{table_dir}/_redo")
    finished = 0
    for s in fs.listStatus(p) if fs.exists(p) else []:
        path = f"{table_dir}/_redo/{s.getPath().getName()}"
        if _exists(spark, f"{path}/_SUCCESS"):
            _replace(spark, table_dir, path)
            finished += 1
        else:
            _drop(spark, path)
    return finished


def put(spark: SparkSession, table_dir: str, rows: DataFrame, combine: Callable[[DataFrame], DataFrame]) -> list[int]:
    """``merge`` of rows that are staged here first: they are read twice, once to
    see which buckets they touch."""
    return merge(spark, table_dir, stage(rows, "bucket-rows"), combine)
