"""Keyed objects (B9): one object per unique key, with the checksum and
length an object store wants, so that re-putting a key is a dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyledger.functions.columns import md5_base64, object_key, utf8_length


def keyed_objects(data: DataFrame, key: Column | None = None, content: Column | None = None) -> DataFrame:
    """``object_key, content, content_md5, content_length``, one row per key.

    ``key`` and ``content`` are the caller's functions of a row (U1), given as
    column expressions; defaults are ``output/id/<id>`` and empty content.
    Among rows with one key the greatest content is kept, a fixed choice where
    the store would keep whichever put came last.  The input itself is not
    changed (the original returns it as is)."""
    key = object_key(F.col("id")) if key is None else key
    content = F.lit("") if content is None else content
    one = data.select(key.alias("object_key"), content.cast("string").alias("content"))
    per_key = one.groupBy("object_key").agg(F.max("content").alias("content"))
    return per_key.select("object_key", "content", md5_base64(F.col("content")).alias("content_md5"),
                          utf8_length(F.col("content")).cast("bigint").alias("content_length"))
