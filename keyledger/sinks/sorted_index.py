"""Index tables for few claims against a huge index.

The table is sorted by its key over all files, with a Parquet Bloom filter for each
row group.  A lookup of a few keys names them in the scan's filter: row groups
whose range or Bloom filter excludes all of them are not read, and of the others
only the pages that can hold one.  So an audit of a few users reads a share of the
index that follows the number of claims; ``audit_few`` joins the whole index, as
``index.audit`` does, when there are more than ``MAX_KEYS``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyledger import schemas
from keyledger.operators import index as X

MAX_KEYS = 3000          # named in a scan's filter, and so collected, at most
ROWS_PER_GROUP = 100_000
_PUSHED_AS_VALUES = 10   # longer IN lists reach Parquet as a range only


def write_sorted(table: DataFrame, path: str, key: str, rows_per_group: int = ROWS_PER_GROUP, mode: str = "errorifexists") -> str:
    """``table`` sorted by ``key`` (and then by its other columns) over all files."""
    order = [key, *[c for c in table.columns if c != key]]
    (table.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode)
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", rows_per_group)
     .option("parquet.block.row.count.limit", rows_per_group).option("parquet.page.row.count.limit", max(1, rows_per_group // 20))
     .parquet(path))
    return path


def few(values: DataFrame, limit: int = MAX_KEYS) -> list[str] | None:
    """The distinct values of a one-column frame, or None if there are more than ``limit``."""
    found = values.distinct().limit(limit + 1).collect()
    return None if len(found) > limit else sorted(r[0] for r in found if r[0] is not None)


def rows_of(table: DataFrame, key: str, values: list[str] | None) -> DataFrame:
    """The rows with one of the ``values`` (None: all), by a filter that reaches the row groups."""
    if values is None:
        return table
    parts = [F.col(key).isin(values[i:i + _PUSHED_AS_VALUES]) for i in range(0, len(values), _PUSHED_AS_VALUES)]
    return table.where(reduce(or_, parts, F.lit(False)))


def audit_few(spark: SparkSession, fields: DataFrame, index_path: str, lookup_path: str, limit: int = MAX_KEYS) -> DataFrame:
    """``index.audit`` of ``fields`` (staged by the caller: they are read twice)
    against tables that ``write_sorted`` wrote from upserted rows, by ``key`` and by ``id``."""
    keys = few(X.index_rows(fields).select("key"), limit)
    ids = few(fields.select("id"), limit)
    index = rows_of(spark.read.schema(schemas.UNIQUENESS_INDEX).parquet(index_path), "key", keys)
    lookup = rows_of(spark.read.schema(schemas.UNIQUENESS_LOOKUP).parquet(lookup_path), "id", ids)
    return X.audit(fields, index, lookup, unique=True)
