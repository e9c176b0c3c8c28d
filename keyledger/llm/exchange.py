"""Blocks of documents, shards of keys, and the packed arrays that pass between
them.

A block is one row that holds a few megabytes of whole documents.  Blocks are
written once as a table bucketed by block, so joining answers to them moves
only the answers.  A shard answers for a range of keys; a block sends it one
row with all the keys it has there, each key once, so the rows are never more
than the keys however many blocks and shards there are.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from keyledger.session import scratch_path

BLOCK_BYTES = 8 << 20  # text of a block, about; a longer document is a block of its own


_TYPES = [np.dtype(t) for t in ("bool", "u1", "i4", "i8", "u8")]


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one value: a byte for how many, a type and a length for each, and
    their bytes transposed, so that the high bytes of small numbers lie together;
    compressed where that makes them smaller, so a value of few entries costs
    little more than these."""
    head = bytes([len(arrays)]) + b"".join(bytes([_TYPES.index(a.dtype)]) + len(a).to_bytes(4, "little") for a in arrays)
    body = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""
                    for a in arrays)
    small = zstandard.ZstdCompressor(level=1).compress(body) if len(body) > 64 else body
    return head + (b"\1" + small if len(small) < len(body) else b"\0" + body)


def unpacked(value: bytes) -> list[np.ndarray]:
    n = value[0]
    body = value[2 + 5 * n:]
    if value[1 + 5 * n]:
        body = zstandard.ZstdDecompressor().decompress(body)
    at, out = 0, []
    for i in range(n):
        dtype, size = _TYPES[value[1 + 5 * i]], int.from_bytes(value[2 + 5 * i:6 + 5 * i], "little")
        part = np.frombuffer(body, dtype=np.uint8, count=size * dtype.itemsize, offset=at).reshape(dtype.itemsize, size).T
        out.append(np.ascontiguousarray(part).view(dtype).reshape(size))
        at += size * dtype.itemsize
    return out


def arrow_rows(schema: str, rows: list[tuple]) -> pa.Table:
    """Rows as an Arrow table with the columns that a DDL schema names."""
    names = [f.split()[0] for f in schema.split(", ")]
    types = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()),
             "double": pa.float64(), "boolean": pa.bool_()}
    kinds = [types[f.split()[1]] for f in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def parts_of(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(shard, slice) of an ascending array of shard numbers."""
    if len(shard):
        start = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        for a, b in zip(start.tolist(), [*start[1:].tolist(), len(shard)], strict=True):
            yield int(shard[a]), slice(a, b)


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a 64-bit key: ranges of keys, ascending with them."""
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class SortedArrays:
    """Ascending keys and their values in files of this worker's own temporary
    folder, memory-mapped; the folder goes when the task has answered."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self._folder = tempfile.TemporaryDirectory()
        self.keys, *self.values = [self._map(i, a) for i, a in enumerate((keys, *values))]

    def _map(self, i: int, a: np.ndarray) -> np.ndarray:
        if not len(a):
            return a
        path = f"{self._folder.name}/{i}"
        a.tofile(path)
        return np.memmap(path, dtype=a.dtype, mode="r")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys that are all present."""
        return np.searchsorted(self.keys, keys)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.keys, self.values = None, None
        self._folder.cleanup()


def write_blocks(blocks: DataFrame, name: str) -> DataFrame:
    """``blocks`` written as a table bucketed by its column ``block``, in as many
    buckets as a shuffle of the session has partitions, so that answers meet it
    without moving it.  The catalog's entry is dropped at once; the files stay in
    the scratch folder for the frame that reads them."""
    spark = blocks.sparkSession
    table = f"keyledger_{name}_{uuid.uuid4().hex[:12]}"
    (blocks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def answered(blocks: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run(block row, answers)`` to every block: the answers are dicts
    by kind of lists of payloads, ordered by the shard that sent them."""

    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        got: dict[str, list[list[np.ndarray]]] = {}
        for r in right.select(["kind", "src", "payload"]).sort_by([("kind", "ascending"), ("src", "ascending")]).to_pylist():
            got.setdefault(r["kind"], []).append(unpacked(r["payload"]))
        return run(left.to_pylist()[0], got)

    return blocks.groupBy("block").cogroup(answers.withColumnRenamed("dest", "block").groupBy("block")).applyInArrow(
        lambda left, right: whole(left, right) if left.num_rows else pa.table(
            {f.split()[0]: [] for f in schema.split(", ")}), schema)


def served(requests: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run(shard, list of (src block, arrays))`` to every shard."""

    def whole(table: pa.Table) -> pa.Table:
        rows = table.sort_by("block").to_pylist()
        return run(rows[0]["shard"], [(r["block"], unpacked(r["payload"])) for r in rows])

    return requests.groupBy("shard").applyInArrow(whole, schema)
