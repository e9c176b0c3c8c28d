"""Sinks that deliver, as Spark data sources.

``keyledger_outbox`` takes messages (``entry_id`` or any other columns, and
``body``) and makes a run of them visible at once: each task writes a file under
``_pending``, tells the driver its name, and the commit keeps the files of the
attempts that succeeded and renames the folder to ``run=<run_id>``.  A run that
fails leaves nothing visible; a run sent again after it was delivered changes
nothing, so every message is there once however often tasks or runs are tried.

``keyledger_objects`` puts one object per row under its key.  A put is written
beside its place and renamed into it, so an object is the old or the new one,
whole; trying a task again puts the same objects again.

Both use the file system that ``path`` names (pyarrow's) from the tasks, one file
open at a time, rows streamed.  The outbox needs one that renames folders (local
folders, HDFS); objects go to any, object stores included.

    register(spark)
    messages.write.format("keyledger_outbox").option("run_id", "r1").mode("append").save(path)
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage


def _place(path: str) -> tuple[fs.FileSystem, str]:
    found, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file://{path}")
    return found, inner.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class OutboxWriter(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.run_id, self.columns = options["path"], options["run_id"], columns
        self.pending = f"_pending/run={self.run_id}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        store, root = _place(self.path)
        folder, name, rows = f"{root}/{self.pending}", f"part-{uuid.uuid4().hex}.json", 0
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/{name}") as out:
            for row in iterator:
                out.write((json.dumps(dict(zip(self.columns, row, strict=True))) + "\n").encode())
                rows += 1
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _place(self.path)
        pending, final = f"{root}/{self.pending}", f"{root}/run={self.run_id}"
        if store.get_file_info(final).type != fs.FileType.NotFound:  # delivered by an earlier try of this run
            return self.abort(messages)
        kept = {m.name for m in messages if m is not None and m.rows}
        store.create_dir(pending, recursive=True)
        for f in store.get_file_info(fs.FileSelector(pending)):
            if f.base_name not in kept:                               # of attempts that failed, or empty
                store.delete_file(f.path)
        store.move(pending, final)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _place(self.path)
        if store.get_file_info(f"{root}/{self.pending}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.pending}")


class OutboxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyledger_outbox"

    def writer(self, schema: T.StructType, overwrite: bool) -> OutboxWriter:
        if "run_id" not in self.options or overwrite:
            raise ValueError("the outbox takes a run_id and is appended to")
        return OutboxWriter(dict(self.options), schema.names)


def _folder(key: str) -> str:
    """The prefix an object lies under: keys are spread, so that no listing holds all."""
    return hashlib.md5(key.encode()).hexdigest()[:2]


class ObjectWriter(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.key, self.content = options["path"], columns.index("object_key"), columns.index("content")

    def write(self, iterator: Iterator[Row]) -> Written:
        store, root = _place(self.path)
        mine, rows, folders = f"_put-{uuid.uuid4().hex}", 0, set()
        for row in iterator:
            folder = f"{root}/{_folder(row[self.key])}"
            if folder not in folders:
                store.create_dir(folder, recursive=True)
                folders.add(folder)
            with store.open_output_stream(f"{folder}/{mine}") as out:
                out.write((row[self.content] or "").encode())
            store.move(f"{folder}/{mine}", f"{folder}/k-{quote(row[self.key], safe='')}")
            rows += 1
        return Written("", rows)


class ObjectReader(DataSourceReader):
    """One partition per prefix: each task lists and reads its own."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f"{n:02x}") for n in range(256)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        store, root = _place(self.path)
        folder = f"{root}/{partition.value}"
        if store.get_file_info(folder).type == fs.FileType.Directory:
            for f in store.get_file_info(fs.FileSelector(folder)):
                if f.base_name.startswith("k-"):
                    with store.open_input_stream(f.path) as read:
                        yield unquote(f.base_name[2:]), read.read().decode()


class ObjectSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyledger_objects"

    def schema(self) -> str:
        return "object_key string, content string"

    def reader(self, schema: T.StructType) -> ObjectReader:
        return ObjectReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> ObjectWriter:
        return ObjectWriter(dict(self.options), schema.names)


def register(spark: SparkSession) -> None:
    for source in (OutboxSource, ObjectSource):
        spark.dataSource.register(source)


def deliver(messages: DataFrame, path: str, run_id: str) -> str:
    """Messages into the outbox, as the run ``run_id``."""
    register(messages.sparkSession)
    messages.write.format("keyledger_outbox").option("run_id", run_id).mode("append").save(path)
    return path


def put_objects(objects: DataFrame, path: str) -> str:
    """One object per row of ``object_key, content`` (unique keys)."""
    register(objects.sparkSession)
    objects.select("object_key", "content").write.format("keyledger_objects").mode("append").save(path)
    return path


def read_delivered(spark: SparkSession, path: str) -> DataFrame:
    """The objects as the store has them: ``object_key, content``."""
    register(spark)
    return spark.read.format("keyledger_objects").load(path)
