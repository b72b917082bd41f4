"""A warehouse outside the catalog, written as a whole or not at all.

``feed_warehouse`` is a Python data source for writers.  Every task writes the Arrow
batches it gets to one Parquet file in a staging folder of its load, through the file
system of the target's address.  When all tasks are through, the driver renames that folder
to ``load=<id>``, and the rows are there at once; if one fails, it deletes the folder (a
task that was killed meanwhile may leave one behind).  Readers take the target for a partitioned Parquet folder: names with an underscore in
front, as that of the staging folder, are not read.

    register_warehouse(spark)
    rows.write.format("feed_warehouse").option("path", "file:///lake/warehouse").mode("append").save()

``overwrite`` drops the earlier loads after the new one is in place; a driver that is lost
in between leaves both, and a second overwrite drops them.  ``load_id`` (a random one by
default) names the load; a load with the id of an earlier one replaces it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from feedlake.session import ship_library

NAME = "feed_warehouse"
_LOAD = "load="
_PLAIN = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass
class _Written(WriterCommitMessage):
    """What a task wrote."""

    file: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, address: str, load_id: str, overwrite: bool):
        self.address, self.load_id, self.overwrite = address, load_id, overwrite
        self.staging = f"_staging-{load_id}-{uuid.uuid4().hex[:12]}"

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.address)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = self._place()
        task = TaskContext.get()
        # Attempts of one task do not write the same file; only that of the message counts.
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.parquet"
        store.create_dir(f"{root}/{self.staging}", recursive=True)
        rows, out = 0, None
        try:
            for batch in iterator:
                if out is None:
                    out = pq.ParquetWriter(f"{root}/{self.staging}/{name}", batch.schema, filesystem=store)
                out.write_batch(batch)
                rows += len(batch)
        finally:
            if out is not None:
                out.close()
        return _Written(name if rows else "", rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = self._place()
        wanted = {message.file for message in messages if message is not None and message.file}
        staged, final = f"{root}/{self.staging}", f"{root}/{_LOAD}{self.load_id}"
        store.create_dir(staged, recursive=True)
        for info in store.get_file_info(fs.FileSelector(staged)):
            if info.base_name not in wanted:  # an attempt that was not the one that counts
                store.delete_file(info.path)
        earlier = [
            info.path
            for info in store.get_file_info(fs.FileSelector(root))
            if info.type == fs.FileType.Directory and info.base_name.startswith(_LOAD)
        ]
        if store.get_file_info(final).type != fs.FileType.NotFound:
            store.delete_dir(final)
        store.move(staged, final)
        if self.overwrite:
            for path in earlier:
                if not path.rstrip("/").endswith(f"/{_LOAD}{self.load_id}"):
                    store.delete_dir(path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = self._place()
        staged = f"{root}/{self.staging}"
        if store.get_file_info(staged).type != fs.FileType.NotFound:
            store.delete_dir(staged)


class WarehouseSource(DataSource):
    """Writer of whole loads; see the module."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        address = self.options.get("path")
        if not address:
            raise ValueError(f"{NAME} needs a path")
        load_id = self.options.get("load_id") or uuid.uuid4().hex
        if not _PLAIN.fullmatch(load_id):
            raise ValueError(f"load_id has letters, digits and _.- only, not {load_id!r}")
        return _Writer(address if "://" in address else f"file://{address}", load_id, overwrite)


def register_warehouse(spark: SparkSession) -> None:
    """Make ``feed_warehouse`` known to the session."""
    ship_library(spark)
    spark.dataSource.register(WarehouseSource)


def read_warehouse(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All loads of a warehouse, with the column ``load``."""
    return spark.read.schema(schema).parquet(path)
