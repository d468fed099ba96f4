"""Arrow (Feather) files as a data source: ``spark.read.format("arrow_files")``.

A folder of files is read by tasks, one file each, batch by batch, and written by tasks, one file
each. Batches go through as they are, with no row ever made. ``register`` makes the source known to a
session; its code is sent to executors by value.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

NAME = "arrow_files"
SUFFIX = (".feather", ".arrow")
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _files(path: str) -> list[str]:
    """The Arrow files of a folder, or the one file."""
    store, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    if store.get_file_info(inner).type == fs.FileType.File:
        return [path]
    found = store.get_file_info(fs.FileSelector(inner))
    prefix = path.split("://")[0] + "://" if "://" in path else ""
    return sorted(prefix + i.path for i in found
                  if i.is_file and i.path.endswith(SUFFIX) and not i.base_name.startswith(("_", ".")))


def _opened(path: str):
    store, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return ipc.open_file(store.open_input_file(inner))


class ArrowReader(DataSourceReader):
    def __init__(self, files: list[str], names: list[str]):
        self.files, self.names = files, names

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(file) for file in self.files]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        reader = _opened(partition.value)
        for number in range(reader.num_record_batches):
            yield reader.get_batch(number).select(self.names)


class ArrowWriter(DataSourceArrowWriter):
    """Tasks write under names of their own; a failed job's files are removed, and with overwriting the
    files that were there go when all new ones are written."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.before = _files(path) if overwrite and self._store().get_file_info(
            self._inner(path)).type == fs.FileType.Directory else []

    def _store(self) -> fs.FileSystem:
        return fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()

    def _inner(self, path: str) -> str:
        return fs.FileSystem.from_uri(path)[1] if "://" in path else path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        message = WriterCommitMessage()
        message.file = None
        writer = None
        store = self._store()
        for batch in iterator:
            if writer is None:
                store.create_dir(self._inner(self.path), recursive=True)
                message.file = f"{self.path}/part-{uuid.uuid4().hex}{SUFFIX[0]}"
                sink = store.open_output_stream(self._inner(message.file))
                writer = ipc.new_file(sink, batch.schema)
            writer.write_batch(batch)
        if writer is not None:
            writer.close()
            sink.close()
        return message

    def _remove(self, files) -> None:
        for file in files:
            if file:
                self._store().delete_file(self._inner(file))

    def commit(self, messages) -> None:
        self._remove(self.before)

    def abort(self, messages) -> None:
        self._remove(m.file for m in messages if m is not None)


class ArrowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        files = _files(self.options["path"])
        if not files:
            raise ValueError(f"no Arrow files in {self.options['path']}; give a schema")
        return from_arrow_schema(_opened(files[0]).schema)

    def reader(self, schema: StructType) -> ArrowReader:
        return ArrowReader(_files(self.options["path"]), schema.names)

    def writer(self, schema: StructType, overwrite: bool) -> ArrowWriter:
        return ArrowWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make ``arrow_files`` a format of this session."""
    spark.dataSource.register(ArrowFiles)
