"""Zstandard-compressed text dumps that split: a Spark data source named `zstd_text`.

A dump is `;`-separated UTF-8 with a header, as one Zstandard stream, so any tool that reads such files reads it. The stream is cut into
frames at row ends: the header alone, then blocks of rows. Beside each file lies an index of its frames (offset, bytes, rows), so a
reader makes one Spark partition of every few frames, and a large file is read by many tasks; a file without an index (from
another tool) is one partition, read as a stream. Only the asked columns are converted.

Writing: a task writes one file per value of the partition column it holds (gather them first: `rebalance`), under a temporary folder; the
commit moves all files to their place, an abort removes them. Strings are quoted and nulls are not, so an empty text and a missing one
differ; quotes are doubled, and line ends inside texts stay.

Files are opened by the tasks with Python's file system or Arrow's (hdfs, s3, ...).
"""

from __future__ import annotations

import io
import json
import re
import uuid
from collections.abc import Iterator
from datetime import date
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyarrow import csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

# The format of a dump and its compression level.
DELIMITER, SUFFIX, LEVEL = ";", ".zst", 12
FRAME_BYTES = 8 << 20
SPLIT_BYTES = 64 << 20


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path) if parts.scheme else path
    return pafs.FileSystem.from_uri(path)


def _index(name: str) -> str:
    folder, _, file = name.rpartition("/")
    return f"{folder}/_{file}.frames.json"  # a leading underscore hides it from Spark's own readers


class _FramedFile:
    """One file being written: frames of whole rows."""

    def __init__(self, files: pafs.FileSystem, name: str, header: bytes, level: int):
        import zstandard

        self.files, self.name, self.frames, self.at = files, name, [], 0
        self.packer, self.out = zstandard.ZstdCompressor(level=level, write_checksum=True), files.open_output_stream(name, compression=None)
        self.held, self.size, self.rows = [], 0, 0
        self.add(header, 0)
        self.cut()

    def add(self, text: bytes, rows: int) -> None:
        self.held.append(text)
        self.size, self.rows = self.size + len(text), self.rows + rows

    def cut(self) -> None:
        if self.held:
            frame = self.packer.compress(b"".join(self.held))
            self.out.write(frame)
            self.frames.append([self.at, len(frame), self.size, self.rows])
            self.at += len(frame)
            self.held, self.size, self.rows = [], 0, 0

    def close(self) -> None:
        self.cut()
        self.out.close()
        with self.files.open_output_stream(_index(self.name)) as out:
            out.write(json.dumps({"frames": self.frames}).encode())


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        self.path, self.name = options["path"].rstrip("/"), options.get("name", "part")
        self.partition, self.taken = options.get("partition"), options.get("taken", "")
        self.level, self.frame = int(options.get("level", LEVEL)), int(options.get("framebytes", FRAME_BYTES))
        self.names, self.overwrite, self.job = schema.fieldNames(), overwrite, uuid.uuid4().hex
        if self.partition and self.partition not in self.names:
            raise ValueError(f"no column {self.partition} to partition by: {self.names}")
        files, folder = _store(self.path)
        there = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        if there and not overwrite:
            raise ValueError(f"{self.path} is not empty")

    def _label(self, value) -> str:
        label = f"y{value.year}m{value.month}" if isinstance(value, date) else "none" if value is None else re.sub(r"\W", "-", str(value))
        return "_".join(x for x in (self.name, label if self.partition else "", self.taken) if x)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        files, folder = _store(f"{self.path}/_temporary-{self.job}")
        files.create_dir(folder, recursive=True)
        task = TaskContext.get()
        opened: dict[object, _FramedFile] = {}
        options = csv.WriteOptions(include_header=False, delimiter=DELIMITER, quoting_style="needed")
        header = (DELIMITER.join(self.names) + "\n").encode()
        for batch in iterator:
            for value, part in self._parts(pa.Table.from_batches([batch])):
                if value not in opened:
                    name = f"{folder}/{self._label(value)}-{task.partitionId():05d}.{task.taskAttemptId()}{SUFFIX}"
                    opened[value] = _FramedFile(files, name, header, self.level)
                file = opened[value]
                step = max(1, self.frame * part.num_rows // max(1, part.nbytes))
                for at in range(0, part.num_rows, step):
                    rows, text = part.slice(at, step), io.BytesIO()
                    csv.write_csv(rows, text, options)
                    file.add(text.getvalue(), rows.num_rows)
                    if file.size >= self.frame:
                        file.cut()
        for file in opened.values():
            file.close()
        return _Written([file.name for file in opened.values()])

    def _parts(self, table: pa.Table):
        if not self.partition:
            yield None, table
            return
        values = table.column(self.partition).combine_chunks().dictionary_encode("encode")
        values = values if isinstance(values, pa.DictionaryArray) else values.combine_chunks()
        for i, value in enumerate(values.dictionary.to_pylist()):
            yield value, table.filter(pa.compute.equal(values.indices, i))

    def commit(self, messages: list) -> None:
        files, folder = _store(self.path)
        if self.overwrite:
            for old in files.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
                if old.type == pafs.FileType.File:
                    files.delete_file(old.path)
        for message in messages:
            for name in message.names if message else []:
                final = re.sub(r"\.\d+(?=\.zst$)", "", f"{folder}/{name.rpartition('/')[2]}")
                files.move(_index(name), _index(final))  # the index first: a file without one is only read more slowly
                files.move(name, final)
        self.abort(messages)

    def abort(self, messages: list) -> None:
        files, folder = _store(f"{self.path}/_temporary-{self.job}")
        if files.get_file_info(folder).type != pafs.FileType.NotFound:
            files.delete_dir(folder)


class _Frames(InputPartition):
    """Some frames of one file; without a length, the file from its start to its end, header included."""

    def __init__(self, path: str, offset: int = 0, length: int | None = None):
        super().__init__((path, offset, length))
        self.path, self.offset, self.length = path, offset, length


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.schema, self.split = schema, int(options.get("splitbytes", SPLIT_BYTES))
        self.columns = json.loads(options["columns"]) if "columns" in options else schema.fieldNames()

    def _files(self) -> Iterator[tuple[pafs.FileSystem, str]]:
        for path in self.paths:
            files, name = _store(path)
            info = files.get_file_info(name)
            if info.type == pafs.FileType.NotFound:
                raise FileNotFoundError(path)
            found = [info] if info.type == pafs.FileType.File else files.get_file_info(pafs.FileSelector(name))
            for f in sorted(found, key=lambda f: f.path):
                if f.type == pafs.FileType.File and f.path.endswith(SUFFIX) and not f.base_name.startswith(("_", ".")):
                    yield files, f.path

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for files, name in self._files():
            if files.get_file_info(_index(name)).type == pafs.FileType.NotFound:
                out.append(_Frames(name))
                continue
            with files.open_input_stream(_index(name)) as source:
                frames = json.loads(source.read())["frames"]
            if sum(f[1] for f in frames) != files.get_file_info(name).size:
                raise ValueError(f"{name} and its index do not belong together")
            begin, text = 1, 0  # frame 0 is the header
            for i in range(1, len(frames)):
                text += frames[i][2]
                if text >= self.split or i == len(frames) - 1:
                    out.append(_Frames(name, frames[begin][0], sum(f[1] for f in frames[begin:i + 1])))
                    begin, text = i + 1, 0
        return out or [_Frames("")]

    def read(self, partition: _Frames) -> Iterator[pa.RecordBatch]:
        import zstandard

        if not partition.path:
            return
        files, _ = _store(self.paths[0])
        kinds = to_arrow_schema(self.schema)
        whole = partition.length is None
        with files.open_input_file(partition.path) as source:
            if not whole:
                source.seek(partition.offset)
                source = io.BytesIO(source.read(partition.length))
            text = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)
            try:
                rows = csv.open_csv(
                    text,
                    csv.ReadOptions(column_names=None if whole else self.columns, block_size=4 << 20),
                    csv.ParseOptions(delimiter=DELIMITER, newlines_in_values=True),
                    csv.ConvertOptions(column_types=kinds, include_columns=kinds.names, strings_can_be_null=True, quoted_strings_can_be_null=False,
                                       null_values=[""]),
                )
            except pa.ArrowInvalid as error:
                if "Empty CSV" in str(error):
                    return
                raise
            for batch in rows:
                yield batch.cast(kinds)


class ZstdText(DataSource):
    """`spark.read.format("zstd_text")`; options: paths (JSON list), columns (JSON list: the file's columns, where fewer are read), splitBytes.
    Writing: name, partition, taken (parts of file names), level, frameBytes."""

    @classmethod
    def name(cls) -> str:
        return "zstd_text"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, schema, overwrite)


def write_zstd(df: DataFrame, path: str, name: str, taken: str = "", partition_by: str | None = None, **options) -> None:
    """Dump a table: files `name_y2024m1_taken-00000.zst` by the month of `partition_by`, or `name_taken-00000.zst`."""
    df.sparkSession.dataSource.register(ZstdText)
    if partition_by:
        df = df.hint("rebalance", partition_by)
    given = {"name": name, "taken": taken, **({"partition": partition_by} if partition_by else {}), **options}
    df.write.format("zstd_text").options(**given).mode("append").save(path)


def read_zstd(spark: SparkSession, path: str | list[str], schema: T.StructType, columns: list[str] | None = None, **options) -> DataFrame:
    """Dumps (files or folders) under a declared schema; `columns` are converted alone. A malformed row is an error."""
    spark.dataSource.register(ZstdText)
    paths = [path] if isinstance(path, str) else path
    asked = schema if columns is None else T.StructType([schema[c] for c in columns])
    given = {"paths": json.dumps(paths), "columns": json.dumps(schema.fieldNames()), **options}
    return spark.read.format("zstd_text").schema(asked).options(**given).load()
