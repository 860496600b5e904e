"""A table whose slices are replaced and deleted in one atomic step, under a versioned manifest.

The rows lie in Parquet files, each of one slice (one value of the slice keys), in a folder per write. Which files make up the table
is told by the manifest: one small file per version, which lists every slice with its files, its rows and an optional mark of
the input it was made from. A change writes new files first and then publishes the next manifest by one rename that fails if that
version exists, so a reader sees all old or all new slices, and a job that dies before the rename leaves nothing but unlisted
files, which `vacuum` removes. Two jobs that change different slices at once both succeed (the later one goes on top of the
earlier one's manifest); if they change the same slice, the later one is refused.

The driver holds the list of slices (one entry per month and network, thousands), never rows. Renames are atomic on HDFS and local file
systems; on an object store only one job may write at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.operators.checks import InputError

Key = tuple


class Conflict(InputError):
    """Another job changed a slice that this one was about to replace."""


@dataclass(frozen=True)
class Slice:
    files: tuple[str, ...]
    rows: int
    mark: str | None = None


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    slices: dict[Key, Slice] = field(default_factory=dict)


class SliceTable:
    """`keys` name the slice columns of `schema` (dates, text or whole numbers)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema

    # manifest

    def versions(self) -> list[int]:
        folder = self._hadoop(f"{self.path}/manifest")
        files = folder.getFileSystem(self._conf())
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of a version still kept."""
        known = self.versions()
        if version is None:
            if not known:
                return Manifest()
            version = known[-1]
        elif version not in known:
            raise InputError(f"version {version} of {self.path} is not kept: {known}")
        file = self._hadoop(self._manifest_file(version))
        stream = file.getFileSystem(self._conf()).open(file)
        try:
            entries = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Manifest(version, {self._key(e["key"]): Slice(tuple(e["files"]), e["rows"], e["mark"]) for e in entries})

    def _publish(self, manifest: Manifest) -> bool:
        """Make a manifest the newest one; False if another job took the version."""
        entries = [
            {"key": [v.isoformat() if isinstance(v, date) else v for v in key], "files": s.files, "rows": s.rows, "mark": s.mark}
            for key, s in sorted(manifest.slices.items(), key=lambda item: str(item[0]))
        ]
        part = self._hadoop(f"{self.path}/manifest/.{uuid.uuid4().hex}")
        files = part.getFileSystem(self._conf())
        stream = files.create(part, True)
        try:
            stream.write(json.dumps(entries, ensure_ascii=False).encode())
        finally:
            stream.close()
        final = self._hadoop(self._manifest_file(manifest.version))
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self._conf()).rename(part, final, none)
        except Exception as error:
            files.delete(part, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    # reading

    def read(self, version: int | None = None, slices: Collection[Key] | None = None) -> DataFrame:
        """All slices, or the named ones alone: the files of others are not even listed."""
        held = self.manifest(version).slices
        files = [f"{self.path}/{f}" for key, s in held.items() if slices is None or key in slices for f in s.files]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files).select(*self.schema.fieldNames())

    # changing

    def replace(
        self,
        result: DataFrame,
        requested: Collection[Key] | None = None,
        may_be_empty: bool | Collection[Key] = False,
        marks: dict[Key, str] | None = None,
    ) -> int:
        """Put the result's slices in the place of the stored ones and return the table's version.

        With `requested`, exactly these slices change: a row of any other is refused, and one without rows is deleted if
        `may_be_empty` allows it (for all, or for the named ones) and refused otherwise. Without it, the slices of the result
        change, and an empty result is refused. Nothing changes when anything is refused.
        """
        base = self.manifest()
        folder = f"data/{uuid.uuid4().hex}"
        written = self._write(result, folder)
        try:
            if requested is None:
                if not written:
                    raise InputError("nothing to store: the new slices are empty")
                touched = set(written)
            else:
                touched = set(requested)
                strangers = sorted(self._shown(k) for k in written if k not in touched)
                if strangers:
                    raise InputError(f"the result holds slices that were not requested: {'; '.join(strangers)}")
                refused = [k for k in touched if k not in written and may_be_empty is not True and k not in (may_be_empty or ())]
                if refused:
                    raise InputError(f"requested slices have no rows and would keep their old ones: {'; '.join(sorted(map(self._shown, refused)))}")
            marks = marks or {}
            new = {k: Slice(s.files, s.rows, marks.get(k)) for k, s in written.items()}
            return self._commit(base, touched, new)
        except InputError:
            self._delete(folder)
            raise

    def delete(self, slices: Iterable[Key]) -> int:
        """Remove slices; those that are not stored do not matter."""
        return self._commit(self.manifest(), set(slices), {})

    def _commit(self, base: Manifest, touched: set[Key], new: dict[Key, Slice]) -> int:
        now = base
        while True:
            if not new and not touched & set(now.slices):
                return now.version
            if any(now.slices.get(k) != base.slices.get(k) for k in touched):
                raise Conflict(f"slices of {self.path} were changed meanwhile: {'; '.join(sorted(map(self._shown, touched)))[:400]}")
            kept = {k: s for k, s in now.slices.items() if k not in touched}
            if self._publish(Manifest(now.version + 1, {**kept, **new})):
                return now.version + 1
            now = self.manifest()

    def _write(self, result: DataFrame, folder: str) -> dict[Key, Slice]:
        """Files of one slice each; a large slice is split by its bytes. Their slices come from one scan of the key columns."""
        columns = self.schema.fieldNames()
        (
            result.select(*columns, F.hex(F.xxhash64(*self.keys)).alias("__slice"))
            .hint("rebalance", *self.keys)
            .write.option("compression", "zstd")
            .partitionBy("__slice")
            .parquet(f"{self.path}/{folder}")
        )
        stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
        listed = stored.groupBy(*self.keys, F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows")).collect()
        found: dict[Key, list] = {}
        for row in listed:
            found.setdefault(tuple(row[k] for k in self.keys), []).append((folder + row["file"].split(folder, 1)[1], row["rows"]))
        if len({f for files in found.values() for f, _ in files}) < len(listed):
            raise RuntimeError("two slices share a file")  # their 64-bit hashes are equal
        return {k: Slice(tuple(sorted(f for f, _ in files)), sum(n for _, n in files)) for k, files in found.items()}

    def vacuum(self, keep: int = 2) -> int:
        """Drop all but the newest `keep` manifests, and data folders that none of those lists; returns the folders removed.

        Not while another job writes: its files are unlisted until it publishes.
        """
        known = self.versions()
        for version in known[:-keep]:
            file = self._hadoop(self._manifest_file(version))
            file.getFileSystem(self._conf()).delete(file, False)
        listed = {f.split("/")[1] for v in known[-keep:] for s in self.manifest(v).slices.values() for f in s.files}
        folder = self._hadoop(f"{self.path}/data")
        files = folder.getFileSystem(self._conf())
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        for name in set(names) - listed:
            self._delete(f"data/{name}")
        return len(set(names) - listed)

    # helpers

    def _key(self, values: list) -> Key:
        kinds = [self.schema[k].dataType for k in self.keys]
        return tuple(date.fromisoformat(v) if isinstance(t, T.DateType) and v is not None else v for v, t in zip(values, kinds, strict=True))

    def _shown(self, key: Key) -> str:
        return ", ".join(map(str, key))

    def _manifest_file(self, version: int) -> str:
        return f"{self.path}/manifest/{version:012d}.json"

    def _hadoop(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self._conf()).makeQualified(path)

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _delete(self, name: str) -> None:
        path = self._hadoop(f"{self.path}/{name}")
        path.getFileSystem(self._conf()).delete(path, True)
