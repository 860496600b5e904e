"""Sorted arrays in the shared folder, written by tasks and memory-mapped by other tasks.

A store is a folder of raw little-endian files, one per shard and column. Keys are unsigned 64-bit hashes; the shard of a key is
its top bits, so the shards in order are one sorted array. A file appears under its name only when it is whole, and a repeated
task writes the same bytes, so lost executors and retried tasks leave a right store.
"""

from __future__ import annotations

import mmap
import os
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow.fs as pafs

from salescube.sources.scratch import new_path

__all__ = ["SortedStore", "new_path", "put", "appending", "get", "shard_bits"]

#: A map outlives the descriptor of its file; processes may hold far fewer descriptors than maps.
_NO_DESCRIPTOR = {"trackfd": False} if sys.version_info >= (3, 13) else {}


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def put(uri: str, array: np.ndarray) -> None:
    """Write one array whole; last writer wins."""
    data = np.ascontiguousarray(array)
    path = _local(uri)
    if path is None:
        fs, name = pafs.FileSystem.from_uri(uri)
        with fs.open_output_stream(name) as out:
            out.write(memoryview(data).cast("B") if data.size else b"")
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    data.tofile(part)
    os.replace(part, path)


@contextmanager
def appending(uri: str) -> Iterator[Callable[[np.ndarray], None]]:
    """A function that writes one array after another into a file, which appears whole under its name in the end; last writer wins."""
    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        try:
            with open(part, "wb") as out:
                yield lambda array: np.ascontiguousarray(array).tofile(out)
            os.replace(part, path)
        finally:
            if os.path.exists(part):
                os.unlink(part)
        return
    fs, name = pafs.FileSystem.from_uri(uri)
    with tempfile.TemporaryFile() as held:  # a stream that closes early would show a part of the file
        yield lambda array: np.ascontiguousarray(array).tofile(held)
        held.seek(0)
        with fs.open_output_stream(name) as out:
            while block := held.read(1 << 22):
                out.write(block)


def _mapped(path: str, dtype) -> np.ndarray:
    if not os.path.getsize(path):
        return np.zeros(0, dtype)
    with open(path, "rb") as source:
        return np.frombuffer(mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ, **_NO_DESCRIPTOR), dtype)


def get(uri: str, dtype) -> np.ndarray:
    """Map an array into memory. From a store that cannot be mapped it is copied to an unlinked local file first."""
    path = _local(uri)
    if path is not None:
        return _mapped(path, dtype) if os.path.exists(path) else np.zeros(0, dtype)
    fs, name = pafs.FileSystem.from_uri(uri)
    if fs.get_file_info(name).type == pafs.FileType.NotFound:
        return np.zeros(0, dtype)
    with tempfile.NamedTemporaryFile() as held:
        with fs.open_input_stream(name) as source:
            while block := source.read(1 << 22):
                held.write(block)
        held.flush()
        return _mapped(held.name, dtype)


def shard_bits(entries: int, per_shard: int, least: int = 1) -> int:
    """Top bits that give shards of about `per_shard` entries each, `least` shards or more."""
    shards = max(least, -(-entries // per_shard), 1)
    return min(24, (shards - 1).bit_length())


class SortedStore:
    """Lookup of many keys in the sorted shards `name` of a folder; files are opened when first probed."""

    def __init__(self, uri: str, name: str, bits: int, columns: dict[str, type]):
        self.uri, self.name, self.bits, self.columns = uri, name, bits, columns
        self.open: dict[tuple[int, str], np.ndarray] = {}

    def file(self, shard: int, column: str) -> str:
        return f"{self.uri}/{self.name}.{column}.{shard:05d}"

    def shards_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)

    def write(self, shard: int, keys: np.ndarray, **values: np.ndarray) -> None:
        """Keys sorted and distinct, all of this shard."""
        for column, array in {"key": keys, **values}.items():
            put(self.file(shard, column), array.astype(np.uint64 if column == "key" else self.columns[column], copy=False))

    @contextmanager
    def appending(self, shard: int, *columns: str) -> Iterator[Callable[..., None]]:
        """A function that takes values of these columns, run after run in the order of the keys, for one shard."""
        with ExitStack() as files:
            add = {c: files.enter_context(appending(self.file(shard, c))) for c in columns}

            def run(**values: np.ndarray) -> None:
                for column, array in values.items():
                    add[column](array.astype(np.uint64 if column == "key" else self.columns[column], copy=False))
            yield run

    def array(self, shard: int, column: str) -> np.ndarray:
        if (shard, column) not in self.open:
            self.open[shard, column] = get(self.file(shard, column), np.uint64 if column == "key" else self.columns[column])
        return self.open[shard, column]

    def places(self, keys: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """For sorted keys: their place in the whole sorted array (`firsts` has the place of each shard's first key), or -1."""
        out = np.full(len(keys), -1, np.int64)
        shards = self.shards_of(keys)
        for shard in np.unique(shards):
            lo, hi = np.searchsorted(shards, [shard, shard + 1])
            held = self.array(int(shard), "key")
            if len(held):
                at = np.searchsorted(held, keys[lo:hi])
                at[at == len(held)] = 0
                out[lo:hi] = np.where(np.asarray(held[at]) == keys[lo:hi], at + firsts[shard], -1)
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """For sorted keys: which of them the store has, and their values (0 for the others)."""
        found = np.zeros(len(keys), bool)
        values = {c: np.zeros(len(keys), t) for c, t in self.columns.items()}
        shards = self.shards_of(keys)
        for shard in np.unique(shards):
            lo, hi = np.searchsorted(shards, [shard, shard + 1])
            held = self.array(int(shard), "key")
            if not len(held):
                continue
            at = np.searchsorted(held, keys[lo:hi])
            at[at == len(held)] = 0
            hit = np.asarray(held[at]) == keys[lo:hi]
            found[lo:hi] = hit
            for column, out in values.items():
                out[lo:hi][hit] = self.array(int(shard), column)[at[hit]]
        return found, values
