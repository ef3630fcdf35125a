"""Sorted hash arrays in the shared folder, memory-mapped by the workers that look things up in them.

A table of (key, values) is range-partitioned by key and every task writes its range as
plain arrays; a rewritten task writes the same files again.  Workers map the files where
the folder is a local path to them, and else map an unlinked local copy.
"""

from __future__ import annotations

import functools
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from tollgate.llm.tables import kept, rows, scratch

ROWS = 4_000_000


def place(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def put(path: str, name: str, data: np.ndarray | pa.Buffer) -> None:
    """Write to a name of its own, then move, so that no half-written file is ever read."""
    where, base = place(path)
    where.create_dir(base, recursive=True)
    own = f"{base}/.{name}-{os.getpid()}-{os.urandom(4).hex()}"
    with where.open_output_stream(own) as out:
        out.write(data if isinstance(data, pa.Buffer) else np.ascontiguousarray(data))
    where.move(own, f"{base}/{name}")


def mapped(path: str, name: str, kind: str) -> np.ndarray:
    where, base = place(path)
    info = where.get_file_info(f"{base}/{name}")
    if not info.size:
        return np.zeros(0, kind)
    if isinstance(where, fs.LocalFileSystem):
        return np.memmap(f"{base}/{name}", kind, "r")
    with tempfile.NamedTemporaryFile() as local, where.open_input_stream(f"{base}/{name}") as source:
        while chunk := source.read(1 << 22):
            local.write(chunk)
        local.flush()
        return np.memmap(local.name, kind, "r")


def write(df: DataFrame, key: str, values: dict[str, str], name: str) -> str:
    """df's keys (long) in ascending order of their unsigned value, and float32 or int64 columns; its path."""
    df = kept(df.select(key, *values), name)
    count = df.count()
    path = scratch(df.sparkSession, name + "-arrays")
    ranged = df.repartitionByRange(max(1, -(-count // ROWS)), key).sortWithinPartitions(key)
    kinds = dict(values)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(b.num_rows for b in parts):
            return
        columns = {c: np.concatenate([b.column(c).to_numpy() for b in parts]) for c in (key, *kinds)}
        first = int(columns[key][0])
        for c, data in columns.items():
            put(path, f"{first + (1 << 63):020d}.{c}", data.astype(kinds.get(c, "<i8")))
        yield rows(first=pa.array([first]))

    where, base = place(path)
    where.create_dir(base, recursive=True)
    ranged.mapInArrow(each, "first long").count()
    return path


def put_counts(path: str, name: str, keys: np.ndarray, counts: np.ndarray) -> None:
    """Counts of ascending keys as bytes, and those that a byte can't hold again with their keys."""
    many = counts >= 255
    put(path, f"{name}.count", np.minimum(counts, 255).astype(np.uint8))
    put(path, f"{name}.more", np.concatenate((keys[many], counts[many])).astype("<i8"))


class Arrays:
    """The arrays of one path; keys ascend as signed numbers.  A column of kind ``count`` is one of ``put_counts``."""

    def __init__(self, path: str, key: str, values: dict[str, str]):
        where, base = place(path)
        names = sorted(x.base_name for x in where.get_file_info(fs.FileSelector(base)) if x.base_name.endswith("." + key) and not x.base_name.startswith("."))
        self.firsts = np.array([int(n.split(".")[0]) - (1 << 63) for n in names], np.int64)
        stored = {c: "u1" if kind == "count" else kind for c, kind in values.items()}
        self.shards = [(mapped(path, n, "<i8"), {c: mapped(path, n.removesuffix(key) + c, kind) for c, kind in stored.items()}) for n in names]
        self.more = [mapped(path, n.removesuffix(key) + "more", "<i8") for n in names] if "count" in values.values() else []
        self.kinds = {c: "<i8" if kind == "count" else kind for c, kind in values.items()}
        self.counted = [c for c, kind in values.items() if kind == "count"]

    def get(self, keys: np.ndarray, missing: dict[str, float]) -> dict[str, np.ndarray]:
        """The values of ascending keys; missing where a key isn't there."""
        out = {c: np.full(len(keys), missing[c], self.kinds[c]) for c in self.kinds}
        cuts = [*np.searchsorted(keys, self.firsts).tolist(), len(keys)]
        for i, ((found, values), a, b) in enumerate(zip(self.shards, cuts, cuts[1:])):
            if b > a:
                at = np.minimum(np.searchsorted(found, keys[a:b]), len(found) - 1)
                hit = np.flatnonzero(found[at] == keys[a:b])
                for c, v in values.items():
                    out[c][a + hit] = v[at[hit]]
                for c in self.counted:
                    many = np.flatnonzero(out[c][a:b] == 255) + a
                    if len(many):
                        large = self.more[i].reshape(2, -1)
                        out[c][many] = large[1][np.searchsorted(large[0], keys[many])]
        return out

    def rank(self, keys: np.ndarray) -> np.ndarray:
        """The places of the ascending keys among all of them, -1 for one that isn't there."""
        out = np.full(len(keys), -1, np.int64)
        cuts = [*np.searchsorted(keys, self.firsts).tolist(), len(keys)]
        before = 0
        for (found, _), a, b in zip(self.shards, cuts, cuts[1:]):
            if b > a:
                at = np.minimum(np.searchsorted(found, keys[a:b]), len(found) - 1)
                hit = found[at] == keys[a:b]
                out[a:b][hit] = before + at[hit]
            before += len(found)
        return out


@functools.lru_cache(maxsize=16)
def opened(path: str, key: str, values: tuple[tuple[str, str], ...]) -> Arrays:
    return Arrays(path, key, dict(values))
