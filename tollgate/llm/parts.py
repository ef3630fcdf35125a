"""Answers dealt back to the partitions of a table that they are about.

A table is read in several passes.  A pass notes the number of the partition that it reads
(``part``) with what it finds; once found things are joined or counted, the answers are
shuffled by ``part`` and written as one file for each.  The next pass opens the file of its
own partition only, so what a worker holds is bounded by its share of the input, and nothing
is broadcast.  All passes must read one table through the same partitions (``tables.steady``).
None takes that on trust: ``witnessed`` notes which documents each partition has, in which
order, and every pass that notes or uses a partition's number is ``guarded`` by it, so that a
partition which isn't what it was fails the job and never gives a wrong result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tollgate.llm import arrays
from tollgate.llm.tables import arrow_map, rows, scratch
from tollgate.llm.words import mix


def here() -> int:
    """The number of the partition that this task reads."""
    return TaskContext.get().partitionId()


def write(df: DataFrame, name: str, order: tuple[str, ...] = ()) -> str:
    """The path of a file for each ``part`` of df, with its other columns, rows in that order."""
    path = scratch(df.sparkSession, name)
    where, base = arrays.place(path)
    where.create_dir(base, recursive=True)

    def put(part: int, found: list[pa.RecordBatch]) -> pa.RecordBatch:
        out = pa.BufferOutputStream()
        with pa.ipc.new_file(out, found[0].schema) as file:
            for b in found:
                file.write_batch(b)
        arrays.put(path, f"{part}.arrow", out.getvalue())
        return rows(part=pa.array([part], pa.int32()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, found = -1, []
        for batch in batches:
            of = batch.column("part").to_numpy()
            rest = batch.drop_columns(["part"])
            at = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for a, b in zip(at, at[1:]):
                if b > a and of[a] != part:
                    if found:
                        yield put(part, found)
                    part, found = int(of[a]), []
                if b > a:
                    found.append(rest.slice(a, b - a))
        if found:
            yield put(part, found)

    df.repartition("part").sortWithinPartitions("part", *order).mapInArrow(each, "part int").count()
    return path


@functools.lru_cache(maxsize=4)
def opened(path: str, part: int) -> pa.Table | None:
    """The file of a part; None if nothing was found about it."""
    where, base = arrays.place(path)
    name = f"{base}/{part}.arrow"
    if not where.get_file_info(name).size:
        return None
    with where.open_input_file(name) as file:
        return pa.ipc.open_file(file).read_all()


def longs(path: str, column: str) -> np.ndarray:
    """A column of longs of this task's own part, ascending."""
    found = opened(path, here())
    return np.zeros(0, np.int64) if found is None else np.sort(found.column(column).to_numpy())


def among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which of the values are in an ascending array."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ascending, values)
    at[at == len(ascending)] = 0
    return ascending[at] == values


class Witness:
    """A number of rows and a digest of their doc_ids in order."""

    def __init__(self):
        self.n, self.digest = 0, 0

    def see(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("doc_id")
        place = np.arange(self.n, self.n + batch.num_rows, dtype=np.uint64)
        of = mix(ids.fill_null(0).to_numpy().view(np.uint64) ^ mix(place, 91), 93)
        of[ids.is_null().to_numpy(zero_copy_only=False)] ^= np.uint64(0x9FB21C651E98DF25)
        self.n, self.digest = self.n + batch.num_rows, (self.digest + int(of.sum(dtype=np.uint64))) % (1 << 64)


def witnessed(docs: DataFrame) -> str:
    """A path of what each partition of docs (doc_id long) holds."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Witness()
        for batch in batches:
            seen.see(batch)
        yield rows(part=pa.array([here()] if seen.n else [], pa.int32()), n=pa.array([seen.n] if seen.n else [], pa.int64()), digest=pa.array([seen.digest] if seen.n else [], pa.uint64()).view(pa.int64()))

    return write(arrow_map(docs.select("doc_id"), each, "part int, n long, digest long", whole=True), "witness")


def checked(batches: Iterator[pa.RecordBatch], seen: str) -> Iterator[pa.RecordBatch]:
    """The batches, and at their end a refusal if they aren't what this partition held when it was witnessed."""
    now = Witness()
    for batch in batches:
        now.see(batch)
        yield batch
    then = opened(seen, here())
    was = (0, 0) if then is None else (then.column("n")[0].as_py(), then.column("digest")[0].as_py() % (1 << 64))
    if was != (now.n, now.digest):
        raise RuntimeError(f"partition {here()} isn't what it was in the pass before: {now.n} rows, {was[0]} then")


def guarded(f: Callable, seen: str, whole: bool = False) -> Callable:
    """A function for ``arrow_map`` with ``whole`` that gives f all checked batches of a partition, or one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if whole:
            yield from f(checked(batches, seen))
        else:
            for batch in checked(batches, seen):
                yield from f(batch)

    return run
