"""Best-fit packing of token pieces by fitted patterns.

The histogram of piece lengths is all that decides a packing.  Patterns of few lengths
that fill a sequence are enumerated, non-negative least squares fits how often each is
used, the repeats are rounded down and what is left of the histogram is packed best-fit.
The result is a table of slots: for every length, ranges of ranks with the sequences and
offsets they take.  Its size depends on the sequence length, not on the corpus, so it is
built on the driver; documents find their place by their rank among pieces of one length,
counted in two levels so that a frequent length doesn't meet in one task.

Cases: a null text is empty, an empty text is one piece with the end id alone; repeated
rows are packed as often as they occur; an empty table gives no rows; other columns are
ignored.  A document of exactly the limit isn't cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.byte_ids import ids_of
from tollgate.llm.tables import arrow_map, kept, rows
from tollgate.llm.words import blocks

BLOCK = 2 << 20


def pieces(docs: DataFrame, tokenizer_path: str, limit: int = 1024, end: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and ``end``, cut into pieces of ``limit`` ids; the first may be shorter."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch, size=BLOCK):
            ids, offsets = ids_of(block.column("text"), tokenizer_path, end)
            n = np.diff(offsets)
            count = (n + limit - 1) // limit
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            first = n[doc] - limit * (count[doc] - 1)
            start = np.where(piece == 0, 0, first + limit * (piece - 1))
            length = np.where(piece == 0, first, limit)
            raw = memoryview(ids.astype("<u4").tobytes())
            at = 4 * (offsets[doc] + start)
            crc = [zlib.crc32(raw[a : a + k]) for a, k in zip(at.tolist(), (4 * length).tolist())]
            yield rows(doc_id=block.column("doc_id").take(pa.array(doc)), piece=pa.array(piece, pa.int32()), start=pa.array(start), length=pa.array(length), ids_crc32=pa.array(crc, pa.int64()))

    return arrow_map(docs.select("doc_id", "text"), cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(limit: int, have: np.ndarray, most: int | None = None) -> list[tuple[int, ...]]:
    """Patterns of few lengths that occur, longest first: all of one to three lengths that fill ``limit`` exactly, and, for tables of short texts, for every length as many as fit with the longest that fits behind them.

    There are about limit ** 2 / 12 patterns of three lengths, whatever the number of texts;
    ``most`` bounds them for very long limits by spreading the shortest length evenly.
    """
    some = np.flatnonzero(have[: limit + 1])
    some = some[some > 0]
    found = {(limit,)} if limit in some else set()
    present = np.zeros(limit + 1, bool)
    present[some] = True
    pairs = some[(2 * some <= limit) & present[limit - some]]
    found.update((limit - a, a) for a in pairs.tolist())
    shortest = some[3 * some <= limit]
    if most is not None and len(shortest):
        shortest = shortest[:: max(1, -(-len(shortest) * len(some) // max(1, most)))]
    for a in shortest.tolist():
        b = some[(some >= a) & (2 * some <= limit - a)]
        b = b[present[limit - a - b]]
        found.update((limit - a - x, x, a) for x in b.tolist())
    for a in some.tolist():
        pattern = [a] * (limit // a)
        rest = limit - a * len(pattern)
        fits = some[some <= rest]
        found.add((*pattern, int(fits[-1])) if len(fits) else tuple(pattern))
    return sorted(found, reverse=True)


def nnls(columns: list[tuple[int, ...]], target: np.ndarray, rounds: int = 2000, close: float = 1e-3) -> np.ndarray:
    """Non-negative x for which the columns' lengths, x times each, come close to the target; by accelerated projected gradients, until a hundred rounds gain less than ``close`` of the error.

    Long lengths weigh more: one that is left over takes a sequence, a short one a gap.
    """
    index = np.array([k for c in columns for k in c])
    owner = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    weight = np.arange(len(target)) / np.sqrt(np.maximum(target, 1.0)) / len(target)

    def times(x: np.ndarray) -> np.ndarray:
        return np.bincount(index, x[owner], len(target)) * weight

    def back(y: np.ndarray) -> np.ndarray:
        return np.bincount(owner, (y * weight)[index], len(columns))

    v = np.ones(len(columns))
    for _ in range(30):  # the largest eigenvalue
        v = back(times(v))
        v /= np.linalg.norm(v) or 1.0
    rate = 1 / max(1e-12, float(v @ back(times(v))) * 1.05)
    x, y, t, want = np.zeros(len(columns)), np.zeros(len(columns)), 1.0, target * weight
    before = float(want @ want)
    for k in range(1, rounds + 1):
        new = np.maximum(0.0, y - rate * back(times(y) - want))
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / s * (new - x), new, s
        if k % 100 == 0:
            error = float(np.square(times(x) - want).sum())
            if before - error <= close * max(before, 1e-9):
                break
            before = error
    return x


def plan(histogram: np.ndarray, limit: int, most: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use up the histogram of lengths 0..limit exactly."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def use(pattern: tuple[int, ...], times: int) -> None:
        out.append((pattern, times))
        for k in pattern:
            left[k] -= times

    found = patterns(limit, left > 0, most)
    if found:
        for pattern, x in zip(found, np.floor(nnls(found, left.astype(float)) + 1e-9).astype(np.int64).tolist()):
            times = min([x, *(int(left[k]) // pattern.count(k) for k in pattern)])
            if times > 0:
                use(pattern, times)
    # best fit for the residuals: start from the longest, then again and again the longest that fits
    for top in range(limit, 0, -1):
        while left[top]:
            pattern, room = [top], limit - top
            spare = left.copy()
            spare[top] -= 1
            while room:
                fits = np.flatnonzero(spare[1 : room + 1])
                if not len(fits):
                    break
                k = int(fits[-1]) + 1
                pattern.append(k)
                spare[k] -= 1
                room -= k
            need = {k: pattern.count(k) for k in pattern}
            use(tuple(pattern), max(1, min(int(left[k]) // v for k, v in need.items())))
    return out


def slots(plan_: list[tuple[tuple[int, ...], int]], limit: int) -> dict[int, np.ndarray]:
    """For each length, columns first rank, first sequence, offset, step: rank r has sequence first + (r - rank) and that offset."""
    table: dict[int, list] = {}
    used = np.zeros(limit + 1, np.int64)
    sequence = 0
    for pattern, times in plan_:
        at = 0
        for k in pattern:
            table.setdefault(k, []).append((int(used[k]), sequence, at))
            used[k] += times
            at += k
        sequence += times
    return {k: np.array(v, np.int64).T for k, v in table.items()}


def pack(docs: DataFrame, tokenizer_path: str, limit: int = 1024, end: int = 2) -> DataFrame:
    """pieces() with sequence_id and offset."""
    cut = kept(pieces(docs, tokenizer_path, limit, end).withColumn("part", F.spark_partition_id()), "pieces")
    counts = kept(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(limit + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``limit`` rows
        histogram[r["length"]] = r["n"]
    table = slots(plan(histogram, limit), limit)
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select("part", "length", F.coalesce(earlier, F.lit(0)).alias("before"))

    def place(part: pa.Table, starts: pa.Table) -> pa.Table:
        """Pieces of one part of the scan; starts: the ranks its lengths begin with."""
        length = part.column("length").to_numpy()
        seen = dict(zip(starts.column("length").to_pylist(), starts.column("before").to_pylist()))
        order = np.argsort(length, kind="stable")
        s = length[order]
        head = [*np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))).tolist(), len(s)] if len(s) else [0]
        sequence, offset = np.empty(len(s), np.int64), np.empty(len(s), np.int64)
        for a, b in zip(head, head[1:]):
            first, base, at = table[int(s[a])]
            rank = seen[int(s[a])] + np.arange(b - a)
            j = np.searchsorted(first, rank, "right") - 1
            sequence[order[a:b]] = base[j] + rank - first[j]
            offset[order[a:b]] = at[j]
        return part.drop_columns(["part"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    columns = cut.select("part", "doc_id", "piece", "start", "length", "ids_crc32")
    return columns.groupBy("part").cogroup(before.groupBy("part")).applyInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
