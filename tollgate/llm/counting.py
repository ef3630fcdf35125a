"""Exact counts of 64-bit keys over all texts.

Every block of texts counts its own keys first, so that a frequent key costs one entry a
block, and ships them sorted, packed and cut by key range.  There are as many ranges as the
texts' bytes ask for, so a range is of one size whatever the table's; Spark shuffles and
sorts the packs by range and each task adds up one range at a time.  ``answered`` sends the
sums back to the blocks that asked, so that no task ever holds a table of all keys.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm import parts
from tollgate.llm.tables import arrow_map, rows
from tollgate.llm.words import blocks, distinct, group_order

BLOCK = 6 << 20
ASKS = 3 << 20  # bytes of text in the blocks that ``answered`` answers: a worker holds about 20 times as many for one
RANGE = 12 << 20  # bytes of text for each range
TASKS = 20_000


def ranges(docs: DataFrame) -> int:
    """How many ranges the texts' bytes ask for."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, -(-size // RANGE))


def pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending distinct keys as differences of as few bytes as they need; counts as bytes, the large ones after them."""
    step = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(step.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes(), pack_counts(counts)


def pack_counts(counts: np.ndarray) -> bytes:
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype("<i8").tobytes()


def unpack_counts(counts: bytes, n: int) -> np.ndarray:
    small = np.frombuffer(counts, np.uint8, n)
    count = small.astype(np.int64)
    count[small == 255] = np.frombuffer(counts, "<i8", offset=n)
    return count


def unpack(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = keys[0]
    raw = np.frombuffer(keys, np.uint8, offset=1).reshape(-1, width)
    step = np.zeros((len(raw), 8), np.uint8)
    step[:, :width] = raw
    return np.cumsum(step.reshape(-1).view("<u8")), unpack_counts(counts, len(raw))


def added(packs: Iterator[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts of equal keys, keys ascending; packs are merged two by two to keep memory near the result's size."""
    parts_: list[tuple[np.ndarray, np.ndarray]] = []
    for p in packs:
        parts_.append(unpack(*p))
        while len(parts_) > 1 and len(parts_[-2][0]) <= 2 * len(parts_[-1][0]):
            parts_.append(_merged(parts_.pop(), parts_.pop()))
    while len(parts_) > 1:
        parts_.append(_merged(parts_.pop(), parts_.pop()))
    return parts_[0] if parts_ else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate((a[0], b[0]))
    order = np.argsort(key, kind="stable")
    key, count = key[order], np.concatenate((a[1], b[1]))[order]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[head], np.add.reduceat(count, head) if len(head) else count


def pieces(keys: np.ndarray, buckets: int) -> tuple[list[int], list[int]]:
    """The ranges that ascending keys fall into, and where each range's begin, and the end: ranges without a key cost nothing."""
    of = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    head = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    return of[head].tolist(), [*head.tolist(), len(keys)]


def packs(docs: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], buckets: int, seen: str | None = None, size: int = BLOCK) -> DataFrame:
    """bucket, part, block, keys, counts: what each block (of ``size`` bytes) has of each key range, dealt by range; seen: of ``parts.witnessed``, where parts matter."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = parts.here()
        for n, block in enumerate(block for batch in batches for block in blocks(batch, size=size)):
            keys, counts = distinct(keys_of(block))
            own, at = pieces(keys, buckets)
            found = [(i, *pack(keys[a:b], counts[a:b])) for i, a, b in zip(own, at, at[1:])]
            yield rows(
                bucket=pa.array([x[0] for x in found], pa.int32()),
                part=pa.array([part] * len(found), pa.int32()),
                block=pa.array([n] * len(found), pa.int32()),
                keys=pa.array([x[1] for x in found], pa.binary()),
                counts=pa.array([x[2] for x in found], pa.binary()),
            )

    dealt = arrow_map(docs, parts.guarded(each, seen, whole=True) if seen else each, "bucket int, part int, block int, keys binary, counts binary", whole=True)
    return dealt.repartition(min(buckets, TASKS), "bucket").sortWithinPartitions("bucket", "part", "block")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, int, bytes, bytes]]]]:
    """(bucket, its packs) of a partition sorted by bucket, one bucket after another; each must be read to its end."""
    flat = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "part", "block")), batch.column("keys"), batch.column("counts")))
    for bucket, group in itertools.groupby(flat, lambda x: x[0]):
        yield bucket, ((p, b, k.as_py(), c.as_py()) for _, p, b, k, c in group)


def counts(docs: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], buckets: int) -> DataFrame:
    """key, count of all keys; key is the unsigned key's bits as a long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in by_bucket(batches):
            keys, count = added((k, c) for _, _, k, c in group)
            yield rows(key=pa.array(keys.view(np.int64)), count=pa.array(count))

    return packs(docs, keys_of, buckets).mapInArrow(each, "key long, count long")


def answered(docs: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], buckets: int, name: str, seen: str) -> str:
    """Counts all keys; a path of ``parts`` files that tell every block (of ``ASKS`` bytes) which of its distinct keys occur twice or more, and how often."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, group in by_bucket(batches):
            asked, keys, counts = [], [], []
            for part, block, k, c in group:
                key, count = unpack(k, c)
                asked.append((part, block, len(key)))
                keys.append(key)
                counts.append(count)
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            head = np.ones(len(key), bool)
            head[1:] = key[order[1:]] != key[order[:-1]]
            total = np.empty(len(key), np.int64)
            total[order] = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(head))[np.cumsum(head) - 1]
            ends = np.cumsum([n for _, _, n in asked])
            of = [total[b - n : b] for (_, _, n), b in zip(asked, ends.tolist())]
            yield rows(
                part=pa.array([p for p, _, _ in asked], pa.int32()),
                block=pa.array([b for _, b, _ in asked], pa.int32()),
                bucket=pa.array([bucket] * len(asked), pa.int32()),
                n=pa.array([n for _, _, n in asked], pa.int32()),
                shared=pa.array([np.packbits(t > 1).tobytes() for t in of], pa.binary()),
                counts=pa.array([pack_counts(t[t > 1]) for t in of], pa.binary()),
            )

    back = packs(docs, keys_of, buckets, seen, ASKS).mapInArrow(each, "part int, block int, bucket int, n int, shared binary, counts binary")
    return parts.write(back, name, ("block", "bucket"))


class Answers:
    """What ``answered`` found for the blocks of this task's part."""

    def __init__(self, path: str, buckets: int):
        self.buckets = buckets
        table = parts.opened(path, parts.here())
        none = pa.table({c: pa.array([], t) for c, t in (("block", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("shared", pa.binary()), ("counts", pa.binary()))})
        self.table = none if table is None else table
        self.block = self.table.column("block").to_numpy()

    def counts(self, block: int, keys: np.ndarray) -> np.ndarray:
        """How often each of a block's keys occurs in all texts; keys: what ``keys_of`` gives for the block, in any order and with repeats."""
        order, head = group_order(keys)
        own = keys[order[head]]
        of, at = pieces(own, self.buckets)
        asked = [(i, b - a) for i, a, b in zip(of, at, at[1:])]
        lo, hi = np.searchsorted(self.block, [block, block + 1]).tolist()
        found = self.table.slice(lo, hi - lo)
        if list(zip(found.column("bucket").to_pylist(), found.column("n").to_pylist())) != asked:
            raise RuntimeError("a partition isn't what it was in the pass before")
        total = np.ones(len(own), np.int64)
        a = 0
        for (_, n), shared, counts in zip(asked, found.column("shared").to_pylist(), found.column("counts").to_pylist()):
            some = np.flatnonzero(np.unpackbits(np.frombuffer(shared, np.uint8), count=n))
            total[a + some] = unpack_counts(counts, len(some))
            a += n
        out = np.empty(len(keys), np.int64)
        out[order] = total[np.cumsum(head) - 1]
        return out
