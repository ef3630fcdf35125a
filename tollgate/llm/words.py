"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``; in UTF-8 these bytes
never occur inside another character, so bytes and code points give the same
words.  Every word gets a 64-bit hash: a polynomial over byte values, taken for
all words at once as a difference of prefix sums, then mixed.  Equal words have
equal hashes in every task, on every machine.

Nulls count as empty texts, empty texts have no words, and texts of any length
are handled whole: prefix sums run over pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PIECE = 1 << 19
BLOCK = 3 << 20
_P = 0x9E3779B97F4A7C15 | 1
_M64 = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLE = np.random.Generator(np.random.PCG64(20240501)).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
_POW: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _POW:
        _POW.extend((_powers(_P, PIECE), _powers(pow(_P, -1, 1 << 64), PIECE)))
    return _POW


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; a bijection for each seed."""
    h = h ^ np.uint64((seed * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & _M64)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span data[starts[i]:ends[i]]; spans ascend and don't overlap."""
    power, inverse = _tables()
    out = np.zeros(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + PIECE, "right"))
        if j <= i:  # one span longer than a piece
            h, at = 0, base
            while at < ends[i]:
                part = _TABLE[data[at : min(at + PIECE, int(ends[i]))]]
                h = (h + int((part * power[: len(part)]).sum(dtype=np.uint64)) * pow(_P, at - base, 1 << 64)) & _M64
                at += PIECE
            out[i] = h
            i += 1
            continue
        sums = np.zeros(int(ends[j - 1]) - base + 1, np.uint64)
        np.cumsum(_TABLE[data[base : ends[j - 1]]] * power[: len(sums) - 1], out=sums[1:])
        s = starts[i:j] - base
        out[i:j] = (sums[ends[i:j] - base] - sums[s]) * inverse[s]
        i = j
    return mix(out ^ (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the len + 1 offsets; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if large else np.int32
    _, off, data = texts.buffers()
    if not len(texts) or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """data: bytes; offsets: of texts; starts, ends: of words; first: index of each text's first word, and the number of words."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def words(texts: pa.Array, lower: bool = False, marks: np.ndarray = SPACES) -> Words:
    """marks: of 256 bytes, those that no word has."""
    data, offsets = buffers(texts)
    if lower and len(data):
        data = LOWER[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, np.zeros(len(offsets), np.int64))
    word = ~marks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = word[1:] != word[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    inside = word[at[:-1]]
    starts, ends = at[:-1][inside], at[1:][inside]
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def blocks(batch: pa.RecordBatch, column: str = "text", size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text and a row at least."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def grams(h: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hashes of the n-word windows that start at each word; len(h) - n + 1 of them, across texts too."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    factor = np.uint64(0x9E6C63D0876A9A35)
    for k in range(n):
        out = out * factor + h[k : k + len(out)]
    return mix(out, seed)


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """Which of the n-word windows lie in one text: a mask over all word positions but the last n - 1."""
    total = int(first[-1])
    if total < n:
        return np.zeros(0, bool)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    return (left >= n)[: total - n + 1]


def group_order(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A permutation that brings equal hashes together, and a mask of the first of each group in it."""
    n = len(h)
    bits = max(1, n.bit_length())
    low = np.uint64((1 << bits) - 1)
    order = (np.sort((h & ~low) | np.arange(n, dtype=np.uint64)) & low).astype(np.int64)
    s = h[order]
    if n > 1 and bool(((s[1:] < s[:-1])).any()):  # unlike hashes share their high bits
        order = np.argsort(h, kind="stable")
        s = h[order]
    head = np.ones(n, bool)
    head[1:] = s[1:] != s[:-1]
    return order, head


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and their counts."""
    s = np.sort(h)
    head = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    return s[head], np.diff(np.append(head, len(s)))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of values; first: where each begins, and the end."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
