"""Byte-pair encoding by segment trees over the ranks of adjacent pairs, and decoding.

A word's symbols are the leaves' left ends; a leaf holds (rank of the pair that starts
there, place), so the root holds the leftmost merge of lowest rank.  A merge changes at
most three leaves and the paths above them, until the root shows that no pair can merge.
Words of like length are merged together, one tree a row; a few long words are merged one
by one with the same tree.  Every distinct word of a block is encoded once.

Cases: a null text is empty; an empty text has no ids and decodes to an empty text; texts
and words of any length are encoded whole; strings of special tokens are their ids;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tollgate.llm.tables import arrow_map, rows
from tollgate.llm.words import blocks, group_order, sums, words

NONE = np.int64(1) << 62
FEW = 48
BLOCK = 12 << 20


class Merges:
    """A vocabulary with word ends, from a tokenizers file whose normaliser and splitting rule are those of ``SPLIT``."""

    #: The splitting rule of the vocabulary, a fixed value of the format.
    SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, suffix = file["model"], file["model"]["end_of_word_suffix"] or ""
        ids = model["vocab"]
        self.tokens = {i: t for t, i in ids.items()}
        self.special = {x["content"]: x["id"] for x in file["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        codes = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {b: chr(b) for b in codes} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in codes)}
        self.inner = np.array([ids[byte[b]] for b in range(256)], np.int64)
        self.final = np.array([ids[byte[b] + suffix] for b in range(256)], np.int64)
        merges = [(a, b) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        key = (left << 32) | right
        key, rank = np.unique(key, return_index=True)
        self.keys, self.ranks = key, rank.astype(np.int64)
        self.new = np.array([ids[a + b] for a, b in merges], np.int64)
        self.rank_of = dict(zip(key.tolist(), rank.tolist()))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE where there is no merge; ids below 0 are no symbols."""
        key = (left << 32) | (right & 0xFFFFFFFF)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge_one(self, symbols: list[int]) -> list[int]:
        n = len(symbols)
        size = 1 << max(0, (n - 2).bit_length())
        tree = [NONE_INT] * (2 * size)
        get = self.rank_of.get
        for i in range(n - 1):
            r = get(symbols[i] << 32 | symbols[i + 1])
            if r is not None:
                tree[size + i] = r << 32 | i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]

        def put(i: int, left: int, right: int) -> None:
            r = get(symbols[left] << 32 | symbols[right]) if right >= 0 and left >= 0 else None
            i += size
            tree[i] = NONE_INT if r is None else r << 32 | left
            while i > 1:
                i >>= 1
                low = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == low:
                    break
                tree[i] = low

        new = self.new
        while n > 1 and tree[1] != NONE_INT:
            i = tree[1] & 0xFFFFFFFF
            j = after[i]
            symbols[i] = int(new[tree[1] >> 32])
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
            if j < n - 1:
                put(j, -1, -1)
            symbols[j] = -1
            if i < n - 1:
                put(i, i, k)
            if before[i] >= 0:
                put(before[i], before[i], i)
        return [s for s in symbols if s >= 0]

    def merge_many(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols, -1 after the last of a word; merged ids stay where their left end was, -1 elsewhere."""
        rows_, width = symbols.shape
        size = 1 << max(0, (width - 2).bit_length())
        bits = size.bit_length()
        place = np.arange(size, dtype=np.int64)
        tree = np.full((rows_, 2 * size), NONE)
        rank = self.rank(symbols[:, :-1], symbols[:, 1:])
        tree[:, size : size + width - 1] = np.where(rank == NONE, NONE, (rank << bits) | place[: width - 1])
        for level in range(size.bit_length() - 1, 0, -1):
            lo, hi = 1 << (level - 1), 1 << level
            tree[:, lo:hi] = np.minimum(tree[:, 2 * lo : 2 * hi : 2], tree[:, 2 * lo + 1 : 2 * hi : 2])
        after = np.tile(np.append(np.arange(1, width), -1), (rows_, 1))
        before = np.tile(np.arange(-1, width - 1), (rows_, 1))

        def put(row: np.ndarray, i: np.ndarray, value: np.ndarray) -> None:
            i = i + size
            tree[row, i] = value
            for _ in range(size.bit_length() - 1):
                i = i >> 1
                tree[row, i] = np.minimum(tree[row, 2 * i], tree[row, 2 * i + 1])

        live = np.flatnonzero(tree[:, 1] != NONE)
        mask = (1 << bits) - 1
        while len(live):
            root = tree[live, 1]
            i = root & mask
            symbols[live, i] = self.new[root >> bits]
            j = after[live, i]
            k = after[live, j]
            symbols[live, j] = -1
            after[live, i] = k
            has = k >= 0
            before[live[has], k[has]] = i[has]
            inner = j < width - 1
            put(live[inner], j[inner], np.full(int(inner.sum()), NONE))
            right = np.where(has, symbols[live, k], -1)
            r = self.rank(symbols[live, i], right)
            put(live, i, np.where(r == NONE, NONE, (r << bits) | i))
            h = before[live, i]
            has = h >= 0
            row, h, i = live[has], h[has], i[has]
            r = self.rank(symbols[row, h], symbols[row, i])
            put(row, h, np.where(r == NONE, NONE, (r << bits) | h))
            live = live[tree[live, 1] != NONE]
        return symbols

    def encode_words(self, found: list[bytes]) -> list[list[int]]:
        """The ids of each word, given in the bytes of its normal form."""
        out: list[list[int]] = [[]] * len(found)
        lengths = np.array([len(x) for x in found], np.int64)
        klass = np.array([max(1, int(n) - 1).bit_length() for n in lengths]) if len(found) else lengths
        for c in np.unique(klass).tolist():
            some = np.flatnonzero(klass == c)
            if len(some) < FEW or c > 6:
                for i in some.tolist():
                    codes = np.frombuffer(found[i], np.uint8)
                    out[i] = self.merge_one([*self.inner[codes[:-1]].tolist(), int(self.final[codes[-1]])])
                continue
            width = max(2, int(lengths[some].max()))
            step = max(FEW, (1 << 20) // width)
            for a in range(0, len(some), step):
                part = some[a : a + step]
                n = lengths[part]
                stop = np.cumsum(n)
                raw = np.frombuffer(b"".join([found[i] for i in part.tolist()]), np.uint8)
                row = np.repeat(np.arange(len(part)), n)
                col = np.arange(len(raw)) - np.repeat(stop - n, n)
                symbols = np.full((len(part), width), -1, np.int64)
                symbols[row, col] = self.inner[raw]
                symbols[np.arange(len(part)), n - 1] = self.final[raw[stop - 1]]
                symbols = self.merge_many(symbols)
                there = symbols >= 0
                ids, ends = symbols[there].tolist(), np.cumsum(there.sum(1)).tolist()
                for i, lo, hi in zip(part.tolist(), [0, *ends], ends):
                    out[i] = ids[lo:hi]
        return out

    def pieces(self, text: str) -> list[bytes | int]:
        """What a text without ASCII white space is split into: words in their normal form, ids of special tokens."""
        if self.cut and "<" in text:
            parts = self.cut.split(text)
            if len(parts) > 1:
                return [y for x in parts for y in ([self.special[x]] if x in self.special else self.pieces_plain(x))]
        return self.pieces_plain(text)

    def pieces_plain(self, text: str) -> list[bytes | int]:
        text = unicodedata.normalize("NFC", text)
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return [x.encode() for x in self.SPLIT.findall(text)]


NONE_INT = 1 << 62


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def encode_texts(texts: pa.Array, path: str) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """For each text: decimal ids joined by a space, tokens joined by a space, and the number of ids."""
    m, w = merges(path), words(texts)
    order, head = group_order(w.hashes())
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(head) - 1
    some = order[head]
    blob = w.data.tobytes()
    split = [m.pieces(blob[a:b].decode()) for a, b in zip(w.starts[some].tolist(), w.ends[some].tolist())]
    known = {x: i for i, x in enumerate(dict.fromkeys(x for p in split for x in p if isinstance(x, bytes)))}
    encoded = m.encode_words(list(known))
    name = {}
    for i, t in m.tokens.items():
        name[i] = (b"%d " % i, t.encode() + b" ")
    ready = [(b"".join([name[i][0] for i in x]), b"".join([name[i][1] for i in x]), len(x)) for x in encoded]
    whole = [[ready[known[x]] if isinstance(x, bytes) else (*name[x], 1) for x in p] for p in split]
    n = np.array([sum(x[2] for x in p) for p in whole], np.int64)
    as_ids, as_tokens = (np.array([p[0][k] if len(p) == 1 else b"".join([x[k] for x in p]) for p in whole] + [b""], object)[:-1] for k in (0, 1))
    ids, tokens = [], []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        at = which[a:b]
        ids.append(b"".join(as_ids[at].tolist())[:-1])
        tokens.append(b"".join(as_tokens[at].tolist())[:-1])
    return ids, tokens, sums(n[which], w.first)


def decode(ids: list[int], path: str) -> str:
    """The library's text of ids where a file names no decoder: the tokens, joined by a space."""
    return " ".join(merges(path).tokens[i] for i in ids)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: every whole text encoded."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch, size=BLOCK):
            ids, _, _ = encode_texts(block.column("text"), path)
            yield rows(doc_id=block.column("doc_id"), ids=pa.array([[int(x) for x in i.split()] for i in ids], pa.list_(pa.int32())))

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text, without shipping either."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch, size=BLOCK):
            ids, tokens, n = encode_texts(block.column("text"), path)
            yield rows(doc_id=block.column("doc_id"), n_tokens=pa.array(n, pa.int64()), ids_sha256=pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), decoded_sha256=pa.array([hashlib.sha256(x).hexdigest() for x in tokens], pa.string()))

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
