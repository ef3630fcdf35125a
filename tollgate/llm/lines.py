"""Line dedup by a join on deletion neighbourhoods.

A line is what stands between line ends; its words are compared with A-Z lower-cased.  Lines
without words are left alone.  Lines of ``near`` words or more are near when one word
inserted, deleted or replaced turns one into the other; shorter ones must be equal.  A line
goes if a near one stands before it, in the order of (doc_id, line number).

Equal lines are joined first, by 128 bits of their words' hashes, and only the earliest of
them has a neighbourhood: its own words and its words without any one of them, as hashed
keys.  Keys that two lines have are joined; where both left out a word, the distance is one
just if they left out the same place, and where one left out nothing it is always one.  So
the earliest line of each (key, place) and each key decides, and no pair of lines is ever
formed but the one that decides: its edit distance is computed from the words themselves
before the later line goes.

Cases: a null text has no line with words; texts and lines of any length are taken whole;
equal rows with one doc_id don't remove each other's lines, and of unlike texts under one
doc_id the one with the smaller digest comes first; rows with a null doc_id keep all; an empty
table gives no rows; a clashing column is ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm import counting, parts
from tollgate.llm.tables import arrow_map, kept, rows, steady
from tollgate.llm.words import Words, blocks, mix, span_hashes, words

#: Lines of fewer words go if equal; a changed word of very few is another sentence, not a near copy.
NEAR = 10
STEP = 1 << 16
_F = 0x9E6C63D0876A9A35
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lines with words: the first word of each (and the end), its text and its number there."""
    ends = np.flatnonzero(w.data == 10)
    # how many line ends come before each word, counted from its text's beginning
    doc = w.texts()
    number = np.searchsorted(ends, w.starts) - np.searchsorted(ends, w.offsets[:-1])[doc] if len(doc) else doc
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
    at = np.flatnonzero(head)
    return np.append(at, len(doc)), doc[at], number[at]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_F, pow(_F, -1, 1 << 64)):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def neighbourhoods(h: np.ndarray, first: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of whole lines; and, for the chosen lines, line, place and key of each word left out."""
    power, inverse = _powers(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    v = mix(h, 71)
    np.cumsum(v * power[: len(h)], out=total[1:])
    n = np.diff(first)
    whole = mix((total[first[1:]] - total[first[:-1]]) * inverse[first[:-1]] + n.astype(np.uint64) * _LENGTH, 73)
    ends = np.cumsum(n[some])
    size = int(ends[-1]) if len(some) else 0
    line, at, out = np.empty(size, np.int32), np.empty(size, np.int32), np.empty(size, np.uint64)
    begin = 0
    while begin < len(some):  # some lines at a time, so that all steps of them stay small
        done = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + STEP, "right")))
        own = np.repeat(some[begin:end], n[some[begin:end]])
        place = np.arange(done, done + len(own)) - np.repeat(ends[begin:end] - n[some[begin:end]], n[some[begin:end]])
        a, b = first[own], first[own + 1]
        i = a + place
        left = (total[i] - total[a]) * inverse[a]
        right = (total[b] - total[i + 1]) * inverse[np.minimum(a + 1, len(h) + 1)]
        to = slice(done, done + len(own))
        line[to], at[to], out[to] = own, place, mix(left + right + (b - a - 1).astype(np.uint64) * _LENGTH, 73)
        begin = end
    return whole, line, at, out


def uid(doc_id: np.ndarray, number: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix(mix(mix(doc_id.astype(np.uint64), 81) + number.astype(np.uint64), 83) + row.view(np.uint64), 85).view(np.int64)


def _read(block: pa.RecordBatch):
    """Words; and of lines with words the first word, doc_id, number and the text's digest."""
    w = words(block.column("text"), lower=True)
    first, doc, number = lines(w)
    ids = block.column("doc_id").to_numpy()[doc] if len(doc) else np.zeros(0, np.int64)
    row = span_hashes(w.data, w.offsets[:-1], w.offsets[1:]).view(np.int64)[doc]
    return w, first, ids, number, row


def around(block: pa.RecordBatch, late: np.ndarray, near: int):
    """The words and lines of a block; keys of the neighbourhoods that it asks about, with those who leave out nothing first; and of every variant the key, line and place, and which of the asked keys it has.  late: ascending uids of lines that have none."""
    w, first, ids, number, row = _read(block)
    some = np.flatnonzero(np.diff(first) >= near)
    some = some[~parts.among(uid(ids[some], number[some], row[some]), late)]
    h = w.hashes()
    key, line, at, out = neighbourhoods(h, first, some)
    i = first[line] + at
    new = np.ones(len(some) + len(out), bool)
    new[len(some) :] = ~((at > 0) & (h[i] == h[i - 1]))  # else it leaves the same words as the place before
    out = np.concatenate((key[some], out))
    whole = np.full(len(some), -1, np.int32)
    return (w, first, ids, number, row, some), out[new], (out, np.concatenate((some.astype(np.int32), line)), np.concatenate((whole, at)), np.cumsum(new) - 1)


def _second(w: Words, some: slice | np.ndarray = slice(None)) -> np.ndarray:
    """Hashes of words, or of some, from other values of their bytes than w.hashes() has."""
    return mix(span_hashes(w.data ^ np.uint8(0xA5), w.starts[some], w.ends[some]), 77)


def _checks(w: Words, first: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Second keys of the neighbourhoods of some lines: those who leave out nothing first, then each word left out."""
    n = np.diff(first)[some]
    of = np.concatenate(([0], np.cumsum(n)))
    word = np.arange(of[-1]) + np.repeat(first[some] - of[:-1], n)
    key, _, _, out = neighbourhoods(_second(w, word), of, np.arange(len(some)))
    return np.concatenate((key, out))


def within(a: str, b: str) -> bool:
    """Whether one word inserted, deleted or replaced, or none, turns one line into the other."""
    x, y = a.split(" "), b.split(" ")
    if abs(len(x) - len(y)) > 1:
        return False
    short, long = min(len(x), len(y)), max(len(x), len(y))
    head = 0
    while head < short and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < short - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    return long - head - tail <= 1


def verified(pairs: DataFrame) -> DataFrame:
    """doc_id, line, row, part of the pairs (with words and earlier_words) whose edit distance is one at the most."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ok = [within(a, b) for a, b in zip(batch.column("words").to_pylist(), batch.column("earlier_words").to_pylist())]
        yield batch.filter(pa.array(ok, pa.bool_())).select(["doc_id", "line", "row", "part"])

    return arrow_map(pairs.select("doc_id", "line", "row", "part", "words", "earlier_words"), each, "doc_id long, line long, row long, part int")


def removed(docs: DataFrame, seen: str, near: int = NEAR) -> DataFrame:
    """doc_id, line, row (digest of the text), part (of docs): the lines that go; seen: of ``parts.witnessed``."""
    docs = docs.select("doc_id", "text")
    there = lambda block: block.filter(block.column("doc_id").is_valid())

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in map(there, blocks(batch)):
            w, first, ids, number, row = _read(block)
            key, check = (neighbourhoods(h, first, np.zeros(0, np.int64))[0] for h in (w.hashes(), _second(w)))
            yield rows(key=pa.array(key.view(np.int64)), check=pa.array(check.view(np.int64)), doc_id=pa.array(ids, pa.int64()), line=pa.array(number, pa.int64()), row=pa.array(row, pa.int64()), part=pa.array(np.full(len(ids), parts.here()), pa.int32()))

    place = F.struct("doc_id", "line", "row")
    every = kept(arrow_map(docs, parts.guarded(whole, seen), "key long, check long, doc_id long, line long, row long, part int", whole=True), "lines")
    repeated = every.groupBy("key", "check").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    # written, so that both sides of the join are plain exchanges, of which a line that very many documents have is split
    repeated = kept(repeated.select("key", "check", "first"), "repeated")
    late = kept(every.join(repeated, ["key", "check"]).where(place > F.col("first")).select("doc_id", "line", "row", "part"), "late")
    later = parts.write(_uids(late), "late")

    def of(block: pa.RecordBatch):
        return around(there(block), parts.longs(later, "uid"), near)

    ranges = counting.ranges(docs)
    answers = counting.answered(docs, lambda block: of(block)[1], ranges, "variants", seen)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, part = counting.Answers(answers, ranges), parts.here()
        for k, block in enumerate(block for batch in batches for block in blocks(batch, size=counting.ASKS)):
            (w, first, ids, number, row, some), keys, (out, line, at, which) = of(block)
            hit = (asked.counts(k, keys) > 1)[which]
            kept_ = np.unique(line[hit])
            check = _checks(w, first, kept_).view(np.int64)[hit[parts.among(line, kept_)]]
            line = line[hit]
            blob = w.data.tobytes()
            text = [b" ".join(blob[a:b].split()).decode() for a, b in zip(w.starts[first[kept_]].tolist(), w.ends[first[kept_ + 1] - 1].tolist())]
            line, none = np.concatenate((line, kept_)), np.zeros(len(kept_), np.int64)
            yield rows(
                key=pa.array(np.concatenate((out.view(np.int64)[hit], none))),
                check=pa.array(np.concatenate((check, none))),
                place=pa.array(np.concatenate((at[hit], none - 2)), pa.int32()),
                doc_id=pa.array(ids[line], pa.int64()),
                line=pa.array(number[line], pa.int64()),
                row=pa.array(row[line], pa.int64()),
                part=pa.array(np.full(len(line), part), pa.int32()),
                words=pa.array([None] * int(hit.sum()) + text, pa.string()),
            )

    # place -1: the whole line; -2: not a key, but the line's words
    found = kept(arrow_map(docs, parts.guarded(joined, seen, whole=True), "key long, check long, place int, doc_id long, line long, row long, part int, words string", whole=True), "near")
    variants = found.where("place >= -1").drop("words")
    same = variants.groupBy("key", "check", "place").agg(F.min(place).alias("same"))
    sides = variants.groupBy("key", "check").agg(F.min(F.when(F.col("place") < 0, place)).alias("complete"), F.min(F.when(F.col("place") >= 0, place)).alias("cut"))
    first = kept(same.join(sides, ["key", "check"]), "sides")
    before = F.when(F.col("place") < 0, F.col("cut")).otherwise(F.least("same", "complete"))
    met = variants.join(first, ["key", "check", "place"]).withColumn("before", before).where(F.col("before") < place)
    pairs = met.select("doc_id", "line", "row", "part", F.col("before.doc_id").alias("d"), F.col("before.line").alias("l"), F.col("before.row").alias("r")).distinct()
    spelled = found.where("place = -2").groupBy("doc_id", "line", "row").agg(F.min("words").alias("words"))
    earlier = spelled.select(F.col("doc_id").alias("d"), F.col("line").alias("l"), F.col("row").alias("r"), F.col("words").alias("earlier_words"))
    pairs = kept(pairs.join(spelled, ["doc_id", "line", "row"]), "pairs")  # so that lines with one earlier line are split in the second join
    return late.union(verified(pairs.join(earlier, ["d", "l", "r"]))).distinct()


def _uids(gone: DataFrame) -> DataFrame:
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield rows(uid=pa.array(uid(*(batch.column(c).to_numpy() for c in ("doc_id", "line", "row")))), part=batch.column("part"))

    return arrow_map(gone, each, "uid long, part int")


def dedup(docs: DataFrame, columns: tuple[str, ...] = (), near: int = NEAR) -> DataFrame:
    """doc_id, n_lines (with words), n_removed, text of the lines that stay, other columns."""
    kinds = dict(docs.dtypes)
    docs = steady(docs.select("doc_id", "text", *columns))
    seen = parts.witnessed(docs)
    path = parts.write(_uids(removed(docs, seen, near)), "removed")

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        gone = parts.longs(path, "uid")
        for block in blocks(batch):
            w = words(block.column("text"), lower=True)
            _, doc, number = lines(w)
            ids = block.column("doc_id").fill_null(0).to_numpy()
            null = block.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            row = span_hashes(w.data, w.offsets[:-1], w.offsets[1:]).view(np.int64)
            out = parts.among(uid(ids[doc], number, row[doc]), gone) & ~null[doc]
            texts = block.column("text").to_pylist()
            cut: dict[int, set[int]] = {}
            for d, k in zip(doc[out].tolist(), number[out].tolist()):
                cut.setdefault(d, set()).add(k)
            for d, off in cut.items():
                texts[d] = "\n".join(x for k, x in enumerate(texts[d].split("\n")) if k not in off)
            n = np.bincount(doc, minlength=block.num_rows)
            yield rows(doc_id=block.column("doc_id"), n_lines=pa.array(n.astype(np.int64)), n_removed=pa.array(np.bincount(doc[out], minlength=block.num_rows).astype(np.int64)), text=pa.array([t or "" for t in texts], pa.string()), **{c: block.column(c) for c in columns})

    also = "".join(f", `{c}` {kinds[c]}" for c in columns)
    return arrow_map(docs, parts.guarded(each, seen), "doc_id long, n_lines long, n_removed long, text string" + also, whole=True)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256."""
    return dedup(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


