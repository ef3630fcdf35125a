"""Substring dedup on a log-structured index of window fingerprints.

A window is ``WINDOW`` consecutive words.  Its fingerprint is the least hash among the
``GRAM``-word sequences in it, so equal windows have equal fingerprints and neighbours
mostly share theirs: the index holds about one fingerprint for five windows.  Every batch
of documents is written as a sorted, bucketed, immutable run of fingerprints, one row for
all documents of a block of texts that have one, so a passage that very many documents share
stays small.  A new run is merge-joined with the runs before it, bucket by bucket without a
shuffle; windows with a fingerprint that another document has too are candidates.  More than
``fanout`` runs are compacted.

The candidates of all batches are verified in one pass over the texts: each one's own 96-bit
hash is joined to the first document that has it, and all but those in the first document are
removed.  What a partition of the table is asked for, and what it loses, comes back to it as
a file of its own (``parts``), so no text is shuffled.

Whole copies, which have no window of their own, are found by digests of all words first,
so a group of copies costs one row a document.

Cases: a null text has no words; texts under ``WINDOW`` words have no window; texts of any
length are taken whole; every row is judged by itself, so equal rows with one doc_id don't
remove each other's words; an empty table gives no rows; a document with a null doc_id keeps
all words and takes none from others; other columns are ignored.  Batches must come in
ascending order of doc_id.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import parts
from tollgate.llm.tables import arrow_map, kept, rows, steady
from tollgate.llm.words import Words, blocks, grams, inside, mix, words

WINDOW, GRAM = 13, 4
BATCHES, FANOUT = 4, 2


def least_grams(h: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The least gram hash in each window."""
    g = grams(h, gram)
    wide, have = window - gram + 1, 1
    while have * 2 <= wide:
        g = np.minimum(g[:-have], g[have:])
        have *= 2
    return np.minimum(g[: len(g) - (wide - have)], g[wide - have :]) if wide > have else g


def digests(w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's words in their order."""
    place = np.arange(len(h)) - np.repeat(w.first[:-1], w.counts)
    out = []
    for seed in (31, 37):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h + place.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25), seed), out=total[1:])
        out.append(mix(total[w.first[1:]] - total[w.first[:-1]] + w.counts.astype(np.uint64), seed).view(np.int64))
    return out[0], out[1]


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks, and the numbers of their rows in the partition."""
    n = 0
    for batch in batches:
        for block in blocks(batch):
            yield block, np.arange(n, n + block.num_rows, dtype=np.int32)
            n += block.num_rows


def whole_copies(docs: DataFrame, seen: str) -> DataFrame:
    """part, row of the rows whose words are all those of a document with a smaller doc_id."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row in numbered(batches):
            w = words(block.column("text"))
            a, b = digests(w, w.hashes())
            yield rows(doc_id=block.column("doc_id"), a=pa.array(a), b=pa.array(b), part=pa.array(np.full(len(row), parts.here()), pa.int32()), row=pa.array(row))

    found = kept(arrow_map(docs.select("doc_id", "text"), parts.guarded(each, seen, whole=True), "doc_id long, a long, b long, part int, row int", whole=True), "digests").where("doc_id is not null")
    first = found.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    first = kept(first.select("a", "b", "first"), "first")
    return found.join(first, ["a", "b"]).where("doc_id > first").select("part", "row")


def windows_of(block: pa.RecordBatch, row: np.ndarray, copies: str | None) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's rows that have a doc_id and aren't copies: doc_ids, rows, words and their hashes; each window's first word, text and fingerprint."""
    there = block.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    if copies:
        there &= ~parts.among(row.astype(np.int64), parts.longs(copies, "row"))
    block, row = block.filter(pa.array(there)), row[there]
    w = words(block.column("text"))
    h = w.hashes()
    ok = inside(w.first, WINDOW)
    at = np.flatnonzero(ok)
    fp = least_grams(h, WINDOW, GRAM)[: len(ok)][ok].view(np.int64) if len(ok) else np.zeros(0, np.int64)
    return block.column("doc_id").to_numpy(), row, w, h, at, w.texts()[at], fp


def window_keys(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of the windows whose first words are at these places, as a long and an int."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return grams(h, WINDOW, 3)[at].view(np.int64), (grams(mix(h, 77), WINDOW, 5)[at] >> np.uint64(33)).astype(np.int32)


def prints(docs: DataFrame, copies: str | None, bounds: list[int] = (), seen: str | None = None) -> DataFrame:
    """fp, part, batch, least, most: the fingerprints of the windows of documents that aren't copies, with the smallest and largest doc_id of a block that have each (most is null where that is one document); bounds: the last doc_ids of all batches but the last."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row in numbered(batches):
            ids, _, _, _, _, doc, fp = windows_of(block, row, copies)
            batch = np.searchsorted(np.array(bounds, np.int64), ids, "left")
            new = np.ones(len(fp), bool)  # neighbours mostly share theirs
            new[1:] = (fp[1:] != fp[:-1]) | (doc[1:] != doc[:-1])
            fp, doc = fp[new], doc[new]
            order = np.lexsort((ids[doc], fp, batch[doc]))
            fp, of, b = fp[order], ids[doc[order]], batch[doc[order]]
            head = np.ones(len(fp), bool)
            head[1:] = (fp[1:] != fp[:-1]) | (b[1:] != b[:-1])
            last = np.append(head[1:], True) if len(fp) else head
            yield rows(fp=pa.array(fp[head]), part=pa.array(np.full(int(head.sum()), parts.here()), pa.int32()), batch=pa.array(b[head], pa.int32()), least=pa.array(of[head]), most=pa.array(of[last], mask=of[head] == of[last]))

    return arrow_map(docs.select("doc_id", "text"), parts.guarded(each, seen, whole=True) if seen else each, "fp long, part int, batch int, least long, most long", whole=True)


class FingerprintIndex:
    """Runs of (fp, part, least, most), each a table of the warehouse, bucketed and sorted by fp; its files go when it is dropped."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.runs: list[str] = []
        self.last: int | None = None  # the largest doc_id so far
        self.compactions = 0

    def _write(self, df: DataFrame) -> str:
        name = f"run_{uuid.uuid4().hex}"
        sorted_ = df.select("fp", "part", "least", "most").repartition(self.buckets, "fp").sortWithinPartitions("fp")
        sorted_.write.bucketBy(self.buckets, "fp").sortBy("fp").saveAsTable(name)
        return name

    def add(self, batch: DataFrame) -> DataFrame:
        """Append the ``prints`` of a batch as a run; part, fp of all documents so far whose windows with that fingerprint are candidates now."""
        lo, hi = batch.agg(F.min("least"), F.max(F.coalesce("most", "least"))).first()
        if lo is not None and self.last is not None and lo <= self.last:
            raise ValueError(f"a batch begins at {lo}, the index ends at {self.last}")
        self.last = hi if hi is not None else self.last
        name = self._write(batch)
        run = self.spark.table(name)
        new = run.groupBy("fp").agg(F.min("least").alias("least"), F.max(F.coalesce("most", "least")).alias("most"))
        asked = new.where("least < most").select("fp")
        out = None
        for r in self.runs:
            older = self.spark.table(r).join(new.select("fp"), "fp", "left_semi").select("part", "fp")
            out = older if out is None else out.union(older)
        if out is not None:
            out = kept(out, "older")
            asked = asked.union(out.select("fp"))
        now = run.join(asked.distinct(), "fp", "left_semi").select("part", "fp")
        out = kept(now if out is None else out.union(now), "asked")
        self.runs.append(name)
        if len(self.runs) > self.fanout:
            self.compact()
        return out

    def compact(self) -> None:
        """All runs merged into one; the old ones are dropped after it is written."""
        merged = self.spark.table(self.runs[0])
        for r in self.runs[1:]:
            merged = merged.union(self.spark.table(r))
        name = self._write(merged)
        self.close()
        self.runs = [name]
        self.compactions += 1

    def close(self) -> None:
        for r in self.runs:
            self.spark.sql(f"drop table if exists {r}")
        self.runs = []


def candidates(docs: DataFrame, asked: str, copies: str | None, seen: str) -> DataFrame:
    """h1, h2, doc_id, part, row, pos: hashes of the windows whose fingerprint their part is asked for."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = parts.longs(asked, "fp")
        for block, row in numbered(batches):
            if not len(wanted):
                continue
            ids, row, w, h, at, doc, fp = windows_of(block, row, copies)
            hit = np.flatnonzero(parts.among(fp, wanted))
            at, doc = at[hit], doc[hit]
            h1, h2 = window_keys(h, at)
            yield rows(h1=pa.array(h1), h2=pa.array(h2), doc_id=pa.array(ids[doc]), part=pa.array(np.full(len(at), parts.here()), pa.int32()), row=pa.array(row[doc]), pos=pa.array((at - w.first[doc]).astype(np.int32)))

    return arrow_map(docs.select("doc_id", "text"), parts.guarded(each, seen, whole=True), "h1 long, h2 int, doc_id long, part int, row int, pos int", whole=True)


def repeats(found: DataFrame) -> DataFrame:
    """part, row, pos of windows that a document with a smaller doc_id has.

    The first document of each window is aggregated before the shuffle and written, so that both
    sides of the join are plain exchanges, of which a window that very many documents have is split.
    """
    found = kept(found, "candidates")
    least = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    least = kept(least.select("h1", "h2", "first"), "first")
    return found.join(least, ["h1", "h2"]).where("doc_id > first").select("part", "row", "pos")


def removals(docs: DataFrame, seen: str, batches: int = BATCHES, fanout: int = FANOUT) -> tuple[DataFrame, str]:
    """(part, row, pos of the windows to remove), and a path of the rows that are whole copies; documents go into the index by batches of ascending doc_id."""
    spark = docs.sparkSession
    copies = parts.write(whole_copies(docs, seen), "copies")
    cuts = [] if batches < 2 else docs.where("doc_id is not null").approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)
    bounds = sorted({int(c) for c in cuts})
    all_prints = kept(prints(docs, copies, bounds, seen), "prints")
    index = FingerprintIndex(spark, int(spark.conf.get("spark.sql.shuffle.partitions")), fanout)
    out = None
    try:
        for i in range(len(bounds) + 1):
            asked = index.add(all_prints.where(F.col("batch") == i))
            out = asked if out is None else out.union(asked)
    finally:
        index.close()
    asked = parts.write(out.distinct(), "asked")
    return repeats(candidates(docs, asked, copies, seen)), copies


def _spaced(raw: bytes, cover: np.ndarray) -> bytes:
    """The kept words, each with the white space after it."""
    return b"".join(x for x, c in zip(re.findall(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", raw), cover.tolist()) if not c).strip()


def _cover(pos: np.ndarray, n: int) -> np.ndarray:
    step = np.zeros(n + WINDOW + 1, np.int64)
    pos = pos[pos < n]
    np.add.at(step, pos, 1)
    np.add.at(step, pos + WINDOW, -1)
    return np.cumsum(step)[:n] > 0


def without(docs: DataFrame, marks: str, copies: str, seen: str, columns: tuple[str, ...] = (), spacing: bool = False) -> DataFrame:
    """What ``dedup`` returns, of steady docs; paths of ``parts``: marks of the windows to remove by row, and copies of the rows that are whole copies."""
    kinds = dict(docs.dtypes)

    def finish(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = parts.opened(marks, parts.here())
        at, pos = (np.zeros(0, np.int32),) * 2 if table is None else (table.column(c).to_numpy() for c in ("row", "pos"))
        for block, row in numbered(batches_):
            copy = parts.among(row.astype(np.int64), parts.longs(copies, "row"))
            first = np.searchsorted(at, np.append(row, row[-1] + 1))
            text, n, gone = [], [], []
            for raw, whole, a, b in zip(block.column("text").to_pylist(), copy.tolist(), first[:-1].tolist(), first[1:].tolist()):
                raw = (raw or "").encode()
                found = raw.split()  # of bytes: at \x20 and \x09-\x0D
                count = len(found)
                cover = np.full(count, count >= WINDOW) if whole else _cover(pos[a:b].astype(np.int64), count)
                left = [x for x, c in zip(found, cover.tolist()) if not c] if whole or b > a else found
                text.append((b" ".join(left) if not spacing else raw if len(left) == count else _spaced(raw, cover)).decode())
                n.append(count)
                gone.append(count - len(left))
            yield rows(doc_id=block.column("doc_id"), n_words=pa.array(n, pa.int64()), n_removed=pa.array(gone, pa.int64()), text=pa.array(text, pa.string()), **{c: block.column(c) for c in columns})

    also = "".join(f", `{c}` {kinds[c]}" for c in columns)
    return arrow_map(docs, parts.guarded(finish, seen, whole=True), "doc_id long, n_words long, n_removed long, text string" + also, whole=True)


def dedup(docs: DataFrame, batches: int = BATCHES, columns: tuple[str, ...] = (), spacing: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, text, other columns; text is the kept words joined by one space, or with ``spacing`` by the white space that followed them."""
    docs = steady(docs.select("doc_id", "text", *columns))
    seen = parts.witnessed(docs)
    found, copies = removals(docs, seen, batches)
    return without(docs, parts.write(found, "repeats", ("row",)), copies, seen, columns, spacing)


def digest(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    out = dedup(docs, batches)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
