"""Resampling towards a target distribution with word tries.

A text's features are its runs of one to ``RUN`` consecutive words (digits, letters a-z and all
beyond ASCII, A-Z lower-cased) joined by a space, and a feature falls into one of ``BUCKETS``
by the CRC-32 of its bytes.  Every task builds tries of the words that it reads: a path from
the root is a run of words, its node holds how often the run occurs and the CRC of its bytes,
which is its parent's CRC moved on by the child's word, so no run is ever spelled out.  A trie
lives as long as a span of ``SPAN`` words; only its bucket totals are merged, in the task and
then in Spark.  A bucket's gain compares its share among the target texts with its share among
all texts; it is attached to the nodes when the texts are walked again, and a text's weight is
the sum along its paths.

Gains are an array of ``BUCKETS`` numbers, whatever the input.  Texts are drawn by weight plus
Gumbel noise of a hash of doc_id, the highest first; places are counted in two levels, within
ranges and over ranges, so no task sorts more than its range.

Cases: null and empty texts have no features and weight 0; texts of any length are taken whole, a
span at a time; equal rows are drawn each for itself; a null doc_id hashes as an empty one and
comes after all others in a tie; an empty table gives no rows, and without target texts all
gains come from the texts alone; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.tables import arrow_map, kept, rows
from tollgate.llm.words import Words, blocks, words

RUN, BUCKETS, SPAN = 3, 10_000, 1 << 18
PERCENT, LEAST, SEED = 5, 20, 42
#: What isn't part of a word: all of ASCII but digits and letters a-z.
MARKS = np.zeros(256, bool)
MARKS[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def _advances(lengths: np.ndarray) -> np.ndarray:
    """By length, tables that move a CRC-32 over that many zero bytes, a table for each of its bytes."""
    out = np.zeros((len(lengths), 4, 256), np.uint32)
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    byte = np.arange(256, dtype=np.uint32)

    def apply(matrix: np.ndarray, v: np.ndarray) -> np.ndarray:
        return np.bitwise_xor.reduce(np.where((v[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1), matrix, np.uint32(0)), axis=1)

    one = np.where(bits & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0)) ^ (bits >> np.uint32(1))  # over a zero bit, the reflected polynomial of CRC-32
    for _ in range(3):
        one = apply(one, one)
    for i, length in enumerate(lengths.tolist()):
        matrix, power = bits, one
        while length:
            if length & 1:
                matrix = apply(power, matrix)
            power, length = apply(power, power), length >> 1
        for k in range(4):
            out[i, k] = apply(matrix, byte << np.uint32(8 * k))
    return out


@dataclass
class Trie:
    """Nodes by depth: counts, CRC states, and for every place of the words its node (-1: the run leaves its text)."""

    counts: list[np.ndarray]
    crcs: list[np.ndarray]
    nodes: list[np.ndarray]

    def totals(self) -> np.ndarray:
        """Features by bucket."""
        out = np.zeros(BUCKETS, np.int64)
        for crc, count in zip(self.crcs, self.counts):
            out += np.bincount(crc % np.uint32(BUCKETS), count, BUCKETS).astype(np.int64)
        return out

    def gained(self, gains: np.ndarray) -> np.ndarray:
        """For every place the sum of the gains on the path that begins there."""
        total = np.zeros(len(self.nodes[0]) if self.nodes else 0, np.int64)
        for crc, node in zip(self.crcs, self.nodes):
            there = node >= 0
            total[there] += gains[crc % np.uint32(BUCKETS)][node[there]]
        return total


def trie(w: Words, h: np.ndarray, doc: np.ndarray, a: int, b: int) -> Trie:
    """The trie of the runs that begin at words a to b - 1; h, doc: hashes and texts of all words."""
    end = min(b + RUN - 1, len(h))
    _, example, word = np.unique(h[a:end], return_index=True, return_inverse=True)
    spelled = [w.bytes_of(a + i) for i in example.tolist()]
    alone = np.array([zlib.crc32(s) for s in spelled], np.uint32)
    after = np.array([zlib.crc32(b" " + s) for s in spelled], np.uint32)
    lengths, kind = np.unique(np.array([len(s) + 1 for s in spelled]), return_inverse=True)
    tables = _advances(lengths)
    node, n = word[: b - a].astype(np.int64), len(spelled)
    counts, crcs, nodes = [np.bincount(node, minlength=n)], [alone], [node]
    for depth in range(1, RUN):
        there = np.zeros(b - a, bool)
        last = min(b - a, len(h) - a - depth)
        there[: max(last, 0)] = doc[a : a + last] == doc[a + depth : a + depth + last]
        at = np.flatnonzero(there)
        path = node[at] * n + word[at + depth]
        unique, inverse, count = np.unique(path, return_inverse=True, return_counts=True)
        parent, child = crcs[-1][unique // n], unique % n
        of = kind[child]
        crc = after[child].copy()
        for k in range(4):
            crc ^= tables[of, k, (parent >> np.uint32(8 * k)) & np.uint32(255)]
        node = np.full(b - a, -1, np.int64)
        node[at] = inverse
        counts.append(count)
        crcs.append(crc)
        nodes.append(node)
    return Trie(counts, crcs, nodes)


def tries(block: pa.RecordBatch) -> Iterator[tuple[int, Trie, Words, np.ndarray]]:
    """(first place, trie, words, their texts), span by span of a block's words."""
    w = words(block.column("text"), lower=True, marks=MARKS)
    h, doc = w.hashes(), w.texts()
    for a in range(0, len(h), SPAN):
        yield a, trie(w, h, doc, a, min(a + SPAN, len(h))), w, doc


def totals(texts: DataFrame) -> np.ndarray:
    """Features by bucket of all texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for block in blocks(batch):
                for _, t, _, _ in tries(block):
                    out += t.totals()
        some = np.flatnonzero(out)
        yield rows(bucket=pa.array(some.astype(np.int32)), n=pa.array(out[some]))

    out = np.zeros(BUCKETS, np.int64)
    for r in arrow_map(texts.select("text"), each, "bucket int, n long", whole=True).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``BUCKETS`` rows at the most
        out[r["bucket"]] = r["n"]
    return out


def gains(all_: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight."""
    s, t = all_.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weighed(docs: DataFrame, gains_: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                weight, counts = np.zeros(block.num_rows, np.int64), np.zeros(block.num_rows, np.int64)
                for a, t, w, doc in tries(block):
                    got = t.gained(gains_)
                    np.add.at(weight, doc[a : a + len(got)], got)
                    counts = w.counts
                features = sum(np.maximum(counts - k, 0) for k in range(RUN))
                yield rows(doc_id=block.column("doc_id"), n_words=pa.array(counts), n_features=pa.array(features), weight=pa.array(weight))

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id long, n_words long, n_features long, weight long", whole=True)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def drawn(scored: DataFrame, percent: int, least: int) -> DataFrame:
    """scored (doc_id, n_words, n_features, weight, score) with rank: 1, 2, 3... of the highest scores, as many as are drawn; else null."""
    # numbers only, written so that ranges are found and filled without reading texts again
    sized = kept(scored.withColumn("open", F.col("n_words") >= least), "scored")
    order = [F.desc("open"), F.desc("score"), F.asc_nulls_last("doc_id")]
    ranged = kept(sized.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranged")
    by_range = ranged.groupBy("range").agg(F.count("*").alias("n"), F.count_if("open").alias("open")).orderBy("range").collect()  # a row a range
    take, before, starts = percent * sum(r["open"] for r in by_range) // 100, 0, []
    for r in by_range:
        starts.append((r["range"], before))
        before += r["n"]
    if not take:
        return sized.select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    starts = ranged.sparkSession.createDataFrame(starts, "range int, before long")
    placed = ranged.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy(*order)).cast("long"))
    place = F.col("place") + F.col("before")
    return placed.join(F.broadcast(starts), "range").withColumn("place", place).select(*scored.columns, F.when(F.col("open") & (F.col("place") <= take), F.col("place")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document of docs; target: text."""
    found = weighed(docs, gains(totals(docs), totals(target)))
    return drawn(found.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), percent, least)


def digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score, rank."""
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
