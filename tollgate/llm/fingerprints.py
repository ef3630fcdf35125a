"""Threshold-scaled sketches of documents.

A text's shingles are its windows of five words, A-Z lower-cased (with one to four words
the whole sequence).  The sketch keeps every shingle hash below ``fraction`` of the hash
range, so it grows with the text, the sketch of a union is the union of sketches, and the
share of a small text inside a much larger one can be estimated as well as likeness.

A fingerprint is ``<digest of the text>:<number of shingles>:<base64 of kept hashes>``,
hashes as ascending little-endian 32-bit numbers.  Likeness is the kept hashes' Jaccard
similarity; where neither text kept a hash it is 1 for equal texts and 0 for others.

Cases: a null text is empty; an empty text keeps no hash; texts of any length are taken
whole; rows with one doc_id follow each other in the order of their texts' digests; a null
doc_id comes after all others; an only document is its own next; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.tables import arrow_map, rows
from tollgate.llm.words import blocks, grams, group_order, inside, mix, words

SHINGLE = 5
FRACTION = 0.25
BLOCK = 6 << 20


def sketches(texts: pa.Array, fraction: float = FRACTION, n: int = SHINGLE) -> tuple[list[np.ndarray], np.ndarray]:
    """The kept hashes of each text, ascending, and its number of distinct shingles."""
    w = words(texts, lower=True)
    h, docs = w.hashes(), len(w.offsets) - 1
    ok = inside(w.first, n)
    value, doc = grams(h, n)[ok], w.texts()[: len(ok)][ok]
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        whole = np.array([int(mix(np.bitwise_xor.reduce(mix(h[a:b], 7) * np.arange(3, 2 * (b - a) + 3, 2, dtype=np.uint64), keepdims=True), 9)[0]) for a, b in zip(w.first[short].tolist(), w.first[short + 1].tolist())], np.uint64)
        value, doc = np.concatenate((value, whole)), np.concatenate((doc, short))
    order, head = group_order(mix(value ^ mix(doc.astype(np.uint64), 41), 43))
    some = order[head]  # each text's distinct hashes
    value, doc = value[some], doc[some]
    count = np.bincount(doc, minlength=docs)
    limit = int(fraction * 2.0**64)
    low = np.flatnonzero(value <= np.uint64(limit - 1))
    # whole numbers only, so that a hash is kept as the same number whatever lies beside its text
    kept = (value[low] // np.uint64(-(-limit // (1 << 32)))).astype(np.uint32)
    doc = doc[low]
    by_doc = np.argsort(doc, kind="stable")
    kept, at = kept[by_doc], np.searchsorted(doc[by_doc], np.arange(docs + 1))
    return [np.unique(kept[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], count


def fingerprint(text: bytes, kept: np.ndarray, shingles: int) -> str:
    return f"{hashlib.blake2b(text, digest_size=8).hexdigest()}:{shingles}:{base64.b64encode(kept.astype('<u4').tobytes()).decode()}"


def read(fingerprint_: str) -> tuple[str, int, np.ndarray]:
    digest, shingles, kept = fingerprint_.split(":")
    return digest, int(shingles), np.frombuffer(base64.b64decode(kept), "<u4")


def shared(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int((a[at] == b).sum())


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, 0 to 1."""
    (x, _, p), (y, _, q) = read(a), read(b)
    return _likeness(x == y, p, q)


def containment(a: str, b: str) -> float:
    """The estimated share of a's shingles that b has."""
    (x, _, p), (y, _, q) = read(a), read(b)
    return shared(p, q) / len(p) if len(p) else float(x == y)


def merged(a: str, b: str) -> np.ndarray:
    """The kept hashes of the two texts' shingles together."""
    return np.union1d(read(a)[2], read(b)[2])


def _likeness(equal: bool, p: np.ndarray, q: np.ndarray) -> float:
    if equal:
        return 1.0
    both = shared(p, q)
    return both / (len(p) + len(q) - both) if len(p) + len(q) else 0.0


def fingerprints(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """doc_id, n_shingles, fingerprint of every whole text."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch, size=BLOCK):
            kept, count = sketches(block.column("text"), fraction)
            found = [fingerprint(t.encode(), k, c) for t, k, c in zip(block.column("text").to_pylist(), kept, count.tolist())]
            yield rows(doc_id=block.column("doc_id"), n_shingles=pa.array(count, pa.int64()), fingerprint=pa.array(found, pa.string()))

    return arrow_map(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), each, "doc_id long, n_shingles long, fingerprint string")


def neighbours(docs: DataFrame, partitions: int) -> DataFrame:
    """bucket, guest, doc_id, digest, z: compressed texts dealt by ranges of descending doc_id, sorted within them.

    A range's guest (guest = 1, its last row) is the first document of the next range that
    has any, so that every document meets the one after it without a sort of all rows in
    one task.  Only the bounds and the ranges' largest ids pass through the driver.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"))
    bounds = np.array(sorted({int(x) for x in ids.approxQuantile("doc_id", [i / partitions for i in range(1, partitions)], 0.25 / partitions)}), np.int64) if partitions > 1 else np.zeros(0, np.int64)
    last = len(bounds)

    def bucket(doc_id: np.ndarray) -> np.ndarray:
        return last - np.searchsorted(bounds, doc_id, "left")

    def largest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc_id = batch.column("doc_id").to_numpy()
        b = bucket(doc_id)
        top = np.full(last + 1, -(2**63), np.int64)
        np.maximum.at(top, b, doc_id)
        there = np.unique(b)
        yield rows(bucket=pa.array(there, pa.int64()), top=pa.array(top[there]))

    tops = {r["bucket"]: r["top"] for r in arrow_map(ids, largest, "bucket long, top long").groupBy("bucket").agg(F.max("top").alias("top")).collect()}
    order = sorted(tops)
    host = {b: order[i - 1] for i, b in enumerate(order)}  # the first's host is the last

    def deal(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for block in blocks(batch, size=BLOCK):
            doc_id = block.column("doc_id").to_numpy()
            b = bucket(doc_id)
            raw = [t.encode() for t in block.column("text").to_pylist()]
            digest = [hashlib.blake2b(t, digest_size=8).digest() for t in raw]
            z = [squeeze.compress(t) for t in raw]
            heads = [i for i, (k, d) in enumerate(zip(b.tolist(), doc_id.tolist())) if tops[k] == d]
            some = [*range(len(z)), *heads]
            yield rows(
                bucket=pa.array([*b.tolist(), *(host[int(b[i])] for i in heads)], pa.int64()),
                guest=pa.array([0] * len(z) + [1] * len(heads), pa.int32()),
                doc_id=pa.array(doc_id[some]),
                digest=pa.array([digest[i] for i in some], pa.binary()),
                z=pa.array([z[i] for i in some], pa.binary()),
            )

    dealt = arrow_map(docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), deal, "bucket long, guest int, doc_id long, digest binary, z binary")
    return dealt.repartition(partitions, "bucket").sortWithinPartitions("bucket", "guest", F.desc("doc_id"), "digest")


def edited(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how near they and the next document are.

    The edited text has its last third of code points replaced by the first as many, or all,
    of the next document in descending order of doc_id; after the last comes the first.
    """
    partitions = max(4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def finish(run: list[tuple[int, int, str]], more: str) -> Iterator[pa.RecordBatch]:
        """run: (bucket, doc_id, text); more: the text after the last."""
        texts = [t for _, _, t in run] + [more]
        change = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, texts[1:])]
        kept, count = sketches(pa.array(texts, pa.large_string()), fraction)
        kept2, count2 = sketches(pa.array(change, pa.large_string()), fraction)
        raw, raw2 = [t.encode() for t in texts], [t.encode() for t in change]
        yield rows(
            doc_id=pa.array([None if d == -(2**63) else d for _, d, _ in run], pa.int64()),
            n_chars=pa.array([len(t) for t in texts[:-1]], pa.int64()),
            edited_sha256=pa.array([hashlib.sha256(t).hexdigest() for t in raw2], pa.string()),
            fingerprint=pa.array([fingerprint(t, k, c) for t, k, c in zip(raw[:-1], kept, count.tolist())], pa.string()),
            edited_fingerprint=pa.array([fingerprint(t, k, c) for t, k, c in zip(raw2, kept2, count2.tolist())], pa.string()),
            near_edited=pa.array([_likeness(a == b, p, q) for a, b, p, q in zip(raw, raw2, kept, kept2)], pa.float64()),
            near_next=pa.array([_likeness(a == b, p, q) for a, b, p, q in zip(raw, raw[1:], kept, kept[1:])], pa.float64()),
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        run: list[tuple[int, int, str]] = []
        size = 0
        for batch in batches:
            for b, guest, doc_id, z in zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "z"))):
                if run and run[-1][0] == b and guest:
                    yield from finish(run, open_.decompress(z).decode())
                    run, size = [], 0
                elif not guest:
                    text = open_.decompress(z).decode()
                    if size > BLOCK:
                        yield from finish(run, text)
                        run, size = [], 0
                    run.append((b, doc_id, text))
                    size += len(text)
        assert not run, "a range without its guest"

    return neighbours(docs, partitions).select("bucket", "guest", "doc_id", "z").mapInArrow(each, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
