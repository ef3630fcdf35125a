"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, their first 5 and 7 bytes where they are longer,
word pairs and pairs with one word between (A-Z lower-cased, ASCII marks around words cut
off), hashed into 2 ** ``BITS`` coordinates.  Each coordinate has its own learning rate, and
the L1 term leaves most weights at zero, so the model is a short array of coordinates and
weights that every task gets.

The labelled rows it learns from are a bounded sample: the ``most`` rows whose doc_id has
the smallest hash.  They are dealt to ``shards`` tasks, a copy for each of ``epochs`` passes in
the order of the passes, and each task learns from them as they stream by, a block of text
at a time: it holds its coordinates and one block, however long the texts are.  The shards'
weights are averaged.  Everything else covers all rows.

Cases: a null text is empty, and an empty text scores by the intercept alone; rows without
a label, or with a null one, aren't learned from; without any labels the score is 0.5 times
nothing known, that is 0.0; labels repeated for a doc_id count as often as they occur;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.tables import arrow_map, rows
from tollgate.llm.words import Words, blocks, mix, span_hashes, words

MOST = 24_000
STEMS = (5, 7)
SHARDS = 6
BITS = 22
LEARN = 1 << 20  # bytes of text that are learned from, or scored, at a time
STEP = 1 << 18  # coordinates that become weights at a time
MARKS = np.zeros(256, bool)
MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def trimmed(w: Words) -> Words:
    """The words without ASCII marks around them; words of marks alone stay as they are."""
    other = np.flatnonzero(~MARKS[w.data])
    at = np.searchsorted(other, w.starts)
    to = np.searchsorted(other, w.ends) - 1
    ok = to >= at
    starts, ends = w.starts.copy(), w.ends.copy()
    starts[ok], ends[ok] = other[at[ok]], other[to[ok]] + 1
    return Words(w.data, w.offsets, starts, ends, w.first)


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Coordinates and the texts they are of, with repeats, a kind of feature after another."""
    w = trimmed(words(texts, lower=True))
    h, doc = w.hashes(), w.texts().astype(np.uint32)
    yield _slot(mix(h, 11)), doc
    for stem in STEMS:
        some = np.flatnonzero(w.ends - w.starts > stem)
        yield _slot(mix(span_hashes(w.data, w.starts[some], w.starts[some] + stem), 20 + stem)), doc[some]
    for gap in (1, 2):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            yield _slot(mix(h[:-gap] * np.uint64(0x9E6C63D0876A9A35) + h[gap:], 11 + gap)[same]), doc[gap:][same]


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.uint32)


def _once(slot: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, coordinate), text after text: a feature counts once in a text."""
    pair = np.unique((doc.astype(np.uint64) << np.uint64(BITS)) | slot)
    return (pair & np.uint64((1 << BITS) - 1)).astype(np.uint32), (pair >> np.uint64(BITS)).astype(np.uint32)


@dataclass
class Model:
    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.slots] = self.weights
        return out

    def score(self, texts: pa.Array, table: np.ndarray) -> np.ndarray:
        found = [(slot[some], doc[some]) for slot, doc in features(texts) for some in [np.flatnonzero(table[slot])]]
        slot, doc = _once(*(np.concatenate([f[k] for f in found]) for k in (0, 1)))
        total = self.bias + np.bincount(doc, table[slot].astype(np.float64), len(texts))
        return 1 / (1 + np.exp(-total))


class Learner:
    """FTRL-proximal, a row at a time; the last coordinate is the intercept, without L1."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.s = (np.zeros((1 << BITS) + 1, np.float32) for _ in range(2))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, penalty = self.z[at].astype(np.float64), np.where(at == 1 << BITS, 0.0, self.l1)
        w = -(z - np.sign(z) * penalty) / ((self.beta + np.sqrt(self.s[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= penalty, 0.0, w)

    def learn(self, texts: pa.Array, labels: np.ndarray) -> None:
        slot, doc = _once(*(np.concatenate([f[k] for f in features(texts)]) for k in (0, 1)))
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i, label in enumerate(labels.tolist()):
            at = np.append(slot[first[i] : first[i + 1]], np.uint32(1 << BITS))
            w, s = self.weights(at), self.s[at].astype(np.float64)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            self.z[at] += g - (np.sqrt(s + g * g) - np.sqrt(s)) / self.alpha * w
            self.s[at] = s + g * g

    def model(self) -> Model:
        some, found = [], []
        for a in range(0, 1 << BITS, STEP):
            w = self.weights(np.arange(a, a + STEP))
            at = np.flatnonzero(w)
            some.append((at + a).astype(np.uint32))
            found.append(w[at].astype(np.float32))
        return Model(np.concatenate(some), np.concatenate(found), float(self.weights(np.array([1 << BITS]))[0]))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST, shards: int = SHARDS, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 2.0, l2: float = 1.0) -> Model | None:
    """docs: doc_id, text; labels: doc_id, label 0 or 1; None without any labelled text."""
    mixed = F.xxhash64(F.col("doc_id"), F.lit(17))
    known = labels.select("doc_id", F.col("label").cast("int").alias("label"), mixed.alias("mixed")).where("label is not null")
    chosen = known.orderBy("mixed", "doc_id").limit(most)
    # ``most`` rows of numbers at the most, so only the chosen texts are shuffled
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").withColumn("shard", F.pmod("mixed", F.lit(shards)).cast("int"))
    order = ("shard", "epoch", "mixed", "doc_id", "text")
    passes = sample.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).select(*order, "label")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, learner, n = None, None, 0

        def done() -> pa.RecordBatch:
            model = learner.model()
            return rows(slots=pa.array([model.slots.tobytes()], pa.binary()), weights=pa.array([model.weights.tobytes()], pa.binary()), bias=pa.array([model.bias]), n=pa.array([n], pa.int64()))

        for batch in batches:
            for block in blocks(batch, size=LEARN):
                shards_ = block.column("shard").to_numpy()
                at = [0, *(np.flatnonzero(shards_[1:] != shards_[:-1]) + 1).tolist(), len(shards_)]
                for a, b in zip(at, at[1:]):
                    if shards_[a] != shard:
                        if learner:
                            yield done()
                        shard, learner, n = shards_[a], Learner(alpha, beta, l1, l2), 0
                    learner.learn(block.column("text").slice(a, b - a), block.column("label").to_numpy()[a:b])
                    n += b - a
        if learner:
            yield done()

    dealt = passes.repartitionById(shards, F.col("shard")).sortWithinPartitions(*order)
    parts = dealt.mapInArrow(learn, "slots binary, weights binary, bias double, n long").collect()  # ``shards`` sparse models of a bounded sample
    total = sum(p["n"] for p in parts)
    if not total:
        return None
    slot = np.concatenate([np.frombuffer(p["slots"], np.uint32) for p in parts])
    weight = np.concatenate([np.frombuffer(p["weights"], np.float32) * (p["n"] / total) for p in parts])
    some, back = np.unique(slot, return_inverse=True)
    return Model(some, np.bincount(back, weight, len(some)).astype(np.float32), sum(p["bias"] * p["n"] for p in parts) / total)


def scored(docs: DataFrame, model: Model | None, columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and score of every whole text; columns: others that stay."""
    kinds = dict(docs.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table() if model else None
        for batch in batches:
            for block in blocks(batch, size=LEARN):
                score = model.score(block.column("text"), table) if model else np.zeros(block.num_rows)
                yield rows(doc_id=block.column("doc_id"), score=pa.array(score), **{c: block.column(c) for c in columns})

    return arrow_map(docs.select(*dict.fromkeys(("doc_id", "text", *columns))), each, ", ".join(["doc_id long", "score double", *(f"`{c}` {kinds[c]}" for c in columns)]), whole=True)


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, label of the rows to learn from: those whose crc32(doc_id as text) mod 4 isn't 2."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("label"))
    return known.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = scored(docs, fit(docs, known_labels(labels)))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
