"""Language-model scores by an interpolated modified Kneser-Ney bigram model.

Spark counts words and word pairs of the training texts by packed key ranges.  Words become
ranks in the sorted vocabulary, a pair is one mixed 64-bit number (a bijection, so no two
pairs collide), and every task that has added up a range of pairs writes it as sorted arrays
of numbers and counts.  A context's total and weight and a word's lower-order probability
follow from sums over the pairs.  Workers map the arrays and look sorted queries up in them.

Tokens: A-Z lower-cased words, then one end; each text begins in a start context.

Cases: a null text is empty and has its end alone; unknown words share one slot of the
uniform base distribution; texts of any length are scored whole; a null doc_id is trained
on; repeated rows count as often as they occur; without training rows every token has the
uniform probability 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm import arrays
from tollgate.llm.counting import added, by_bucket, counts, packs, ranges
from tollgate.llm.tables import arrow_map, kept, rows, scratch
from tollgate.llm.words import Words, blocks, group_order, mix, sums, words

END = np.uint64(0x0E4D5F10CA7E5EED)
WORD, PAIR, CONTEXT = (("count", "<i8"),), (("count", "count"),), (("total", "<f8"), ("gamma", "<f8"), ("cont", "<f8"))
BLOCK = 6 << 20
_M64 = (1 << 64) - 1
UNKNOWN = 0xFFFFFFFF  # the number of a word that isn't in the vocabulary


def unmixed(h: np.ndarray, seed: int) -> np.ndarray:
    """The inverse of mix."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(pow(0xC4CEB9FE1A85EC53, -1, 1 << 64))
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(pow(0xFF51AFD7ED558CCD, -1, 1 << 64))
    h = h ^ (h >> np.uint64(33))
    return h ^ np.uint64((seed * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & _M64)


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends among them, and where each text's begin, and the end."""
    docs = np.arange(len(w.first))
    first = w.first + docs
    out = np.full(int(first[-1]), END, np.uint64)
    out[np.arange(len(w.starts)) + w.texts()] = w.hashes()
    return out, first


@dataclass
class Tokens:
    """Distinct tokens of a block, their ranks in the vocabulary (-1: unknown) and counts, and the place of every token among them."""

    first: np.ndarray
    rank: np.ndarray
    count: np.ndarray
    place: np.ndarray


def looked_up(block: pa.RecordBatch, vocabulary: str) -> Tokens:
    h, first = tokens(words(block.column("text"), lower=True))
    order, head = group_order(h)
    some = h[order[head]].view(np.int64)
    up = np.argsort(some)
    found = arrays.opened(vocabulary, "key", WORD)
    rank, count = np.empty(len(some), np.int64), np.empty(len(some), np.int64)
    rank[up], count[up] = found.rank(some[up]), found.get(some[up], {"count": 0})["count"]
    place = np.empty(len(h), np.int64)
    place[order] = np.cumsum(head) - 1
    return Tokens(first, rank, count, place)


def pair_keys(t: Tokens, start: int) -> np.ndarray:
    """Mixed numbers of each token's (token before, token) pair."""
    now = t.rank[t.place]
    before = np.empty(len(now), np.int64)
    before[1:] = now[:-1]
    before[t.first[:-1]] = start
    return mix((before.astype(np.uint64) << np.uint64(32)) | (now.astype(np.uint64) & np.uint64(UNKNOWN)), 61)


def signed(key: np.ndarray) -> np.ndarray:
    """Numbers in an order of longs that is the unsigned one's."""
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def discounts(n: list[int]) -> np.ndarray:
    """For counts of 0, 1, 2, and 3 or more, from how many have counts of 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    d = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.1), i - 0.05) for i, x in zip((1, 2, 3), d))])


@dataclass
class Model:
    vocabulary: str
    pairs: str
    contexts: str
    size: int
    total: int
    pair_off: np.ndarray
    word_off: np.ndarray
    pair_total: int
    floor: float


def train(docs: DataFrame) -> Model | None:
    """The model of all texts of docs; None without rows."""
    spark = docs.sparkSession
    buckets = ranges(docs)
    words_ = kept(counts(docs, lambda block: tokens(words(block.column("text"), lower=True))[0], buckets), "words")
    size, total = words_.agg(F.count("*"), F.sum("count")).first()
    if not size:
        return None
    if size >= UNKNOWN:
        raise ValueError(f"{size} distinct words can't be numbered in 32 bits")
    vocabulary = arrays.write(words_, "key", dict(WORD), "vocabulary")
    path = scratch(spark, "pairs")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in by_bucket(batches):
            key, count = added((k, c) for _, _, k, c in group)
            name = f"{int(signed(key[:1])[0]) + (1 << 63):020d}"
            arrays.put_counts(path, name, signed(key), count)
            arrays.put(path, f"{name}.key", signed(key))
            pair = unmixed(key, 61)
            ids = np.concatenate((pair >> np.uint64(32), pair & np.uint64(UNKNOWN))).astype(np.int64)
            none = np.zeros(len(key), np.int64)
            columns = [np.concatenate((x, none)) for x in (count, count == 1, count == 2, count >= 3)] + [np.concatenate((none, none + 1))]
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            head = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            ids, columns = ids[head], [np.add.reduceat(c[order], head) for c in columns]
            ids = np.append(ids, -1)  # how many pairs have counts of 1 to 4
            columns = [np.append(c, k) for c, k in zip(columns, [*(int((count == i).sum()) for i in (1, 2, 3, 4)), 0])]
            yield rows(id=pa.array(ids), **{n: pa.array(c.astype(np.int64)) for n, c in zip(("total", "n1", "n2", "n3", "cont"), columns)})

    pairs = packs(docs, lambda block: pair_keys(looked_up(block, vocabulary), size), buckets)
    stats = pairs.mapInArrow(add, "id long, total long, n1 long, n2 long, n3 long, cont long")
    stats = kept(stats.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("total", "n1", "n2", "n3", "cont")]), "stats")
    of_pairs = stats.where("id = -1").first()
    pair_off = discounts([of_pairs[c] for c in ("total", "n1", "n2", "n3")])
    own = stats.where("id >= 0")
    word = own.agg(F.sum("cont").alias("s"), *[F.count_if(F.col("cont") == i).alias(f"n{i}") for i in (1, 2, 3, 4)], F.count_if(F.col("cont") > 2).alias("more")).first()
    word_off = discounts([word[f"n{i}"] for i in (1, 2, 3, 4)])
    d1, d2, d3 = (F.lit(float(x)) for x in pair_off[1:])
    gamma = F.when(F.col("total") > 0, (d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")) / F.col("total")).otherwise(F.lit(1.0))
    contexts = arrays.write(own.select("id", F.col("total").cast("double").alias("total"), gamma.alias("gamma"), F.col("cont").cast("double").alias("cont")), "id", dict(CONTEXT), "contexts")
    off = word_off[1] * word["n1"] + word_off[2] * word["n2"] + word_off[3] * word["more"]
    return Model(vocabulary, path, contexts, size, total, pair_off, word_off, word["s"], off / word["s"] / (size + 1))


def log_probs(t: Tokens, m: Model) -> np.ndarray:
    """log10 probability of every token."""
    ids = np.append(t.rank, m.size)  # the start last
    up = np.argsort(ids, kind="stable")
    got = arrays.opened(m.contexts, "id", CONTEXT).get(ids[up], {"total": 0.0, "gamma": 1.0, "cont": 0.0})
    total, gamma, cont = (np.empty(len(ids)) for _ in range(3))
    for out, name in ((total, "total"), (gamma, "gamma"), (cont, "cont")):
        out[up] = got[name]
    lower = np.maximum(cont - m.word_off[np.minimum(cont, 3).astype(np.int64)], 0) / m.pair_total + m.floor
    key = signed(pair_keys(t, m.size))
    order, head = group_order(key.view(np.uint64))
    some = key[order[head]]
    up = np.argsort(some)
    count = np.empty(len(some))
    count[up] = arrays.opened(m.pairs, "key", PAIR).get(some[up], {"count": 0})["count"]
    each = np.empty(len(key))
    each[order] = count[np.cumsum(head) - 1]
    before = np.empty(len(key), np.int64)
    before[1:] = t.place[:-1]
    before[t.first[:-1]] = len(ids) - 1
    own = np.maximum(each - m.pair_off[np.minimum(each, 3).astype(np.int64)], 0) / np.maximum(total[before], 1)
    return np.log10(own + gamma[before] * lower[t.place])


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, log10_perplexity of every whole text."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch, size=BLOCK):
            if model is None:
                n = np.diff(tokens(words(block.column("text")))[1])
                zero = np.zeros(len(n))
                yield rows(doc_id=block.column("doc_id"), n_tokens=pa.array(n), n_known=pa.array(np.zeros(len(n), np.int64)), base_score=pa.array(zero), score=pa.array(zero), log10_perplexity=pa.array(zero))
                continue
            t = looked_up(block, model.vocabulary)
            base = np.log10((t.count + 1.0) / (model.total + 1.0 * (model.size + 1)))
            n, found = np.diff(t.first), sums(log_probs(t, model), t.first)
            yield rows(doc_id=block.column("doc_id"), n_tokens=pa.array(n), n_known=pa.array(sums(t.count[t.place] > 0, t.first)), base_score=pa.array(sums(base[t.place], t.first)), score=pa.array(found), log10_perplexity=pa.array(-found / n))

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id long, n_tokens long, n_known long, base_score double, score double, log10_perplexity double")


def score_held_out(docs: DataFrame) -> DataFrame:
    """score() of every document by a model of those that aren't held out, with held_out and train_tokens."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.total if model else 0).cast("long").alias("train_tokens"), "base_score", "score", "log10_perplexity")
