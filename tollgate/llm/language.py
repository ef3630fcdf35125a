"""Language identification by error-correcting output codes.

Every language has a codeword of bits, far from all others.  A bit splits the languages in two,
and a binary classifier of byte n-grams predicts it: the log odds of an n-gram on the one side
against the other, from counts over all labelled texts, each language weighing the same.  A
text's evidence for a bit is the sum of its n-grams' log odds over the square root of how many
it has.  Words are runs of letters a-z (A-Z lower-cased) and of anything beyond ASCII; the
n-grams are those of one to ``GRAM`` bytes within a word, with a space on either side, and
the whole word.  Equal words of a block are worked out once.

Decoding weighs losses.  How often each bit is predicted right on the labelled texts of each
language becomes that bit's weight for that language, and a language's distance is the
weighted loss of the predicted bits against its codeword.  The nearest codeword wins; score is
its share when exponentials of the negative distances are added up, and a text is ambiguous
where it is under ``SURE``.

All labelled texts count, so there is no sample.  The model is ``2 ** BITS`` numbers a bit, and
what comes to the driver ``2 ** BITS`` counts a language: it grows with the languages alone.

Cases: a null text, and one without a letter, is ``und`` with score 0; so is everything when no
labelled text has a letter; texts of any length are taken whole; a null lang isn't learned from,
an empty one is a language like any other; with one language all that have a letter are it,
score 1; equal rows count as often as they occur; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.tables import arrow_map, rows
from tollgate.llm.words import Words, blocks, mix, sums, words

GRAM, BITS, SURE, NONE = 4, 17, 0.8, "und"
LETTER = r"\p{L}"
#: What stands between words: all of ASCII but the letters a-z.
MARKS = np.zeros(256, bool)
MARKS[[*range(0x61), *range(0x7B, 0x80)]] = True
EXHAUSTIVE = 7  # languages up to which every split of them is a bit


def codewords(n: int) -> np.ndarray:
    """A row of 1 and -1 for each of n languages: all splits of a few, else random ones, the best of some draws by their least distance."""
    if n <= EXHAUSTIVE:
        splits = [s for size in range(1, n) for s in combinations(range(n), size) if 0 in s]
        out = np.full((n, len(splits)), -1, np.int8)
        for j, s in enumerate(splits):
            out[list(s), j] = 1
        return out
    width = int(np.ceil(10 * np.log2(n)))
    best, least = None, -1
    for seed in range(200):
        code = np.random.Generator(np.random.PCG64(seed)).choice(np.array([-1, 1], np.int8), (n, width))
        dots = code.astype(np.int64) @ code.T.astype(np.int64)
        distance = int((width - dots[~np.eye(n, dtype=bool)].max()) // 2)
        if distance > least and (np.abs(code.sum(0, dtype=np.int64)) < n).all():
            best, least = code, distance
    return best


def grams_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of n-grams and of whole words, and the word of each; words may lie anywhere in data."""
    size = ends - starts + 2
    first = np.concatenate(([0], np.cumsum(size)))
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(int(first[-1])) - first[word]
    inner = (place > 0) & (place < size[word] - 1)
    padded = np.full(len(word), 32, np.uint8)
    padded[inner] = data[starts[word[inner]] + place[inner] - 1]
    left = size[word] - place  # bytes of the word from here on
    slots, of = [], []
    h = np.zeros(len(padded), np.uint64)
    for n in range(1, GRAM + 1):
        h = h[: max(len(padded) - n + 1, 0)] * np.uint64(257) + padded[n - 1 :].astype(np.uint64) + np.uint64(1)
        some = np.flatnonzero(left[: len(h)] >= n) if n > 1 else np.flatnonzero(inner)
        slots.append(mix(h[some], 40 + n) >> np.uint64(64 - BITS))
        of.append(word[some])
    return np.concatenate(slots).astype(np.int64), np.concatenate(of)


@dataclass
class Evidence:
    """Of a block: its words' distinct ones with their n-gram slots (and the end of each word's), which of them each word is, and the words."""

    slots: np.ndarray
    first: np.ndarray
    kind: np.ndarray
    words: Words


def evidence(texts: pa.Array) -> Evidence:
    w = words(texts, lower=True, marks=MARKS)
    _, example, kind = np.unique(w.hashes(), return_index=True, return_inverse=True)
    slots, of = grams_of(w.data, w.starts[example], w.ends[example])
    whole = (mix(w.hashes()[example], 40) >> np.uint64(64 - BITS)).astype(np.int64)
    slots, of = np.concatenate((slots, whole)), np.concatenate((of, np.arange(len(example))))
    order = np.argsort(of, kind="stable")
    return Evidence(slots[order], np.searchsorted(of[order], np.arange(len(example) + 1)), kind, w)


@dataclass
class Model:
    """languages; code: a row a language; odds: a row a bit; trust: the weight of each language's bits, adding up to 1."""

    languages: list[str]
    code: np.ndarray
    odds: np.ndarray
    trust: np.ndarray

    def bits(self, texts: pa.Array) -> np.ndarray:
        """The evidence for 1 of every text's bits."""
        e = evidence(texts)
        many = np.diff(e.first)[e.kind]
        total = np.maximum(sums(many, e.words.first), 1)
        out = np.empty((len(texts), len(self.odds)))
        for j, odds in enumerate(self.odds):
            by_word = sums(odds[e.slots].astype(np.float64), e.first)
            out[:, j] = sums(by_word[e.kind], e.words.first) / np.sqrt(total)
        return out

    def decoded(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword's language and its score."""
        loss = np.logaddexp(0.0, -bits[:, None, :] * self.code[None])
        distance = (loss * self.trust[None]).sum(2)
        near = np.exp(distance.min(1)[:, None] - distance)
        return distance.argmin(1), 1 / near.sum(1)


def counted(docs: DataFrame, languages: list[str]) -> np.ndarray:
    """By language and slot, how many n-grams the labelled texts (text, label: a place in languages) have."""
    size = 1 << BITS

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            for block in blocks(batch):
                e, label = evidence(block.column("text")), block.column("label").to_numpy()
                of = label[e.words.texts()]
                for l in np.unique(of).tolist():  # noqa: E741
                    times = np.bincount(e.kind[of == l], minlength=len(e.first) - 1)
                    out.setdefault(l, np.zeros(size, np.int64))
                    out[l] += np.bincount(e.slots, np.repeat(times, np.diff(e.first)), size).astype(np.int64)
        for l, total in out.items():  # noqa: E741
            some = np.flatnonzero(total)
            yield rows(label=pa.array(np.full(len(some), l, np.int32)), slot=pa.array(some.astype(np.int32)), n=pa.array(total[some]))

    found = arrow_map(docs.select("text", "label"), each, "label int, slot int, n long", whole=True).groupBy("label", "slot").agg(F.sum("n").alias("n")).toArrow()  # 2 ** ``BITS`` rows a language at the most
    out = np.zeros((len(languages), size), np.int64)
    out[found.column("label").to_numpy(), found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return out


def trusted(docs: DataFrame, model: Model) -> np.ndarray:
    """How often each language's bits are predicted right on the labelled texts, made to add up to 1."""
    n, width = model.code.shape

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros((n, width), np.int64), np.zeros(n, np.int64)
        for batch in batches:
            for block in blocks(batch):
                label = block.column("label").to_numpy()
                ok = (model.bits(block.column("text")) > 0) == (model.code[label] > 0)
                np.add.at(right, label, ok)
                seen += np.bincount(label, minlength=n)
        yield rows(label=pa.array(np.repeat(np.arange(n), width), pa.int32()), bit=pa.array(np.tile(np.arange(width), n), pa.int32()), right=pa.array(right.reshape(-1)), seen=pa.array(np.repeat(seen, width)))

    found = arrow_map(docs.select("text", "label"), each, "label int, bit int, right long, seen long", whole=True)
    out = np.zeros((n, width))
    for r in found.groupBy("label", "bit").agg(F.sum("right").alias("right"), F.sum("seen").alias("seen")).collect():  # a number a language and bit
        out[r["label"], r["bit"]] = (r["right"] + 1) / (r["seen"] + 2)
    return out / np.maximum(out.sum(1, keepdims=True), 1e-9)


def fit(docs: DataFrame, smooth: float = 0.5) -> Model | None:
    """docs: text, lang; None if no text with a lang has a letter."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER)).select("text", "lang")
    languages = sorted(r["lang"] for r in known.select("lang").distinct().collect())  # a name a language
    if not languages:
        return None
    listed = F.broadcast(docs.sparkSession.createDataFrame([(x, i) for i, x in enumerate(languages)], "lang string, label int"))
    labelled = known.join(listed, "lang").select("text", "label")
    share = counted(labelled, languages) + smooth
    share = share / share.sum(1, keepdims=True)
    code = codewords(len(languages))
    odds = np.empty((code.shape[1], 1 << BITS), np.float32)
    for j in range(code.shape[1]):
        odds[j] = np.log(share[code[:, j] > 0].mean(0)) - np.log(share[code[:, j] < 0].mean(0))
    model = Model(languages, code, odds, np.zeros(code.shape))
    model.trust = trusted(labelled, model) if code.shape[1] else np.zeros(code.shape)
    return model


def predicted(docs: DataFrame, model: Model | None, columns: tuple[str, ...] = ()) -> DataFrame:
    """lang_pred, score, ambiguous of every text of docs, and its columns asked for."""
    also = [f"__c{i}" for i in range(len(columns))]
    named = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(columns, also)], F.col("text").alias("__text"), F.coalesce(F.col("text").rlike(LETTER), F.lit(False)).alias("__letter"))
    kinds = dict(named.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "__text"):
                letter = block.column("__letter").to_numpy(zero_copy_only=False)
                lang, score = np.full(block.num_rows, NONE, object), np.zeros(block.num_rows)
                if model and letter.any():
                    best, share = model.decoded(model.bits(block.column("__text")))
                    lang[letter] = np.array(model.languages, object)[best[letter]]
                    score[letter] = share[letter]
                yield rows(**{a: block.column(a) for a in also}, lang_pred=pa.array(lang, pa.string()), score=pa.array(score), ambiguous=pa.array(score < SURE))

    out = arrow_map(named, each, ", ".join([*(f"{a} {kinds[a]}" for a in also), "lang_pred string, score double, ambiguous boolean"]), whole=True)
    return out.select(*[F.col(a).alias(c) for a, c in zip(also, columns)], "lang_pred", "score", "ambiguous")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous; learned from the documents that aren't held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predicted(docs, model, ("doc_id",)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
