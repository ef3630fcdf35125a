"""Quality rules: counts of a text, and an n-gram perplexity held against bands of its language.

There are two interpolated modified Kneser-Ney models of bytes for each language.  One is of
bytes within words and judges spelling.  The other is of running text, the words of a text
with one space after each: its contexts cross word bounds, so a word's first bytes depend on
how the word before ends, and shuffled words make a text dear.  Spark counts the five-byte
windows of all documents, lower orders are counted from them, and each order's probabilities
and weights are joined into sorted hash arrays that the workers map.  A text's perplexity is
per word that has a letter or a digit, word ends included: marks on words or between them
make words dear.
Each model's band of a language lies around its median of log-perplexity.  Its half-width is ``width``
standard deviations of a text of that many words, estimated from the quartiles of the
deviations times the square root of the number of words, and ``least`` times the median at
the least; a text outside either band is rejected.  Medians and quartiles come from exact
histograms on a fine grid, so they don't depend on how the table is partitioned.

Cases: a null text has no words and fails the base rules; a null language and an empty one are
one language of their own; a table with over ``LANGUAGES`` languages is refused; texts of any length are taken whole; repeated rows give repeated results; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm import arrays
from tollgate.llm.tables import arrow_map, kept, rows
from tollgate.llm.words import Words, blocks, distinct, grams, group_order, inside, mix, span_hashes, sums, words

ORDER = 5
BLOCK = 4 << 20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LANGUAGES = 1 << 16
KINDS = ("log_ppl", "run_log_ppl")
GRID = 1e-4  # of the histograms of log perplexities and of their deviations
PROB, GAMMA = (("logp", "<f4"),), (("logg", "<f4"),)


def counts(w: Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    data, docs = w.data, len(w.offsets) - 1
    point = (data & 0xC0) != 0x80
    spans = np.zeros(len(data) + 1, np.int64)
    np.cumsum(point, out=spans[1:])
    chars = sums(spans[w.ends] - spans[w.starts], w.first)
    symbols = sums(SYMBOLS[data], w.offsets)
    # lines: cut at line ends and between texts; those without a word don't count
    cut = np.flatnonzero(data == 10)
    edge = np.unique(np.concatenate((w.offsets[:-1], cut + 1)))
    edge = edge[edge < len(data)]
    stop = np.append(edge[1:], len(data))
    stop = stop - ((data[stop - 1] == 10) if len(stop) else 0)
    at = np.searchsorted(w.starts, edge)
    has = at < np.searchsorted(w.starts, stop)
    edge, stop = edge[has], stop[has]
    line_doc = np.searchsorted(w.offsets, edge, "right") - 1
    twice = _again(span_hashes(data, edge, stop), line_doc)
    dup = np.bincount(line_doc[twice], minlength=docs)
    # words in three-word windows that the text has twice or more
    ok = inside(w.first, 3)
    doc = w.texts()
    some = np.flatnonzero(ok)
    key = mix(grams(w.hashes(), 3)[some] ^ mix(doc[some].astype(np.uint64), 5), 6)
    order, head = group_order(key)
    size = np.diff(np.append(np.flatnonzero(head), len(order)))
    many = some[order[np.repeat(size > 1, size)]]
    covered = np.zeros(len(doc), bool)
    for k in range(3):
        covered[many + k] = True
    return {"n_words": w.counts.astype(np.int64), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": sums(covered, w.first)}


def _again(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Indexes of what equals something before it in its text."""
    order, head = group_order(mix(h ^ mix(doc.astype(np.uint64), 5), 6))
    return order[~head]


def languages(docs: DataFrame) -> dict[str, int]:
    """The number of each language's model of words, by name; the next number is that of its running text."""
    found = docs.select("lang").distinct().limit(LANGUAGES + 1).collect()  # names of languages, refused where they are more
    if len(found) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages")
    return {x: 2 * i for i, x in enumerate(sorted(r["lang"] for r in found))}


def windows(w: Words, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (language, word): the word's group for every word; keys of five-byte windows, their group, and the groups' sizes."""
    order, head = group_order(mix(w.hashes() ^ mix(lang[w.texts()].astype(np.uint64), 3), 4))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(head) - 1
    some = order[head]
    n = w.ends[some] - w.starts[some]
    stop = np.cumsum(n + ORDER)  # four spaces, the word, one space
    begin = stop - (n + ORDER)
    raw = np.full(int(stop[-1]) if len(stop) else 0, 32, np.uint64)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    raw[np.repeat(begin + ORDER - 1, n) + inner] = w.data[np.repeat(w.starts[some], n) + inner]
    owner = np.repeat(np.arange(len(some)), n + ORDER)
    key = np.repeat(lang[w.texts()[some]].astype(np.uint64), n + ORDER)
    key = key[: max(0, len(raw) - ORDER + 1)]
    for k in range(ORDER):
        key = (key << np.uint64(8)) | raw[k : k + len(key)]
    ok = owner[: len(key)] == owner[ORDER - 1 :] if len(key) else np.zeros(0, bool)
    return group, key[ok].astype(np.int64), owner[: len(key)][ok], np.diff(np.append(np.flatnonzero(head), len(order))), n + 1


def running(w: Words, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the five-byte windows of running text that end at each byte of a word or at the space after it, text after text; where each text's begin, and the end."""
    pad = ORDER - 1  # spaces before each text
    n = w.ends - w.starts
    after = np.cumsum(n + 1)
    first = np.append(0, after)[w.first]
    begin = after - (n + 1) + pad * (w.texts() + 1)
    raw = np.full(int(first[-1]) + pad * len(lang), 32, np.uint8)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    raw[np.repeat(begin, n) + inner] = w.data[np.repeat(w.starts, n) + inner]
    own = np.diff(first)
    # the window's first byte: each text's windows begin at its padding
    at = np.arange(int(first[-1])) + np.repeat(pad * np.arange(len(lang)), own)
    key = np.repeat(lang.astype(np.uint64), own)
    for k in range(ORDER):
        key = (key << np.uint64(8)) | raw[at + k]
    return key.view(np.int64), first


def _spelled(w: Words) -> np.ndarray:
    """Whether each word has a letter, a digit or a byte beyond ASCII."""
    total = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(LETTERS[w.data], out=total[1:])
    return total[w.ends] > total[w.starts]


def _langs(block: pa.RecordBatch, numbers: dict[str, int]) -> np.ndarray:
    """The number of each text's language."""
    codes = block.column("lang").dictionary_encode()
    table = np.array([numbers[x] for x in codes.dictionary.to_pylist()] or [0], np.int64)
    return table[codes.indices.to_numpy()]


def count_windows(docs: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """key, count: the five-byte windows of all words, and of all running texts, by language."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch, size=BLOCK):
            w = words(block.column("text"))
            lang = _langs(block, numbers)
            _, key, owner, size, _ = windows(w, lang)
            order, head = group_order(key.view(np.uint64))
            at = np.append(np.flatnonzero(head), len(order))
            yield rows(key=pa.array(key[order[at[:-1]]]), count=pa.array(sums(size[owner[order]], at)))
            key, count = distinct(running(w, lang + 1)[0].view(np.uint64))
            yield rows(key=pa.array(key.view(np.int64)), count=pa.array(count))

    return arrow_map(docs, each, "key long, count long").groupBy("key").agg(F.sum("count").alias("count"))


def model(docs: DataFrame, numbers: dict[str, int]) -> dict[str, str]:
    """Paths of the arrays: p1..p5 have log10 probabilities, g1..g4 the log10 weights of contexts."""
    level = kept(count_windows(docs, numbers), "windows").select("key", F.col("count").alias("a"))
    levels = {ORDER: level}
    for k in range(ORDER - 1, 0, -1):  # how many bytes come before what is left
        low = F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        lang = F.shiftright("key", 8 * (k + 1))
        levels[k] = levels[k + 1].select(F.shiftleft(lang, 8 * k).bitwiseOR(low).alias("key")).groupBy("key").agg(F.count("*").alias("a"))
    paths, lower = {}, None
    for k in range(1, ORDER + 1):
        grams_ = levels[k].select("key", "a", F.shiftright("key", 8 * k).alias("lang"), F.shiftright("key", 8).alias("context"))
        n = grams_.groupBy("lang").agg(*[F.count_if(F.col("a") == i).alias(f"n{i}") for i in range(1, 5)])
        y = F.col("n1") / F.greatest(F.lit(1), F.col("n1") + 2 * F.col("n2"))
        off = [F.when((F.col(f"n{i}") > 0), F.greatest(F.lit(0.1), F.least(F.lit(i - 0.05), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")))).otherwise(F.lit(0.5)).alias(f"d{i}") for i in (1, 2, 3)]
        discounts = n.select("lang", *off)
        # a row for each language: small, and joined as the engine sees fit
        with_d = grams_.join(discounts, "lang").select("key", "context", "a", F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3")).alias("d"))
        whole = with_d.groupBy("context").agg(F.sum("a").alias("total"), F.sum(F.least("a", "d")).alias("off"))
        whole = kept(whole.select("context", "total", (F.col("off") / F.col("total")).alias("gamma")), f"contexts{k}")
        own = with_d.join(whole, "context").select("key", (F.greatest(F.lit(0.0), F.col("a") - F.col("d")) / F.col("total")).alias("own"), "gamma")
        if lower is None:
            p = own.select("key", (F.col("own") + F.col("gamma") / 257).alias("p"))
        else:
            low = F.col("key").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1))
            suffix = F.shiftleft(F.shiftright("key", 8 * k), 8 * (k - 1)).bitwiseOR(low)
            p = own.withColumn("suffix", suffix).join(lower.select(F.col("key").alias("suffix"), F.col("p").alias("q")), "suffix").select("key", (F.col("own") + F.col("gamma") * F.col("q")).alias("p"))
        lower = kept(p, f"order{k}")
        paths[f"p{k}"] = arrays.write(lower.select("key", F.log10("p").alias("logp")), "key", dict(PROB), f"p{k}")
        paths[f"g{k - 1}"] = arrays.write(whole.select(F.col("context").alias("key"), F.log10("gamma").alias("logg")), "key", dict(GAMMA), f"g{k - 1}")
    return paths


def log_prob(keys: np.ndarray, paths: dict[str, str]) -> np.ndarray:
    """log10 probability of the last byte of each window, given the ones before it."""
    order, head = group_order(mix(keys.view(np.uint64), 7))
    at = np.flatnonzero(head)
    own = np.sort(keys[order[at]])
    p, found, weight = np.zeros(len(own)), np.zeros(len(own), bool), np.zeros(len(own))
    lang = own >> (8 * ORDER)
    for k in range(ORDER, 0, -1):
        key = (lang << (8 * k)) | (own & ((1 << (8 * k)) - 1))
        sub = np.sort(key)
        back = np.argsort(np.argsort(key, kind="stable"), kind="stable")
        logp = arrays.opened(paths[f"p{k}"], "key", PROB).get(sub, {"logp": np.nan})["logp"][back]
        new = ~found & ~np.isnan(logp)
        p[new] = logp[new] + weight[new]
        found |= new
        sub = np.sort(key >> 8)
        back = np.argsort(np.argsort(key >> 8, kind="stable"), kind="stable")
        weight += np.where(found, 0.0, arrays.opened(paths[f"g{k - 1}"], "key", GAMMA).get(sub, {"logg": 0.0})["logg"][back])
    p[~found] = weight[~found] - np.log10(257)
    out = np.empty(len(keys))
    out[order] = p[np.searchsorted(own, keys[order[at]])][np.cumsum(head) - 1]
    return out


def scores(docs: DataFrame, paths: dict[str, str], numbers: dict[str, int]) -> DataFrame:
    """doc_id, lang, the counts, and log10 perplexities by words and as running text (null for a text without words)."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks(batch, size=BLOCK):
            w = words(block.column("text"))
            found = counts(w)
            lang = _langs(block, numbers)
            group, key, owner, size, _ = windows(w, lang)
            each_word = np.bincount(owner, log_prob(key, paths), len(size)) if len(size) else np.zeros(0)
            n = sums(_spelled(w), w.first)
            log_ppl = -sums(each_word[group], w.first) / np.maximum(n, 1)
            key, first = running(w, lang + 1)
            run_log_ppl = -sums(log_prob(key, paths), first) / np.maximum(n, 1)
            yield rows(doc_id=block.column("doc_id"), lang=block.column("lang"), **{c: pa.array(v.astype(np.int64)) for c, v in found.items()}, log_ppl=pa.array(log_ppl, mask=n == 0), run_log_ppl=pa.array(run_log_ppl, mask=n == 0))

    return arrow_map(docs, each, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_ppl double, run_log_ppl double")


def quantiles(rows_: DataFrame, value: Column, shares: dict[str, float]) -> DataFrame:
    """lang, kind, and for each name the smallest cell of the grid that the share of a language's rows doesn't exceed."""
    cells = rows_.select("lang", "kind", F.round(value / F.lit(GRID)).cast("long").alias("cell")).groupBy("lang", "kind", "cell").agg(F.count("*").alias("n"))
    by = Window.partitionBy("lang", "kind")  # a row for each cell that occurs, not for each text
    run = cells.withColumns({"run": F.sum("n").over(by.orderBy("cell")), "total": F.sum("n").over(by)})
    return run.groupBy("lang", "kind").agg(*[(F.min(F.when(F.col("run") >= F.lit(share) * F.col("total"), F.col("cell"))) * F.lit(GRID)).alias(name) for name, share in shares.items()])


def bands(scored: DataFrame) -> DataFrame:
    """lang, and of each kind of perplexity its median and the standard deviation of a word; from texts that the base rules keep."""
    long = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("x")) for c in KINDS]
    fit = scored.where(~F.col("base_failed")).select("lang", "n_words", F.explode(F.array(*long)).alias("v")).select("lang", "n_words", "v.kind", "v.x").where("x is not null")
    middle = kept(quantiles(fit, F.col("x"), {"mid": 0.5}), "middle")
    # a row for each language and kind
    spread = quantiles(fit.join(middle, ["lang", "kind"]), (F.col("x") - F.col("mid")) * F.sqrt("n_words"), {"lower": 0.25, "upper": 0.75})
    one = middle.join(spread, ["lang", "kind"]).withColumn("sd", (F.col("upper") - F.col("lower")) / F.lit(1.349))
    return one.groupBy("lang").agg(*[F.max(F.when(F.col("kind") == c, F.col(x))).alias(f"{c}_{x}") for c in KINDS for x in ("mid", "sd")])


def judge(docs: DataFrame, width: float = 4.0, least: float = 0.06) -> DataFrame:
    """doc_id, the counts, base_failed, kept, log_ppl and run_log_ppl with their bands for every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    numbers = languages(docs)
    scored = kept(scores(docs, model(docs, numbers), numbers), "scores")
    scored = scored.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    half = {c: F.greatest(F.lit(least) * F.col(f"{c}_mid"), F.lit(width) * F.col(f"{c}_sd") / F.sqrt(F.greatest(F.lit(1), F.col("n_words")))) for c in KINDS}
    joined = scored.join(bands(scored), "lang", "left").withColumns({f"{c}_{side}": F.col(f"{c}_mid") + sign * half[c] for c in KINDS for side, sign in (("low", -1), ("high", 1))})
    verdict = ~F.col("base_failed")
    for c in KINDS:
        verdict = verdict & F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.coalesce(verdict, F.lit(False)).alias("kept"), *[x for c in KINDS for x in (c, f"{c}_low", f"{c}_high")])
