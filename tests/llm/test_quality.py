import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tollgate.llm import quality
from tollgate.llm.words import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def test_counts_against_brute_force():
    rnd = random.Random(1)
    parts = ["a", "b", "cé", "#", "|", " ", " ", "\n", "\n", "\t", "\xa0", "x y z", "\r\n", "\n\n", "\x0b"]
    found = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(800)] + ["", None, "\n", "a\n", "a", "q " * 9000]
    out = quality.counts(words(pa.array(found)))
    for i, x in enumerate(found):
        assert {k: int(v[i]) for k, v in out.items()} == brute(x or ""), repr(x)


@pytest.fixture(scope="module")
def judged(spark):
    rnd = random.Random(7)
    syllables = {"en": ["the", "and", "ing", "er", "on", "ti"], "de": ["sch", "ung", "ein", "ich", "zu"]}
    word = lambda lang: "".join(rnd.choice(syllables[lang]) for _ in range(rnd.randrange(1, 4)))
    rows = [(i, " ".join(word(lang) for _ in range(rnd.randrange(60, 300))), lang, 1) for i in range(300) for lang in [rnd.choice(["en", "de"])]]
    bad = [(1000, " ".join(word("en") + rnd.choice(["%%%", "###"]) for _ in range(200)), "en", 0), (1001, " | ".join(word("en") for _ in range(200)), "en", 0), (1002, " ".join(word("de") for _ in range(200)), "en", 0), (1003, "to and fro", "en", 0), (1004, "the end of it " * 40, "en", 0), (1005, "", None, 0), (1006, None, "en", 0)]
    docs = spark.createDataFrame(rows + bad + [bad[0]], "doc_id long, text string, lang string, n_words int").repartition(3)
    return rows, bad, quality.judge(docs).collect()


def test_bands_reject_odd_texts_and_keep_clean_ones(judged):
    rows, bad, out = judged
    assert len(out) == len(rows) + len(bad) + 1
    clean = [r.kept for r in out if r.doc_id < 1000]
    assert sum(clean) >= 0.99 * len(clean)
    assert not any(r.kept for r in out if r.doc_id >= 1000)
    assert {r.doc_id for r in out if r.base_failed} - {1001} == {1003, 1004, 1005, 1006}


def test_shuffled_words_score_worse(spark):
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randrange(3, 7))) for _ in range(600)]
    after = {w: rnd.sample(vocabulary, 3) for w in vocabulary}

    def text():
        w = [rnd.choice(vocabulary)]
        while len(w) < 250:
            w.append(rnd.choice(after[w[-1]]))
        return w

    texts = [text() for _ in range(200)]
    shuffled = [rnd.sample(t, len(t)) for t in texts[:5]]
    docs = spark.createDataFrame([(i, " ".join(t), "en") for i, t in enumerate(texts)] + [(1000 + i, "\n".join(t), "en") for i, t in enumerate(shuffled)], "doc_id long, text string, lang string").repartition(3)
    out = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(out[1000 + i].run_log_ppl > 1.2 * out[i].run_log_ppl and not out[1000 + i].kept for i in range(5))
    assert sum(out[i].kept for i in range(200)) >= 198


def test_windows_are_of_running_text():
    key, first = quality.running(words(pa.array(["ab\n c", None, "d"])), np.array([1, 2, 3]))
    assert first.tolist() == [0, 5, 5, 7]
    assert [int(k).to_bytes(8, "big")[2:] for k in key] == [b"\x01    a", b"\x01   ab", b"\x01  ab ", b"\x01 ab c", b"\x01ab c ", b"\x03    d", b"\x03   d "]


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "banana bandana ban nab abba", "x"), (2, "can cab bac", "x"), (3, "other", "y")], "doc_id long, text string, lang string")
    numbers = quality.languages(docs)
    assert numbers == {"x": 0, "y": 2}
    paths = quality.model(docs, numbers)
    for context in (b"    ", b"  ba", b"bana", b"qqqq"):
        key = np.array([(numbers["x"] << 40) | int.from_bytes(context + bytes([c]), "big") for c in range(256)], np.int64)
        assert abs((10 ** quality.log_prob(key, paths)).sum() - 1) < 0.005  # one of 257 symbols never comes


class ByteModel:
    """Interpolated modified Kneser-Ney over five-byte windows, by dictionaries."""

    def __init__(self, windows):
        levels = {5: Counter(windows)}
        for k in (4, 3, 2, 1):
            levels[k] = Counter(w[1:] for w in levels[k + 1])
        self.count, self.total, self.gamma, self.off = {}, {}, {}, {}
        for k, found in levels.items():
            n = [sum(v == i for v in found.values()) for i in range(1, 5)]
            y = n[0] / max(1, n[0] + 2 * n[1])
            d = [max(0.1, min(i - 0.05, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 for i in (1, 2, 3)]
            total, off = Counter(), Counter()
            for w, c in found.items():
                total[w[:-1]] += c
                off[w[:-1]] += min(c, d[min(c, 3) - 1])
            self.count[k], self.total[k], self.off[k], self.gamma[k] = found, total, d, {x: off[x] / total[x] for x in total}

    def p(self, w):
        if not w:
            return 1 / 257
        k, low = len(w), self.p(w[1:])
        total = self.total[k][w[:-1]]
        if not total:
            return low
        c = self.count[k][w]
        return (max(0.0, c - self.off[k][min(c, 3) - 1]) if c else 0.0) / total + self.gamma[k][w[:-1]] * low


def verdicts(docs, width=4.0, least=0.06):
    """doc_id: (kept, log_ppl, run_log_ppl), from the two models and the bands written plainly."""
    import math

    split = {d: [x.encode() for x in WORD.findall(t or "")] for d, (t, _) in docs.items()}
    of = lambda raw: [raw[i : i + 5] for i in range(len(raw) - 4)]
    inner = lambda w: of(b"    " + w + b" ")
    through = lambda ws: of(b"    " + b"".join(w + b" " for w in ws)) if ws else []
    out = {}
    for lang in {x for _, x in docs.values()}:
        ids = [d for d, (_, x) in docs.items() if x == lang]
        by_word = ByteModel([x for d in ids for w in split[d] for x in inner(w)])
        by_text = ByteModel([x for d in ids for x in through(split[d])])
        scored = {}
        for d in ids:
            n = sum(any(c >= 128 or chr(c).isalnum() for c in w) for w in split[d])
            logs = lambda m, found: -sum(math.log10(m.p(x)) for x in found) / n if n else None
            counts = brute(docs[d][0] or "")
            failed = counts["n_words"] < 50 or 100 * counts["n_repeat_words"] > 50 * counts["n_words"]
            scored[d] = (counts["n_words"], failed, logs(by_word, [x for w in split[d] for x in inner(w)]), logs(by_text, through(split[d])))
        at = lambda values, share: sorted(values)[max(0, math.ceil(share * len(values)) - 1)]
        band = []
        for k in (2, 3):
            fit = [s for s in scored.values() if not s[1] and s[k] is not None]
            if not fit:
                band.append(None)
                continue
            mid = at([s[k] for s in fit], 0.5)
            z = [(s[k] - mid) * math.sqrt(s[0]) for s in fit]
            band.append((mid, (at(z, 0.75) - at(z, 0.25)) / 1.349))
        for d, s in scored.items():
            ok = not s[1] and all(b and x is not None and abs(x - b[0]) <= max(least * b[0], width * b[1] / math.sqrt(s[0])) for x, b in zip(s[2:], band))
            out[d] = (ok, s[2], s[3])
    return out


def test_kept_against_brute_force(spark):
    rnd = random.Random(11)
    vocabulary = {lang: ["".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 8))) for _ in range(80)] for lang, letters in (("a", "abcdefgh"), ("b", "éüstuvwx"))}
    docs = {}
    for i in range(120):
        lang = rnd.choice("ab")
        w = [rnd.choice(vocabulary[lang]) for _ in range(rnd.randrange(30, 160))]
        r = rnd.random()
        if r < 0.1:
            w = [x + "#" for x in w]
        elif r < 0.2:
            w = ["".join(rnd.sample(x, len(x))) for x in w]
        elif r < 0.25:
            w = w[:3] * 40
        docs[i] = (rnd.choice([" ", "\n"]).join(w), lang)
    docs |= {500: ("", "a"), 501: (None, "c"), 502: ("| " * 60, "a"), 503: (" ".join(vocabulary["b"]), "a")}
    df = spark.createDataFrame([(d, t, x) for d, (t, x) in docs.items()], "doc_id long, text string, lang string").repartition(3)
    out = {r.doc_id: r for r in quality.judge(df).collect()}
    want = verdicts(docs)
    assert set(out) == set(want) and 20 < sum(k for k, _, _ in want.values()) < 110
    for d, (keeps, words_, running) in want.items():
        assert out[d].kept == keeps, d
        for got, x in ((out[d].log_ppl, words_), (out[d].run_log_ppl, running)):
            assert (got is None) == (x is None) and (x is None or abs(got - x) < 1e-4 * max(1, x)), d


def test_bands_do_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["ban", "cab", "dab", "fan", "gab", "han"]) for _ in range(60)), None if i % 3 else "x") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = (sorted((r.doc_id, r.kept, round(r.log_ppl_low, 6), round(r.run_log_ppl_high, 6)) for r in quality.judge(df.repartition(n)).collect()) for n in (1, 7))
    assert a == b


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(quality, "LANGUAGES", 2)
    df = spark.createDataFrame([(i, "x", str(i)) for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        quality.judge(df)
