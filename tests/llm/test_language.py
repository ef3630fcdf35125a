import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tollgate.llm import language

SOUNDS = {"aa": ["ka", "mo", "ti", "ru"], "bb": ["sch", "ein", "üb", "ung"], "cc": ["ção", "inh", "lh", "os"], "dd": ["日", "本", "語", "文"]}


def corpus(seed, n=900):
    rnd = random.Random(seed)
    docs = []
    for i in range(n):
        lang = rnd.choice(list(SOUNDS))
        word = lambda: "".join(rnd.choice(SOUNDS[lang] if rnd.random() < 0.8 else ["e", "n", "r", "s"]) for _ in range(rnd.randrange(1, 5)))  # noqa: B023, E731
        docs.append((i, " ".join(word() for _ in range(rnd.randrange(4, 80))), lang))
    return docs


def test_held_out_accuracy_and_cases(spark):
    docs = corpus(1)
    truth = {d: lang for d, _, lang in docs}
    odd = [(5000, "", "aa"), (5001, None, "aa"), (5002, "12 ... 9 ½", "bb"), (5003, "schein " * 40_000, None), (5003, "schein " * 40_000, None), (None, "sch ein üb", "aa"), (5004, "übung ung", None)]
    df = spark.createDataFrame([(d, t, lang, 0.5) for d, t, lang in docs + odd], "doc_id long, text string, lang string, score double").repartition(5)
    out = language.identify(df).collect()
    assert len(out) == len(docs) + len(odd)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in out)
    right = [r.lang_pred == truth[r.doc_id] for r in out if r.held_out and r.doc_id in truth]
    assert len(right) > 200 and sum(right) >= 0.98 * len(right)
    by = {r.doc_id: r for r in out}
    assert all(by[d].lang_pred == "und" and by[d].score == 0 and by[d].ambiguous for d in (5000, 5001, 5002))
    assert by[5003].lang_pred == by[None].lang_pred == by[5004].lang_pred == "bb" and not by[5003].ambiguous


def test_the_label_of_what_is_held_out_is_no_input(spark):
    docs = corpus(2, 120)
    lie = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 3 == 1 else lang) for d, t, lang in docs]
    make = lambda rows: sorted(map(tuple, language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()))
    assert make(docs) == make(lie)


def test_few_languages_and_none(spark):
    one = spark.createDataFrame([(i, "abc def", "x") for i in range(6)] + [(9, "", "y"), (10, "?", None)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.identify(one).collect()} == {("x", 1.0), ("und", 0.0)}
    none = one.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language.identify(none).collect()} == {("und", 0.0)}
    assert language.identify(one.limit(0)).count() == 0
    two = spark.createDataFrame([(i, ["schein ung", "moka tiru"][i % 2], ["", "m"][i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    assert {(r.doc_id % 2, r.lang_pred) for r in language.identify(two).collect()} == {(0, ""), (1, "m")}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 30, 200])
def test_codewords_lie_far_apart(n):
    code = language.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
    if n > 1:
        distance = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        assert distance >= (2 ** (n - 2) if n <= language.EXHAUSTIVE else code.shape[1] // 5)
        assert all(-n < s < n for s in code.sum(0, dtype=int))


def test_a_wrong_bit_is_corrected():
    code = language.codewords(4)
    trust = np.full(code.shape, 1 / code.shape[1])
    model = language.Model(list("abcd"), code, np.zeros((code.shape[1], 1), np.float32), trust)
    for i in range(4):
        for flip in range(code.shape[1]):
            bits = 3.0 * code[i].astype(float)
            bits[flip] *= -1
            assert model.decoded(bits[None])[0][0] == i
    trust[0] = np.eye(code.shape[1])[0]  # a language whose only trusted bit is the first
    assert model.decoded(np.where(np.arange(code.shape[1]) == 0, 5.0, -5.0)[None] * code[0])[0][0] == 0


def test_evidence_by_hand():
    """Every n-gram of every word, one by one."""
    texts = ["Ab, cd Ab", "", None, "é1x " * 300 + "q"]
    e = language.evidence(pa.array(texts))
    for i, text in enumerate(texts):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        found = np.concatenate([np.zeros(0, np.int64), *[e.slots[e.first[k] : e.first[k + 1]] for k in e.kind[e.words.first[i] : e.words.first[i + 1]]]])
        want = []
        for w in words:
            raw = b" " + w.encode() + b" "
            want += [raw[j : j + n] for n in range(1, 5) for j in range(len(raw) - n + 1) if n > 1 or 0 < j < len(raw) - 1] + [w.encode() * 100]
        assert len(found) == len(want)
        assert len(np.unique(found)) == len(set(want))
