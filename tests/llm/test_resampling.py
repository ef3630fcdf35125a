import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from tollgate.llm import resampling


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), Counter(" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))


def brute(docs, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    count = lambda texts: sum((Counter({bucket(f): 0 for f in c}) + Counter(f for x, k in c.items() for f in [bucket(x)] * k) for c in (features(t)[1] for t in texts)), Counter())
    s, t = count(x for _, x in docs), count(target)
    big, small = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big + 10000) / ((s[b] + 1) * (small + 10000))))
    out, open_ = {}, []
    for d, text in docs:
        n, c = features(text)
        weight = sum(gain(bucket(f)) * k for f, k in c.items())
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[d] = [sum(c.values()), weight, score, None]
        if n >= 20:
            open_.append((-score, d is None, d or 0, d))
    for i, x in enumerate(sorted(open_)[: 5 * len(open_) // 100]):
        out[x[3]][3] = i + 1
    return {d: tuple(v) for d, v in out.items()}


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["the", "Of", "AND", "naïve", "x1", "9", "Ünder", "日本"]) if rnd.random() < 0.6 else "".join(rnd.choice("aeiou") for _ in range(rnd.randrange(1, 40)))
    docs = [(i * 13 % 1009, rnd.choice([" ", "\n", "-", "\x7f.", "_"]).join(word() for _ in range(rnd.randrange(0, 120)))) for i in range(400)]
    return docs + [(2000, ""), (2001, None), (None, "a b c " * 30), (2002, "a " * 4000), (2003, "z" * 70_000 + " y"), (2004, docs[0][1]), (-5, "...")]


def test_against_brute_force(spark, monkeypatch):
    docs = corpus(1)
    target = [t for _, t in corpus(2)[:40]] + [None, ""]
    df = spark.createDataFrame([(d, t, 7) for d, t in docs], "doc_id long, text string, rank int").repartition(7)
    out = resampling.digest(df, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in out} == brute(docs, target)
    assert sorted(r.rank for r in out if r.rank) == list(range(1, len([r for r in out if r.rank]) + 1)) and len(out) == len(docs)


def test_spans_change_nothing(monkeypatch):
    block = pa.RecordBatch.from_pydict({"text": pa.array([t for _, t in corpus(3)])})
    whole = sum(t.totals() for _, t, _, _ in resampling.tries(block))
    monkeypatch.setattr(resampling, "SPAN", 7)
    assert (sum(t.totals() for _, t, _, _ in resampling.tries(block)) == whole).all()
    assert whole.sum() == sum(sum(features(t)[1].values()) for _, t in corpus(3))


def test_paths_share_nodes():
    block = pa.RecordBatch.from_pydict({"text": pa.array(["a b c a b c a b"])})
    ((_, t, _, _),) = resampling.tries(block)
    assert [len(c) for c in t.counts] == [3, 3, 3] and sorted(t.counts[0].tolist()) == [2, 3, 3]
    assert set(t.crcs[2].tolist()) == {zlib.crc32(x) for x in (b"a b c", b"b c a", b"c a b")}


def test_ties_repeats_and_empty(spark):
    text = " ".join(map(str, range(25)))
    df = spark.createDataFrame([(1, text)] * 60 + [(2, text)] * 40, "doc_id long, text string").repartition(4)
    none = spark.createDataFrame([], "text string")
    out = resampling.resample(df, none).collect()
    ranked = sorted((r.rank, r.doc_id) for r in out if r.rank)
    best = max(out, key=lambda r: r.score).doc_id
    assert ranked == [(i, best) for i in range(1, 6)]
    assert resampling.resample(df.limit(0), none).count() == 0
    assert {r.rank for r in resampling.resample(df.limit(3), none).collect()} == {None}


def test_equal_scores_go_to_the_smaller_doc_id(spark):
    scored = spark.createDataFrame([(d, 30, 1, 5, 5) for d in (9, 3, 7, None, 1)] + [(0, 3, 1, 9, 9)], "doc_id long, n_words long, n_features long, weight long, score long")
    assert {r.doc_id: r.rank for r in resampling.drawn(scored, 80, 20).collect()} == {1: 1, 3: 2, 7: 3, 9: 4, None: None, 0: None}
