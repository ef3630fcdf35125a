import random
import re

from tollgate.llm import jaccard
from tollgate.llm.components import components


def brute(docs):
    sets = {}
    for d, t in docs.items():
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets[d] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    up = {d: d for d in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {d: (len(sets[d]), root(d)) for d in docs}


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["The", "of", "and", "in"]) if rnd.random() < 0.4 else "".join(rnd.choice("aeioust") for _ in range(4))
    docs, line = {}, " ".join(word() for _ in range(9))
    for base in range(12):
        w = [word() for _ in range(rnd.randrange(5, 260))]
        for k in range(rnd.randrange(1, 22)):
            v = list(w)
            for _ in range(rnd.randrange(0, 1 + len(w) // 25)):
                v[rnd.randrange(len(v))] = word()
            if rnd.random() < 0.3:
                v = v[rnd.randrange(3) :]
            docs[rnd.randrange(10**6)] = (line + " " if base % 2 else "") + rnd.choice([" ", "\n"]).join(v)
    docs |= {2_000_001: "", 2_000_002: None, 2_000_003: "one two", 2_000_004: "ONE two", 2_000_005: "two one", 2_000_006: "a b c d", 2_000_007: "a b c d e", 2_000_008: "pare " * 90, 2_000_009: "pare " * 4}
    docs |= {3_000_000 + i: line + f" {i}" for i in range(40)}
    return docs


def test_against_brute_force(spark):
    for seed in (1, 2, 3):
        docs = corpus(seed)
        df = spark.createDataFrame([(k, v, "u") for k, v in docs.items()], "doc_id long, text string, u string").repartition(5)
        out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}
        assert out == brute(docs)


def test_ties_and_empty(spark):
    df = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (9, "A b c d e f"), (None, "x")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id) for r in jaccard.join(df).collect() if r.doc_id) == [(7, 7), (7, 7), (9, 7)]
    assert jaccard.join(df.limit(0)).count() == 0


def test_rows_repeated_over_partitions(spark):
    from pyspark.sql import functions as F

    w = lambda tag, k: [f"{tag}{i}" for i in range(k)]
    docs = {1: w("p", 53) + w("q", 50), 2: w("p", 53) + w("r", 50)}
    docs |= {10 + i: w("q", 50) + w(f"s{i}x", 30 + i) for i in range(9)} | {30 + i: w("r", 50) + w(f"t{i}x", 30 + i) for i in range(9)}
    docs |= {50: w("u", 60), 51: w("u", 59) + ["v"]}
    rows = [(k, " ".join(v), part) for k, v in docs.items() for part in (range(4) if k in (1, 2, 50) else [k % 4])]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int").repartitionByRange(4, F.col("part")).select("doc_id", "text")
    want = brute({k: " ".join(v) for k, v in docs.items()})
    out = jaccard.join(df).collect()
    assert len(out) == len(rows) and want[2][1] == 2 and want[51][1] == 50
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in out} == {(k, *v) for k, v in want.items()}


def test_components(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    up = {x: x for p in pairs for x in p}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        p, q = sorted((root(a), root(b)))
        up[q] = p
    out = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert out == {x: root(x) for x in up if any(x in p and p[0] != p[1] for p in pairs)}
