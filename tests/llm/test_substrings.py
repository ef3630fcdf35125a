import hashlib
import random
import re

import pytest

from tollgate.llm import substrings


def brute(docs):
    """doc_id: (n_words, n_removed, digest) by looking at every window."""
    split = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in docs.items()}
    first = {}
    for d in sorted(split):
        for i in range(len(split[d]) - 12):
            first.setdefault(tuple(split[d][i : i + 13]), d)
    out = {}
    for d, w in split.items():
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < d for j in range(i, i + 13)}
        out[d] = (len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest())
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["the", "of", "and", "in"]) if rnd.random() < 0.4 else "".join(rnd.choice("aeioust") for _ in range(4))
    make = lambda n: [word() for _ in range(n)]
    passages = [make(rnd.randrange(13, 80)) for _ in range(6)]
    docs = {}
    for i in range(200):
        w = make(rnd.randrange(0, 200))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(w) + 1)
            w[at:at] = rnd.choice(passages)
        if docs and rnd.random() < 0.15:
            w = docs[rnd.choice(list(docs))].split()
            if rnd.random() < 0.6 and w:
                w[rnd.randrange(len(w))] = "changed"
        docs[i * 7 % 1000 + 1000 * (i % 2)] = rnd.choice([" ", "\n", " \t"]).join(w)
    docs |= {5001: "", 5002: None, 5003: "Pare " * 400, 5004: "Pare " * 30, 5005: " ".join(str(i) for i in range(9000)), 5006: " ".join(str(i) for i in range(100, 5000)), 5007: "a\x1fb \x85 c " * 9}
    return docs


@pytest.mark.parametrize("batches", [1, 2, 6])
def test_against_brute_force(spark, batches):
    docs = corpus(batches)
    df = spark.createDataFrame([(k, v, "p") for k, v in docs.items()], "doc_id long, text string, pos string").repartition(6)
    df = df.selectExpr("doc_id", "coalesce(text, '') as text", "pos")
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digest(df, batches).collect()}
    assert out == brute(docs)


def test_runs_are_compacted_and_keep_their_order(spark):
    index = substrings.FingerprintIndex(spark, 4, fanout=2)
    rnd = random.Random(1)
    for k in range(4):
        batch = spark.createDataFrame([(k * 10 + i, " ".join(str(rnd.random()) for _ in range(40))) for i in range(5)], "doc_id long, text string")
        index.add(substrings.prints(batch, None))
    assert len(index.runs) <= 2 and index.compactions == 1
    ids = [x for r in index.runs for row in spark.table(r).collect() for x in (row.least, row.most) if x is not None]
    assert (min(ids), max(ids)) == (0, 34)
    with pytest.raises(ValueError):
        index.add(substrings.prints(batch, None))
    name = index.runs[0]
    index.close()
    assert not spark.catalog.tableExists(name)


def test_default_batches_compact(spark, monkeypatch):
    seen = []
    compact = substrings.FingerprintIndex.compact
    monkeypatch.setattr(substrings.FingerprintIndex, "compact", lambda self: (seen.append(len(self.runs)), compact(self)))
    df = spark.createDataFrame([(i, " ".join(str(j) for j in range(i, i + 30))) for i in range(100)], "doc_id long, text string")
    assert substrings.digest(df).count() == 100 and seen == [3]


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(2, text), (2, text), (1, "x")], "doc_id long, text string")
    assert sorted(r.n_removed for r in substrings.digest(df).collect()) == [0, 0, 0]
    assert substrings.digest(df.limit(0)).count() == 0
