import hashlib
import random

from tollgate.llm import fingerprints as fp


def make(rnd, n):
    return " ".join(rnd.choice("abcdefgh") * rnd.randrange(1, 4) for _ in range(n))


def shingles(t):
    w = "".join(c.lower() if c.isascii() else c for c in t).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_edited_against_brute_force(spark):
    rnd = random.Random(1)
    found = {i * 3: make(rnd, rnd.randrange(0, 900)) for i in range(120)}
    found |= {400: "", 401: "éa", 402: "one two three", 403: found[9], 404: found[9], 405: " ".join(str(i) for i in range(60_000))}
    docs = spark.createDataFrame([(k, v, "z") for k, v in found.items()] + [(406, None, "z")], "doc_id long, text string, bucket string").repartition(7)
    found[406] = ""
    out = {r.doc_id: r for r in fp.edited(docs).collect()}
    assert set(out) == set(found)
    ids = sorted(found, reverse=True)
    far = []
    for d, e in zip(ids, [*ids[1:], ids[0]]):
        t, r = found[d], out[d]
        k = len(t) // 3
        new = t[: len(t) - k] + found[e][:k]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert fp.likeness(r.fingerprint, r.edited_fingerprint) == r.near_edited
        assert fp.likeness(r.fingerprint, out[e].fingerprint) == r.near_next
        assert fp.read(r.fingerprint)[1] == len(shingles(t))
        a, b = shingles(t), shingles(new)
        if len(a | b) > 200:
            far.append(abs(r.near_edited - len(a & b) / len(a | b)))
    assert max(far) < 0.2 and sum(far) / len(far) < 0.05
    assert out[403].fingerprint == out[404].fingerprint and out[404].near_next == 1.0
    assert out[406].near_next < 1 and out[400].n_chars == 0


def test_contained_and_merged(spark):
    rnd = random.Random(4)
    a, b = " ".join(str(rnd.random()) for _ in range(4000)), " ".join(str(rnd.random()) for _ in range(40_000))
    rows = {r.doc_id: r.fingerprint for r in fp.fingerprints(spark.createDataFrame([(1, a), (2, a + " " + b), (3, b)], "doc_id long, text string")).collect()}
    assert fp.containment(rows[1], rows[2]) > 0.99 and fp.containment(rows[2], rows[1]) < 0.13
    assert abs(len(fp.merged(rows[1], rows[3])) - len(fp.read(rows[2])[2])) < 10


def test_small_tables(spark):
    one = spark.createDataFrame([(5, "a b c d e f"), (None, "x")], "doc_id long, text string")
    assert fp.edited(one.limit(0)).count() == 0
    assert [r.near_next for r in fp.edited(one.where("doc_id = 5")).collect()] == [1.0]
    assert {r.doc_id for r in fp.edited(one).collect()} == {5, None}
    assert fp.edited(one.union(one)).count() == 4


def test_a_sketch_does_not_depend_on_its_block():
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(9)
    texts = [make(rnd, rnd.randrange(0, 60)) for _ in range(8000)]
    whole, n = fp.sketches(pa.array(texts))
    for size in (1, 300):
        for i in range(0, 1200, size):
            kept, count = fp.sketches(pa.array(texts[i : i + size]))
            assert count.tolist() == n[i : i + size].tolist()
            assert all(np.array_equal(a, b) for a, b in zip(kept, whole[i : i + size]))
