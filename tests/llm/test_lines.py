import hashlib
import random
import re

from tollgate.llm import lines
from tollgate.llm.words import words


def near(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < lines.NEAR or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    found = []
    for d in sorted(docs):
        for k, x in enumerate((docs[d] or "").split("\n")):
            w = ["".join(c.lower() if c.isascii() else c for c in y) for y in re.findall(r"[^\x20\x09-\x0D]+", x)]
            if w:
                found.append((d, k, w))
    gone = {(d, k) for i, (d, k, w) in enumerate(found) if any(near(w, v) for _, _, v in found[:i])}
    out = {}
    for d, t in docs.items():
        left = "\n".join(x for k, x in enumerate((t or "").split("\n")) if (d, k) not in gone)
        out[d] = (sum(x[0] == d for x in found), sum(x[0] == d for x in gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def test_against_brute_force(spark):
    rnd = random.Random(3)
    word = lambda: rnd.choice(["The", "of", "a", "a", "in", "no"])
    pool = [[word() for _ in range(rnd.randrange(1, 16))] for _ in range(60)] + [["a"] * n for n in range(9, 14)]
    docs = {}
    for i in range(90):
        found = []
        for _ in range(rnd.randrange(6)):
            x = list(rnd.choice(pool))
            r = rnd.random()
            if r < 0.3:
                x[rnd.randrange(len(x))] = word() + rnd.choice(["", "z"])
            elif r < 0.4:
                x.insert(rnd.randrange(len(x) + 1), word())
            elif r < 0.5 and len(x) > 1:
                x.pop(rnd.randrange(len(x)))
            found.append(rnd.choice([" ", "\t"]).join(x))
        docs[i * 37 % 1000] = rnd.choice(["\n", "\n\n", " \n"]).join(found)
    docs |= {2001: "", 2002: None, 2003: "\n", 2004: " ".join(map(str, range(30_000))), 2005: " ".join(map(str, range(1, 30_000)))}
    df = spark.createDataFrame([(k, v, 1) for k, v in docs.items()], "doc_id long, text string, line int").repartition(5)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in lines.digest(df).collect()} == brute({k: v for k, v in docs.items()})


def test_ties_and_empty(spark):
    x = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(7, x), (7, x), (None, x), (9, x + " eleven")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in lines.dedup(df).collect()) == [(0, 0), (7, 0), (7, 0), (9, 1)]
    assert lines.dedup(df.limit(0)).count() == 0


def test_short_lines_repeat(spark):
    df = spark.createDataFrame([(1, "All rights reserved.\nHome\nfirst of all"), (2, "second\nall RIGHTS reserved."), (3, "home\n\nAll rights kept.")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.dedup(df).collect()} == {1: "All rights reserved.\nHome\nfirst of all", 2: "second", 3: "\nAll rights kept."}


def test_second_hash_is_another():
    import pyarrow as pa

    w = words(pa.array(["a b a", "c"]))
    h, other = w.hashes(), lines._second(w)
    assert other[0] == other[2] and len(set(other.tolist()) | set(h.tolist())) == 6


def test_distance_by_words():
    rnd = random.Random(4)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for _ in range(3000):
        a, b = ([rnd.choice("xyz") for _ in range(rnd.randrange(1, 7))] for _ in range(2))
        assert lines.within(" ".join(a), " ".join(b)) == (distance(a, b) <= 1)


def test_unlike_texts_under_one_id_and_near_as_a_parameter(spark):
    a, b = "one two three four five six", "one two three four five seven"
    df = spark.createDataFrame([(1, a), (1, b), (2, b), (2, "other")], "doc_id long, text string").repartition(4)
    assert sorted((r.doc_id, r.text) for r in lines.dedup(df).collect()) == sorted([(1, a), (1, b), (2, ""), (2, "other")])
    assert sum(r.n_removed for r in lines.dedup(df, near=2).collect()) == 2


def test_variants_by_steps_and_checks_of_some_lines(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(5)
    w = words(pa.array(["\n".join(" ".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 30))) for _ in range(40)), "", "d " * 50]))
    first, _, _ = lines.lines(w)
    some = np.flatnonzero(np.diff(first) >= 10)
    h = lines._second(w)
    key, line, at, out = lines.neighbourhoods(h, first, some)
    assert list(zip(line.tolist(), at.tolist())) == [(i, k) for i in some.tolist() for k in range(int(first[i + 1] - first[i]))]
    monkeypatch.setattr(lines, "STEP", 16)  # shorter than some lines
    again = lines.neighbourhoods(h, first, some)
    assert all((x == y).all() for x, y in zip((key, line, at, out), again))
    few = some[::3]
    mine = np.isin(line, few)
    assert (lines._checks(w, first, few) == np.concatenate((key[few], out[mine]))).all()
    assert len(lines._checks(w, first, few[:0])) == 0


def test_counts_come_back_in_the_order_asked(spark):
    import numpy as np
    import pyarrow as pa

    from tollgate.llm import counting, parts

    texts = [" ".join(random.Random(i).choices("abcdefghij", k=30)) for i in range(12)]
    docs = parts_table(spark, texts)
    seen = parts.witnessed(docs)
    keys_of = lambda block: words(block.column("text")).hashes()
    for buckets in (1, 40):
        path = counting.answered(docs, keys_of, buckets, "counts", seen)

        def each(batches, path=path, buckets=buckets):
            asked = counting.Answers(path, buckets)
            from tollgate.llm.words import blocks

            for k, block in enumerate(b for batch in batches for b in blocks(batch, size=counting.BLOCK)):
                w = words(block.column("text"))
                counts = asked.counts(k, w.hashes())
                yield pa.RecordBatch.from_pydict({"word": pa.array([w.bytes_of(i).decode() for i in range(len(w.starts))]), "n": pa.array(counts.astype(np.int64))})

        out = docs.mapInArrow(each, "word string, n long").collect()
        want = " ".join(texts).split()
        assert len(out) == len(want) and all(r.n == want.count(r.word) for r in out)


def parts_table(spark, texts):
    from tollgate.llm.tables import steady

    return steady(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
