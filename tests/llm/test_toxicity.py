import random
import zlib

from tollgate.llm import toxicity


def test_held_out_accuracy_and_cases(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice(["an", "er", "in", "th", "ou", "st"]) for _ in range(rnd.randrange(1, 4)))
    rows, labels = [], []
    for i in range(1500):
        toxic = rnd.random() < 0.15
        w = [word() for _ in range(rnd.randrange(10, 120))]
        for _ in range(3 if toxic else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["Vile!", "rotten.", "go away", "vile", "scumbag"]))
        rows.append((i, " ".join(w), "x"))
        if i % 3:
            labels.append((i, int(toxic)))
        elif toxic:
            rows[-1] = (i, rows[-1][1], "toxic")
    extra = [(5000, "", "x"), (5001, None, "x"), (5002, "an er " * 30_000, "x"), (5003, "vile rotten scumbag", "x"), (5003, "vile rotten scumbag", "x"), (None, "an er in", "x")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score string").repartition(5)
    known = spark.createDataFrame([*labels, (5001, None), (9, 0), (9, 0)], "doc_id long, toxic int")
    out = toxicity.judge(docs, known).collect()
    assert len(out) == len(rows) + len(extra)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    truth = dict(labels)
    right = [r.predicted == truth[r.doc_id] for r in out if r.held_out and r.doc_id in truth]
    assert len(right) > 150 and sum(right) >= 0.97 * len(right)
    by = {r.doc_id: r for r in out}
    assert by[5003].predicted == 1 and by[5002].predicted == 0 and by[5000].score == by[5001].score
    none = toxicity.judge(docs, known.limit(0))
    assert {r.score for r in none.collect()} == {0.0}
    assert toxicity.judge(docs.limit(0), known).count() == 0


def learned(texts, labels, epochs=4):
    import numpy as np
    import pyarrow as pa

    learner = toxicity.Learner(1.0, 1.0, 2.0, 1.0)
    for _ in range(epochs):
        learner.learn(pa.array(texts), np.array(labels))
    return learner.model()


def test_weights_are_sparse():
    import pyarrow as pa

    rnd = random.Random(1)
    texts = [" ".join(str(rnd.randrange(5000)) for _ in range(50)) + (" bad" if i % 5 == 0 else "") for i in range(400)]
    model = learned(texts, [int(i % 5 == 0) for i in range(400)])
    assert len(model.slots) < 2000
    assert model.score(pa.array(["12 bad", "bad bad bad"]), model.table()).min() > 0.3 > model.score(pa.array(["12 99"]), model.table())[0]


def test_learns_as_ftrl_by_hand():
    """The update rule written row by row and coordinate by coordinate in Python numbers."""
    import math

    import pyarrow as pa

    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("alpha beta gamma delta epsilon omega".split()) for _ in range(rnd.randrange(0, 30))) + (" vile" if i % 4 == 0 else "") for i in range(60)]
    labels = [int(i % 4 == 0) for i in range(60)]
    coordinates = []
    for t in texts:
        coordinates.append(sorted({int(x) for slot, _ in toxicity.features(pa.array([t])) for x in slot}) + ["bias"])
    z, s = {}, {}
    alpha, beta, l1, l2 = 1.0, 1.0, 2.0, 1.0

    def weight(c):
        limit = 0.0 if c == "bias" else l1
        v = z.get(c, 0.0)
        return 0.0 if abs(v) <= limit else -(v - math.copysign(limit, v)) / ((beta + math.sqrt(s.get(c, 0.0))) / alpha + l2)

    for _ in range(3):
        for found, y in zip(coordinates, labels):
            w = {c: weight(c) for c in found}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for c in found:
                n = s.get(c, 0.0)
                z[c] = z.get(c, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / alpha * w[c]
                s[c] = n + g * g
    model = learned(texts, labels, 3)
    table = model.table()
    assert abs(model.bias - weight("bias")) < 1e-4
    for c in z:
        assert c == "bias" or abs(table[c] - weight(c)) < 1e-4
    by_hand = [1 / (1 + math.exp(-sum(weight(c) for c in found))) for found in coordinates]
    assert max(abs(a - b) for a, b in zip(by_hand, model.score(pa.array(texts), table).tolist())) < 1e-4


def test_long_labelled_texts_stream(spark):
    """Labelled texts of several megabytes are learned from in bounded blocks."""
    rnd = random.Random(5)
    long = [" ".join(rnd.choice(["an", "er", "in"]) + str(rnd.randrange(900)) for _ in range(250_000)) + (" vile scum" if i % 2 else "") for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, label int"), epochs=2, shards=2)
    assert toxicity.scored(docs, model).count() == 6
