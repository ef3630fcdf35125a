import random

import corpus_pipeline as cp


def test_stages(spark, tmp_path):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice(["an", "er", "in", "th", "ou", "st"]) for _ in range(rnd.randrange(1, 5)))
    make = lambda n: "\n".join(" ".join(word() for _ in range(12)) for _ in range(n))
    line, passage = " ".join(word() for _ in range(14)), " ".join(word() for _ in range(60))
    rows, labels = [], []
    for i in range(400):
        text = make(rnd.randrange(2, 9))
        if i % 6 == 0:
            text = "vile rotten scum\n" + text
        rows.append((i, text))
        labels.append((i, 1, int(i % 6 == 0)))
    clean = [make(6) for _ in range(5)]
    rows += [(1000, clean[0]), (1001, clean[0]), (1002, line + "\n" + clean[1]), (1003, clean[2] + "\n" + line + " x"), (1004, clean[3] + " " + passage), (1005, passage + " " + clean[4]), (1006, ""), (1007, None)]
    near = (line + " " + clean[1]).split()
    near[3:3] = ["new"]
    rows.append((1008, " ".join(near)))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    state, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (_, stage) in enumerate(cp.STAGES):
        state = stage(spark, state, str(tmp_path))
        state.write.parquet(str(tmp_path / f"s{i}"))
        state = spark.read.parquet(str(tmp_path / f"s{i}"))
        seen.append(state)
        if i < 4:
            assert state.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    toxic, lined, unlike, cut = ({r.doc_id: r.text for r in s.collect()} for s in seen[:4])
    assert sum(i % 6 == 0 for i in toxic if i < 400) == 0 and sum(i % 6 != 0 for i in toxic if i < 400) >= 330
    assert 1001 not in lined and lined[1000] == clean[0] and lined[1003] == clean[2] and 1006 in lined and 1007 in lined
    assert 1008 not in unlike or 1002 not in unlike
    assert cut[1004] == clean[3] + " " + passage and passage not in cut[1005] and cut[1005] == clean[4]
    assert {r.doc_id for r in seen[4].collect()} == set(cut)
    assert cp.run(spark, str(tmp_path)).count() == seen[4].count()


def test_odd_tables(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text), (5, None), (6, ""), (7, text), (7, text), (8, "\n".join([text, "one more line"]))]
    for name, some in (("odd", rows), ("none", [])):
        at = tmp_path / name
        spark.createDataFrame(some, "doc_id long, text string").write.parquet(str(at / "documents.parquet"))
        spark.createDataFrame([(None, None), (5, None)], "doc_id long, toxic int").write.parquet(str(at / "labels.parquet"))
        out = cp.run(spark, str(at)).collect()
        assert sum(r.piece == 0 for r in out) == len(some)
        if some:
            assert {r.length for r in out if r.doc_id in (5, 6)} == {1}
            assert len({(r.length, r.ids_crc32) for r in out if r.doc_id in (None, 7)}) == 1
            whole = next(r.length for r in out if r.doc_id == 7)
            assert 1 < next(r.length for r in out if r.doc_id == 8) < whole
