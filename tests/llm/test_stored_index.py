"""Batches that meet a stored index, each as if in a process of its own, against every window of all texts."""

import hashlib
import random

import pytest

from tests.llm.test_substrings import brute
from tollgate.llm.stored_index import KINDS, StoredIndex
from tollgate.refusals import CommitConflict


def forgotten(spark):
    """The session knows no run any more, as that of another process doesn't."""
    for t in spark.catalog.listTables():
        if t.name.startswith(tuple(f"{k}_" for k in KINDS)):
            spark.sql(f"drop table {t.name}")


def corpus(seed, n=160):
    rnd = random.Random(seed)
    make = lambda k: [rnd.choice(["the", "of"]) if rnd.random() < 0.3 else "".join(rnd.choice("aeioust") for _ in range(4)) for _ in range(k)]
    passages = [make(rnd.randrange(13, 60)) for _ in range(5)]
    docs = {}
    for i in range(n):
        w = make(rnd.randrange(0, 120))
        if rnd.random() < 0.5:
            at = rnd.randrange(len(w) + 1)
            w[at:at] = rnd.choice(passages)
        if docs and rnd.random() < 0.15:
            w = (docs[rnd.choice(list(docs))] or "").split()
        docs[i * 3] = rnd.choice([" ", "\n"]).join(w)
    return docs | {6: None, 9: "", 300: "Pare " * 90, 303: "Pare " * 20}


def frame(spark, docs, files=3):
    return spark.createDataFrame([(k, v) for k, v in docs.items()], "doc_id long, text string").repartition(files)


def taken(df):
    return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in df.collect()}


def batches(docs, n):
    ids = sorted(docs)
    cuts = [len(ids) * i // n for i in range(n + 1)]
    return [{d: docs[d] for d in ids[a:b]} for a, b in zip(cuts, cuts[1:])]


def windows_of_all(docs):
    return {tuple(w[i : i + 13]) for w in (v.split() for v in docs.values() if v) for i in range(len(w) - 12)}


@pytest.mark.parametrize("n,fanout", [(1, 2), (5, 1)])
def test_batches_of_many_processes(spark, tmp_path, n, fanout):
    docs, out = corpus(n), {}
    for batch in batches(docs, n):
        forgotten(spark)
        index = StoredIndex(spark, str(tmp_path / "index"), buckets=3, fanout=fanout)
        added = index.add(frame(spark, batch))
        out |= taken(added.kept)
        index.commit(added)
    assert out == brute(docs)
    forgotten(spark)
    index = StoredIndex(spark, str(tmp_path / "index"), buckets=7, fanout=fanout)
    assert index.state["buckets"] == 3 and index.state["last"] == max(docs)
    stored = [r for run in index.state["windows"] for r in index.table("windows", run["name"]).collect()]
    assert len(stored) == len(set(stored)) == len(windows_of_all(docs))
    for kind in KINDS:
        levels = [r["level"] for r in index.state[kind]]
        assert all(levels.count(x) <= fanout for x in levels) and (n == 1 or max(levels) > 0)


def test_a_batch_counts_when_it_is_committed(spark, tmp_path):
    text, path = " ".join(map(str, range(40))), str(tmp_path / "index")
    one, two = frame(spark, {1: text}), frame(spark, {2: "new " + text, 3: text + " end", 4: None})
    index = StoredIndex(spark, path, buckets=2)
    first = index.add(one)
    assert StoredIndex(spark, path).state["windows"] == []  # as after a writer that died
    other = StoredIndex(spark, path, buckets=2)
    again = other.add(one)
    assert taken(again.kept) == taken(first.kept)
    other.commit(again)
    with pytest.raises(CommitConflict):
        index.commit(first)
    index = StoredIndex(spark, path)
    got = {r.doc_id: (r.n_removed, r.text) for r in index.add(two).kept.collect()}
    assert got == {2: (40, "new"), 3: (40, "end"), 4: (0, "")}
    with pytest.raises(ValueError):
        index.add(one)
    named = {r["name"] for kind in KINDS for r in index.state[kind]}
    assert index.vacuum() and {p.name for p in (tmp_path / "index" / "runs").iterdir()} == named
    assert {r.doc_id: r.n_removed for r in index.add(two).kept.collect()} == {2: 40, 3: 40, 4: 0}


def test_stored_runs_are_joined_where_they_lie(spark, tmp_path):
    index = StoredIndex(spark, str(tmp_path / "index"), buckets=3)
    index.commit(index.add(frame(spark, corpus(9, 40))))
    new = index._dealt(spark.range(1000).selectExpr("id as h1", "int(id) as h2"), "windows")
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index._stored(new, "windows")._jdf.queryExecution().sparkPlan().toString()
        joined = new.join(index.table("windows", index.state["windows"][0]["name"]), ["h1", "h2"], "left_semi")
        assert joined.count() == 0 and "Bucketed: true" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange") == 1 and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_odd_batches(spark, tmp_path):
    text = " ".join(map(str, range(20)))
    index = StoredIndex(spark, str(tmp_path / "index"), buckets=2)
    schema = "doc_id long, text string, pos string, h1 long, known boolean"
    rows = [(1, text, "a", 1, True), (1, text, "b", 2, False), (None, text, None, None, None), (2, text, "c", 3, None)]
    for n in range(2):
        empty = index.add(spark.createDataFrame([], schema), ("pos",))
        assert empty.kept.count() == 0
        index.commit(empty)
        assert (index.state["last"], len(index.state["windows"])) == ((None, 0), (2, 1))[n]
        if n == 0:
            added = index.add(spark.createDataFrame(rows, schema), ("pos", "h1", "known"))
            assert sorted((r.doc_id or 0, r.pos or "", r.h1 or 0, r.n_removed) for r in added.kept.collect()) == [(0, "", 0, 0), (1, "a", 1, 0), (1, "b", 2, 0), (2, "c", 3, 20)]
            index.commit(added)
    nulls = index.add(spark.createDataFrame([(None, text, "x", 1, True)], schema))
    assert [r.n_removed for r in nulls.kept.collect()] == [0] and nulls.state == index.state
    spaced = index.add(spark.createDataFrame([(7, f"a  b\n{text} c\n d", "x", 1, True)], schema), spacing=True)
    assert [(r.n_removed, r.text) for r in spaced.kept.collect()] == [(20, "a  b\nc\n d")]
