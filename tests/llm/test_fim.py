import hashlib
import random
import re

import numpy as np
import pytest

from tests import oracle
from tollgate.llm import automata, fim


def brute(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text, text
    form = "spm" if h[3] % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}", text


def corpus(seed):
    rnd = random.Random(seed)
    bit = lambda: rnd.choice(["\n", "\n\n", "a", "é", "日本", "<", "P>", "<P", "<<S", "x" * 40, "😀", "\r\n", "<m>", " "])
    docs = {i * 7: "".join(bit() for _ in range(rnd.randrange(0, 80))) for i in range(150)}
    return docs | {-1: "", -2: None, None: "no id\nat all\n", -3: "\n", -4: "a<P>b\n" * 9, -5: "line\n" * 3000, -6: "one line " * 900, -7: "\n" * 700 + "<M", -8: "q" * 255 + "\n" + "<S>" + "w" * 300}


@pytest.mark.parametrize("chunk, fan", [(1 << 16, 256), (16, 4), (300, 3)])
def test_against_brute_force(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(fim, "FAN", fan)
    docs = corpus(chunk)
    df = spark.createDataFrame([(d, t, 1, "own") for d, t in docs.items()], "doc_id long, text string, n int, form string").repartition(5)
    out = {r.doc_id: tuple(r)[1:] for r in fim.digest(df, chunk=chunk).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert out == {d: (n, form, p, m, sha(o), sha(t)) for d, text in docs.items() for n, form, p, m, o, t in [brute(d, text)]}
    assert {v[1] for v in out.values()} == {"plain", "psm", "spm"}


def test_rates_repeats_columns_and_empty(spark):
    rows = [(i % 40, f"a{i % 40}\nb\nc", "t") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string")
    got = fim.transform(df, columns=("output",), seed=3, rate=60, spm=20, chunk=4)
    assert got.columns == ["doc_id", "n", "form", "output", "output"]
    assert sorted((r[0], r[1], r[2], r[3], r[4]) for r in got.collect()) == sorted((d, *(b := brute(d, t, 3, 60, 20))[:2], b[4], "t") for d, t, _ in rows)
    assert fim.digest(df.limit(0)).count() == 0


def test_composition_is_associative_and_independent_of_stripes(monkeypatch):
    rnd = random.Random(4)
    automaton = fim.lines()
    data = np.frombuffer("".join(rnd.choice("\n<PSM>ab") for _ in range(5000)).encode(), np.uint8)
    cuts = np.array([0, *sorted(rnd.sample(range(5000), 20)), 5000])
    whole = [x[0] for x in automata.scan(automaton, data, np.array([0, 5000])).whole()]
    for stripe in (1, 7, 256):
        monkeypatch.setattr(automata, "STRIPE", stripe)
        state, count = automata.scan(automaton, data, cuts).whole()
        s, c = np.arange(len(automaton.move)), np.zeros(len(automaton.move), np.int64)
        for i in range(len(state)):
            c, s = c + count[i][s], state[i][s]
        assert (s == whole[0]).all() and (c == whole[1]).all()


def test_automaton_finds_marks_as_search_does():
    automaton = fim.lines()
    rnd = random.Random(5)
    for _ in range(300):
        text = "".join(rnd.choice("<PSM>\n") for _ in range(rnd.randrange(0, 9))).encode()
        state = 0
        for b in text:
            state = automaton.move[state, automaton.classes[b]]
        assert automaton.found[state] == any(m in text for m in (b"<P>", b"<S>", b"<M>"))
        assert automaton.inside[state] == (bool(text) and not text.endswith(b"\n"))


def test_sql(spark):
    from tollgate.llm import queries

    sf = f"{oracle.DATA}/sf0.001"
    assert oracle.compare(spark, oracle.connect(sf), "op12_automaton_fim", queries.QUERIES["op12_automaton_fim"], fim.ORACLE, sf) == ""
