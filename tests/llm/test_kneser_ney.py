import math
import random
import re
import zlib
from collections import Counter, defaultdict

from tollgate.llm import kneser_ney


def brute(docs):
    """The same model by dictionaries: doc_id -> (held_out, n_tokens, n_known, train_tokens, base, score)."""
    seq = {d: [*("".join(c.lower() if c.isascii() else c for c in x) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")), "</s>"] for d, t in docs.items()}
    out_ = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    uni, bi = Counter(), Counter()
    for d, s in seq.items():
        if not out_[d]:
            uni.update(s)
            bi.update(zip(["<s>", *s], s))

    def discount(values):
        n = [sum(v == i for v in values) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
        d = [min(max(x, 0.1), i - 0.05) for i, x in zip((1, 2, 3), d)]
        return lambda c: d[min(c, 3) - 1] if c else 0.0

    off2 = discount(bi.values())
    cont, total, gamma = Counter(), Counter(), defaultdict(float)
    for (a, b), c in bi.items():
        cont[b] += 1
        total[a] += c
        gamma[a] += off2(c)
    off1 = discount(cont.values())
    floor = sum(off1(c) for c in cont.values()) / len(bi) / (len(uni) + 1)
    n = sum(uni.values())

    def p(a, b):
        low = max(cont[b] - off1(cont[b]), 0) / len(bi) + floor
        if not total[a]:
            return low
        return max(bi[a, b] - off2(bi[a, b]), 0) / total[a] + gamma[a] / total[a] * low

    for a in ["<s>", *list(uni)[:5], "unseen"]:
        assert abs(sum(p(a, b) for b in uni) + p(a, "unseen too") - 1) < 1e-9
    return {d: (out_[d], len(s), sum(uni[x] > 0 for x in s), n, sum(math.log10((uni[x] + 1) / (n + len(uni) + 1)) for x in s), sum(math.log10(p(a, b)) for a, b in zip(["<s>", *s], s))) for d, s in seq.items()}


def test_against_brute_force(spark):
    rnd = random.Random(2)
    vocabulary = ["The", "of", "and"] * 20 + ["".join(rnd.choice("abcde") for _ in range(3)) for _ in range(150)]
    docs = {i: rnd.choice([" ", "\n"]).join(rnd.choice(vocabulary) for _ in range(rnd.randrange(40))) for i in range(300)}
    docs |= {901: "", 902: None, 903: "Éa ÉA éa " * 3, 904: "zz " * 9000}
    df = spark.createDataFrame([(k, v, 1) for k, v in docs.items()], "doc_id long, text string, count int").repartition(5)
    out = {r.doc_id: r for r in kneser_ney.score_held_out(df).collect()}
    want = brute(docs)
    assert set(out) == set(want)
    for d, (held, n, known, total, base, score) in want.items():
        r = out[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9), d


def test_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert kneser_ney.score_held_out(df.limit(0)).count() == 0
    assert kneser_ney.score_held_out(df).count() == 3
    assert [r.score for r in kneser_ney.score(df, None).collect()] == [0.0] * 3
