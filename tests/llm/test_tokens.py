import hashlib
import random
import zlib

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tollgate.llm import bpe, byte_ids, packing

BYTE, WORD = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = ["a", "B", " ", "  ", "\n", "\n\n", "\t", " \n", "é", "’s", "'s", "'ll", "123", "%%%", "<|endoftext|>", "<|startoftext|>", "\xa0", "　", "😀", "foo", "bar ", "\r\n", "\x1f", "ΑΣ", "é", "İ", "supercalifragilistic" * 9]


def texts(n=1500):
    rnd = random.Random(5)
    found = ["".join(rnd.choice(PARTS if rnd.random() < 0.5 else PARTS[:11]) for _ in range(rnd.randrange(40))) for _ in range(n)]
    return [*found, "", None, " ", "\n", "x" * 70_000, "".join(rnd.choice("abcdefgh") for _ in range(20_000))]


def test_byte_ids_are_the_library_s():
    found = texts()
    ids, at = byte_ids.ids_of(pa.array(found), BYTE, 2)
    t = Tokenizer.from_file(BYTE)
    for i, x in enumerate(found):
        assert ids[at[i] : at[i + 1]].tolist() == [*t.encode(x or "", add_special_tokens=False).ids, 2], x[:99]


def test_segment_tree_is_the_library_s():
    found = texts()
    ids, tokens, n = bpe.encode_texts(pa.array(found), WORD)
    t = Tokenizer.from_file(WORD)
    for x, i, d, k in zip(found, ids, tokens, n, strict=True):
        want = t.encode(x or "", add_special_tokens=False).ids
        assert [int(y) for y in i.split()] == want and k == len(want)
        assert d.decode() == t.decode(want, skip_special_tokens=False)


def test_one_by_one_and_together_agree():
    m = bpe.merges(WORD)
    rnd = random.Random(1)
    found = [bytes(rnd.choice(b"thanedig") for _ in range(rnd.randrange(1, 30))) for _ in range(400)]
    together = m.encode_words(found)
    assert together == [m.encode_words([x])[0] for x in found]


def test_round_trip_frame(spark):
    docs = spark.createDataFrame([(1, "Hello there", "x"), (2, "", "x"), (2, "", "x"), (3, None, "x")], "doc_id long, text string, n_tokens string")
    out = sorted(bpe.round_trip(docs, WORD).collect())
    assert [r.n_tokens for r in out] == [2, 0, 0, 0]
    t = Tokenizer.from_file(WORD)
    assert out[0].ids_sha256 == hashlib.sha256(" ".join(map(str, t.encode("Hello there", add_special_tokens=False).ids)).encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), WORD).count() == 0
    assert sorted(bpe.encode(docs, WORD).collect())[0].ids == t.encode("Hello there", add_special_tokens=False).ids


def test_packing(spark):
    rnd = random.Random(2)
    found = [(i, " ".join(rnd.choice(["of", "than", "zqx"]) for _ in range(int(rnd.paretovariate(0.7)) % 5000))) for i in range(600)]
    found += [(900, None), (901, ""), (901, ""), (902, "a " * 1023)]
    docs = spark.createDataFrame(found, "doc_id long, text string").repartition(5)
    out = packing.pack(docs, BYTE).collect()
    t = Tokenizer.from_file(BYTE)
    ids = {}
    for d, x in found:
        ids[d] = [*t.encode(x or "", add_special_tokens=False).ids, 2]
    pieces, sequences = {}, {}
    for r in out:
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[r.doc_id][r.start : r.start + r.length])) == r.ids_crc32
        assert 1 <= r.length <= 1024 and (r.piece == 0 or r.length == 1024)
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(pieces[901]) == 2
    for d, p in pieces.items():
        if d != 901:
            assert [x[0] for x in sorted(p)] == list(range(len(p))) and sum(x[2] for x in p) == len(ids[d])
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in out) // 1024) + 1
    assert packing.pack(docs.limit(0), BYTE).count() == 0


def test_plan_uses_up_any_histogram():
    import numpy as np

    rnd = np.random.default_rng(3)
    for scale in (1, 40, 5000):
        histogram = np.zeros(65, int)
        histogram[1:] = rnd.integers(0, scale + 1, 64)
        used = np.zeros(65, int)
        for pattern, times in packing.plan(histogram, 64):
            assert sum(pattern) <= 64 and times > 0
            for k in pattern:
                used[k] += times
        assert (used == histogram).all()


def sequences(histogram, limit):
    return sum(times for _, times in packing.plan(histogram, limit))


def test_patterns_are_all_that_fill():
    import numpy as np

    have = np.zeros(31, bool)
    have[[1, 2, 5, 7, 11, 12, 18, 23, 28, 30]] = True
    some = np.flatnonzero(have).tolist()
    want = {(30,)} | {tuple(sorted((a, b), reverse=True)) for a in some for b in some if a + b == 30} | {tuple(sorted((a, b, c), reverse=True)) for a in some for b in some for c in some if a + b + c == 30}
    found = packing.patterns(30, have)
    assert want <= set(found) and all(sum(p) <= 30 and set(p) <= set(some) for p in found)
    assert len(packing.patterns(30, have, most=10)) < len(found)


def test_packs_near_the_bound():
    import numpy as np

    rnd = np.random.default_rng(5)
    for histogram in (rnd.integers(0, 900, 1025), np.where(np.arange(1025) < 300, rnd.integers(0, 900, 1025), 0)):
        histogram[0] = 0
        # no sequence holds two pieces of more than half its length
        bound = max(-(-int((histogram * np.arange(1025)).sum()) // 1024), int(histogram[513:].sum()))
        assert sequences(histogram, 1024) <= 1.005 * bound + 1
