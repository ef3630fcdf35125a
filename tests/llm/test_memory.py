"""What a worker holds while it goes through a full batch of texts."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from tollgate.llm import counting, jaccard, lines, packing, toxicity
from tollgate.llm.tables import BATCH
from tollgate.llm.words import blocks


def batch(size=BATCH // 2):
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(2, 9))) for _ in range(20_000)]
    texts = ["\n".join(" ".join(rnd.choices(vocabulary, k=20)) for _ in range(40)) for _ in range(200)]
    texts = (texts * (size // sum(map(len, texts)) + 1))[: size * len(texts) // sum(map(len, texts))]
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})


def peak(f) -> float:
    """MB that f takes at its most, beside what was there."""
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_neighbourhoods_of_a_batch_in_80_mb():
    def run():
        for block in blocks(batch_, size=counting.ASKS):
            _, keys, (_, line, at, which) = lines.around(block, np.zeros(0, np.int64), lines.NEAR)
            assert len(line) == len(at) == len(which) >= len(keys) > 0
            counting.distinct(keys)

    batch_ = batch()
    assert peak(run) < 80


def test_pieces_of_a_batch_in_100_mb(monkeypatch):
    monkeypatch.setattr(packing, "arrow_map", lambda df, f, schema: f)

    class Docs:
        def select(self, *columns):
            return self

    cut, batch_ = packing.pieces(Docs(), public_tokenizers.path("byte_bpe_50k.json")), batch()
    small = batch_.slice(0, 1)
    list(cut(small))  # the vocabulary is read
    assert peak(lambda: [x.num_rows for x in cut(batch_)]) < 100


def test_weights_of_a_learner_by_steps():
    learner = toxicity.Learner(1.0, 1.0, 2.0, 1.0)
    rnd = np.random.default_rng(1)
    at = rnd.integers(0, 1 << toxicity.BITS, 5000)
    learner.z[at], learner.s[at] = rnd.normal(0, 5, 5000), rnd.random(5000)
    learner.z[-1], learner.s[-1] = -3.0, 0.5
    w = learner.weights(np.arange((1 << toxicity.BITS) + 1))
    some = np.flatnonzero(w[:-1])
    found = []
    assert peak(lambda: found.append(learner.model())) < 40
    model = found[0]
    assert (model.slots == some).all() and (model.weights == w[some].astype(np.float32)).all() and model.bias == float(w[-1]) and len(some) > 1000


def test_shingles_of_a_batch_in_80_mb():
    batch_ = batch()
    assert peak(lambda: [counting.distinct(jaccard.shingles(block.column("text"), 5)[0]) for block in blocks(batch_, size=counting.ASKS)]) < 80
