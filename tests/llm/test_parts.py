"""Answers by partition: other cores between two passes change nothing, and other partitions are refused."""

import random

import numpy as np
import pytest

from tollgate.llm import counting, jaccard, lines, parts, substrings
from tollgate.llm.tables import CUT, steady

OPERATORS = {"lines": lines.digest, "jaccard": jaccard.join, "substrings": substrings.digest}


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Twelve files of texts that share lines, passages and whole texts."""
    rnd = random.Random(7)
    line = lambda n: " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(30)) for _ in range(n))
    common = [line(rnd.randrange(3, 40)) for _ in range(12)]
    texts = ["\n".join(rnd.choice(common) if rnd.random() < 0.4 else line(rnd.randrange(1, 30)) for _ in range(rnd.randrange(1, 6))) for _ in range(90)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:20])] + [(3, texts[3]), (None, texts[5])]
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(12).write.parquet(path)
    return path


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_other_cores_between_passes(spark, table, monkeypatch, name):
    operator, cores = OPERATORS[name], "spark.sql.leafNodeDefaultParallelism"
    want = rows_of(operator(spark.read.parquet(table)))
    write, turn = parts.write, []

    def changed(key, values):
        def then(*args, **kwargs):
            turn.append(1)
            out = write(*args, **kwargs)
            spark.conf.set(key, values[len(turn) % len(values)])
            return out

        return then

    try:
        for first in ("12", "2"):
            spark.conf.unset(CUT)
            spark.conf.set(cores, first)
            monkeypatch.setattr(parts, "write", changed(cores, ["1", "12", "3", "5"]))
            assert rows_of(operator(spark.read.parquet(table))) == want and len(turn) > 1
        spark.conf.unset(cores)
        for values in (["12", "1"], ["3", "12", "5"]):  # against what is fixed: refused, never wrong
            spark.conf.set(CUT, values[0])
            monkeypatch.setattr(parts, "write", changed(CUT, values))
            with pytest.raises(Exception, match="isn't what it was"):
                operator(spark.read.parquet(table)).collect()
    finally:
        spark.conf.unset(cores)
        spark.conf.unset(CUT)


@pytest.mark.parametrize("name", OPERATORS)
def test_shuffled_and_joined_frames(spark, table, name):
    docs = spark.read.parquet(table)
    want = rows_of(OPERATORS[name](docs))
    assert rows_of(OPERATORS[name](docs.repartition(5))) == want
    assert rows_of(OPERATORS[name](docs.join(docs.select("doc_id").distinct(), "doc_id", "left").select("doc_id", "text"))) == want


def test_what_is_steady(spark, table):
    docs = spark.read.parquet(table)
    same = docs.where("doc_id > 3 or doc_id is null").selectExpr("doc_id", "upper(text) as text")
    assert steady(docs) is docs and steady(same) is same and int(spark.conf.get(CUT)) > 0
    for other in (docs.repartition(3), docs.orderBy("doc_id"), docs.union(docs), docs.sample(0.5), docs.selectExpr("doc_id", "rand() as text"), docs.limit(5)):
        assert steady(other) is not other


def test_a_witness_knows_rows_and_their_order(spark, table):
    docs = spark.read.parquet(table).coalesce(1)
    path = parts.witnessed(docs)
    same = lambda df: df.mapInArrow(parts.guarded(lambda b: iter([b]), path), df.schema).count()
    assert same(docs) == docs.count()
    for other in (docs.orderBy("doc_id").coalesce(1), docs.where("doc_id <> 7").coalesce(1), docs.where("doc_id < -9").coalesce(1)):
        with pytest.raises(Exception, match="isn't what it was"):
            same(other)


@pytest.mark.parametrize("buckets", [1, 43, 85_000, 1 << 22])
def test_pieces_cost_what_the_keys_cost(buckets):
    keys = np.unique(np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 64, 5000, np.uint64))
    own, at = counting.pieces(keys, buckets)
    assert len(own) <= min(buckets, len(keys)) and own == sorted(set(own)) and at[0] == 0 and at[-1] == len(keys)
    assert all((int(k) >> 32) * buckets >> 32 == b for b, i, j in zip(own, at, at[1:]) for k in keys[i:j])
    assert counting.pieces(np.zeros(0, np.uint64), buckets) == ([], [0])
