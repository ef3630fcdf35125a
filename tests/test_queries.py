import pytest

from tests import oracle
from tollgate import queries
from tollgate.operators import rejudge

SF = f"{oracle.DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_agrees(spark, con, name):
    assert oracle.compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_without_sql(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_breaks_are_caught_and_named(spark):
    found = {r.name: r for r in queries.QUERIES["breaks"](spark, SF).collect()}
    assert set(found) == {b.name for b in rejudge.CATALOGUE}
    for b in rejudge.CATALOGUE:
        r = found[b.name]
        if b.subject is None:
            assert r.new_holds == r.caught == 0
        else:
            assert r.damaged == r.caught == r.named == r.new_holds and r.collateral == r.control_holds == 0
            assert r.amplification == (1.125 if b.copied else 1.0)


def test_rejudging_reads_the_judgement_and_not_the_tables_again(spark):
    for name in ("rejudge_relaxed", "rejudge_stopped", "rejudge_reworded"):
        read = queries.QUERIES[name](spark, SF).inputFiles()
        assert read and not [f for f in read if "lineitem" in f or "orders" in f]
