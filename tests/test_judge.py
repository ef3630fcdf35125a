"""The one-pass judgement held against a plain row-by-row reading of the same contract."""

import random

import pytest
from pyspark.sql import functions as F

from tollgate import contract as contracts
from tollgate.operators import judge, profile, rejudge, split
from tollgate.refusals import CannotRelax, ContractError, NoQuarantine, NothingChecked, ReasonColumnClash

BASE = {
    "dataset": "small",
    "source": {"kind": "csv", "partition_column": "k", "partition_grain": "day"},
    "freshness": {"max_lag_hours": 48, "reference": "extract", "applies_to": "tail", "provenance": "asserted"},
    "volume": {"min_rows_per_partition": 2, "provenance": "asserted"},
    "columns": [
        {"name": "k", "type": "string", "required": True, "unique": True, "provenance": "documented"},
        {"name": "n", "type": "integer", "min": 0, "max": 10, "provenance": "asserted"},
        {"name": "state", "type": "string", "allowed": ["open", "shut"], "max_length": 5, "provenance": "documented"},
        {"name": "memo", "type": "string", "required": False, "provenance": "asserted"},
    ],
    "checks": [{"name": "shut_has_n", "kind": "requires_when", "when_column": "state", "when_equals": "shut", "then_required": "n", "provenance": "asserted"}],
}
NULLS = (None, "", "NA", "N/A", "null", "NULL", "None")


def null(v):
    return v is None or v.strip() in NULLS


def whole(v):
    try:
        return int(v)
    except ValueError:
        return None


def plainly(rows):
    """Row index: failures, by the rules of BASE read one after another."""
    times = {}
    for p, k, *_ in rows:
        if not null(k):
            times[p, k] = times.get((p, k), 0) + 1
    out = []
    for p, k, n, state, _ in rows:
        f = []
        if null(k):
            f.append("k:required")
        elif times[p, k] > 1:
            f.append("k:unique")
        if not null(n):
            if whole(n) is None:
                f.append("n:type")
            try:
                x = float(n)
            except ValueError:
                x = None
            if x is not None and not x >= 0:
                f.append("n:min")
            if x is not None and not x <= 10:
                f.append("n:max")
        if not null(state):
            if state.strip() not in ("open", "shut"):
                f.append("state:allowed")
            if len(state.strip()) > 5:
                f.append("state:max_length")
            if state.strip() == "shut" and null(n):
                f.append("check:shut_has_n")
        out.append(f)
    return out


def sample(seed, size=300):
    rnd = random.Random(seed)
    return [(rnd.choice("ab"), rnd.choice([*NULLS, *map(str, range(120))]), rnd.choice([*NULLS, "0", "10", "11", "-1", "3.5", "nan", "x", " 7 ", "1_0"]), rnd.choice([*NULLS, "open", "shut", " shut", "ajar", "wide open"]), None) for _ in range(size)]


@pytest.fixture(scope="module")
def contract():
    return contracts.parse(BASE)


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, _partition string, k string, n string, state string, memo string").repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_a_plain_reading(spark, contract, seed):
    rows = sample(seed)
    got = judge.judged(frame(spark, rows), contract).select("i", split.reason().alias("r")).collect()
    want = plainly(rows)
    assert {r.i: r.r for r in got} == {i: " and ".join(f) for i, f in enumerate(want)}


def test_counts_split_and_profile_agree(spark, contract):
    rows, want = sample(4), plainly(sample(4))
    judged = judge.judged(frame(spark, rows), contract)
    flat = [x for f in want for x in f]
    assert {f"{r.subject}:{r.rule}": r.failed for r in judge.rule_counts(judged).collect()} == {x: flat.count(x) for x in set(flat)}
    assert split.accepted(judged).count() == sum(not f for f in want)
    assert {r[split.REASONS] for r in split.held(judged).collect()} == {" and ".join(f) for f in want if f}
    by_column = {(r.subject, r.rule): r.failed for r in profile.columns(judged, contract).collect()}
    assert all(by_column[tuple(x.split(":"))] == flat.count(x) for x in set(flat)) and by_column["memo", "type"] == 0
    total = judge.summary(judged, contract).agg(F.sum("held").alias("held"), F.sum("multi_rule").alias("many")).first()
    assert (total.held, total.many) == (sum(bool(f) for f in want), sum(len(f) > 1 for f in want))


def test_marginal_is_what_dropping_each_rule_frees(spark, contract):
    rows = frame(spark, sample(5))
    judged = judge.judged(rows, contract)
    held = judged.where(F.size(judge.FAILURES) > 0).count()
    for r in rejudge.marginal(judged, contract).collect():
        if not r.removable:
            assert r.recovered is None
            continue
        again = judge.judged(rows, rejudge.relaxed(contract, r.subject, r.rule))
        assert held - again.where(F.size(judge.FAILURES) > 0).count() == r.recovered, (r.subject, r.rule)


def test_a_contract_of_more_rules_than_a_word_has_bits(spark):
    wide = contracts.parse(BASE | {"columns": [BASE["columns"][0], *[{"name": f"c'{i}", "type": "integer", "min": i, "provenance": "asserted"} for i in range(70)]], "checks": []})
    rows = spark.createDataFrame([("p", "1", *["35"] * 70), ("p", "2", *["x"] * 70), ("p", "2", *["99"] * 70)], ", ".join(["_partition string", "k string", *[f"`c'{i}` string" for i in range(70)]]))
    judged = judge.judged(rows, wide)
    assert sum(c.startswith(judge.BITS) for c in judged.columns) == 3
    found = {r.k + str(len(r._failures)): [f.rule for f in r._failures] for r in judged.collect()}
    assert found["134"] == ["min"] * 34 and found["271"] == ["unique"] + ["type"] * 70 and found["21"] == ["unique"]
    assert judge.rule_counts(judged).agg(F.sum("failed")).first()[0] == 34 + 71 + 1
    assert {(r.subject, r.rule): r.recovered for r in rejudge.marginal(judged, wide).collect() if r.recovered} == {("k", "unique"): 1}
    assert judge.summary(judged, wide).first().held_only_by_unique == 1


def test_rows_without_a_key_are_dealt_out(spark, contract):
    rows = spark.createDataFrame([("p", None, str(i), "open", None) for i in range(400)], "_partition string, k string, n string, state string, memo string")
    before = judge._with_times(rows, "k")
    text = before._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in text.split("Join")[1].split("\n")[0]  # the last key of the join, so that nulls have many keys
    assert before.count() == 400 and before.where("__times_k is not null").count() == 0


def test_uniqueness_is_within_a_partition(spark, contract):
    rows = [("a", "1", "1", "open", None), ("b", "1", "1", "open", None), ("b", "2", "1", "open", None), ("b", "2", "1", "open", None)]
    judged = judge.judged(frame(spark, rows), contract)
    assert sorted(r.i for r in judged.where(F.size(judge.FAILURES) > 0).collect()) == [2, 3]
    assert judge.largest_collision(frame(spark, rows), contract).first().largest == 2


def test_what_was_not_evaluated_refuses(spark, contract):
    with pytest.raises(NothingChecked):
        judge.judged(spark.createDataFrame([("a", "x")], "_partition string, other string"), contract)
    idle = judge.judged(spark.createDataFrame([("a", None)], "_partition string, memo string"), contract)
    with pytest.raises(NothingChecked):
        judge.refuse_if_idle(idle)
    judge.refuse_if_idle(judge.judged(frame(spark, sample(6, 5)), contract))


def test_drift_and_clashes(spark, contract):
    rows = spark.createDataFrame([("a", "1", "z")], "_partition string, k string, extra string")
    assert judge.drift(rows, contract) == (["n", "state", "memo"], ["extra"])
    clash = judge.judged(rows.withColumn(split.REASONS, F.lit("x")), contract)
    with pytest.raises(ReasonColumnClash):
        split.held(clash)
    judged = judge.judged(rows, contract)
    nothing_held = rejudge.rejudge_summary(rejudge.rejudge(split.accepted(judged), split.held(judged), contract)).first()
    assert tuple(nothing_held) == (0, 0, 0, 0)
    with pytest.raises(NoQuarantine):
        rejudge.rejudge(split.accepted(judged).limit(0), split.held(judged), contract)


def test_empty_table(spark, contract):
    judged = judge.judged(frame(spark, sample(1)).limit(0), contract)
    assert judged.count() == 0 and judge.rule_counts(judged).count() == 0
    judge.refuse_if_idle(judged)


@pytest.mark.parametrize(
    "change",
    [
        {"dataset": None, "columns": []},
        {"columns": [BASE["columns"][0], BASE["columns"][0]]},
        {"columns": [{"name": "k", "type": "decimal", "required": True, "provenance": "asserted"}]},
        {"columns": [{"name": "k", "type": "string", "requierd": True, "provenance": "asserted"}]},
        {"columns": [{"name": "k", "type": "string", "provenance": "asserted"}]},
        {"columns": [{"name": "k", "type": "string", "required": True}]},
        {"columns": [BASE["columns"][0], {"name": "n", "type": "integer", "min": 3, "max": 2, "provenance": "asserted"}], "checks": []},
        {"checks": [{**BASE["checks"][0], "then_required": "nobody"}]},
        {"checks": [{**BASE["checks"][0], "when_in": ["open"]}]},
        {"checks": [{**BASE["checks"][0], "kind": "forbids"}]},
        {"freshness": {**BASE["freshness"], "reference": "moon"}},
        {"freshness": {**BASE["freshness"], "applies_to": "some"}},
        {"source": {"kind": "csv", "partition_column": "k"}},
        {"source": {**BASE["source"], "partition_column": "z"}},
    ],
)
def test_contracts_that_refuse(change):
    with pytest.raises(ContractError):
        contracts.parse(BASE | change)


def test_contracts_that_load():
    assert contracts.parse(BASE).constraint_count == 7
    assert contracts.parse({k: v for k, v in BASE.items() if k != "checks"}).checks == []
    assert contracts.parse(BASE | {"columns": [BASE["columns"][0], {"name": "n", "type": "integer", "min": 2, "max": 2, "provenance": "asserted"}], "checks": []}).column("n").rules == {"min": 2, "max": 2}
    for args in (("k", "allowed"), ("memo", "required"), ("nobody", "type")):
        with pytest.raises(CannotRelax):
            contracts.relax_column(contracts.parse(BASE), *args)
    for name in ("k", "n", "nobody"):  # the partition column, one that a check refers to, one that isn't there
        with pytest.raises(CannotRelax):
            contracts.drop_column(contracts.parse(BASE), name)
    assert "memo" not in contracts.drop_column(contracts.parse(BASE), "memo").names
    with pytest.raises(CannotRelax):
        contracts.relax_check(contracts.parse(BASE), "nobody")


def test_counts_of_the_shipped_contract():
    from tollgate.queries import shipped_contract

    c = shipped_contract()
    assert (len(c.columns), c.constraint_count, c.asserted_count, len(c.checks)) == (11, 20, 13, 3)
