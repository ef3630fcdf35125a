"""Data tests: each is a table of violations, and passes if it is empty."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.contract import Contract


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def unique(rows: DataFrame, column: str) -> DataFrame:
    """value, times: over the whole table, nulls aside."""
    counted = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("times"))
    return counted.where("times > 1")


def accepted_values(rows: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """value, times of values that aren't allowed, nulls aside."""
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("times"))


def lossless_cast(raw: DataFrame, staged: DataFrame, columns: dict[str, str], key: str = "unique_key") -> DataFrame:
    """key, column, lost: how many texts of a key the typed table lost; columns: raw name to staged name.

    Both sides are counted by key before they meet, so a key that very many rows have isn't paired with itself.
    """
    count = lambda df, names: df.groupBy(F.col(key).alias("_key")).agg(*[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(names)])
    texts, typed = count(raw, columns), count(staged, columns.values())
    both = texts.alias("a").join(typed.alias("b"), F.col("a._key").eqNullSafe(F.col("b._key")))
    lost = F.array(*[F.struct(F.lit(c).alias("column"), (F.col(f"a._{i}") - F.col(f"b._{i}")).alias("lost")) for i, c in enumerate(columns)])
    return both.select(F.col("a._key").alias(key), F.explode(F.filter(lost, lambda x: x["lost"] > 0)).alias("c")).select(key, "c.column", "c.lost")


def totals_agree(silver: DataFrame, daily: DataFrame, by_complaint: DataFrame) -> DataFrame:
    """mart, expected, found for marts whose requests don't add up to silver's rows."""
    want = silver.agg(F.count("*").alias("expected"))
    out = None
    for name, mart in (("agency_daily", daily), ("complaint_resolution", by_complaint)):
        one = want.crossJoin(mart.agg(F.sum("request_count").alias("found"))).where(~F.col("expected").eqNullSafe(F.col("found"))).select(F.lit(name).alias("mart"), "expected", "found")
        out = one if out is None else out.union(one)
    return out


@dataclass(frozen=True)
class Test:
    """kind: not_null, unique or accepted_values."""

    column: str
    kind: str
    values: tuple[str, ...] = ()

    def run(self, rows: DataFrame) -> DataFrame:
        return {"not_null": not_null, "unique": unique}[self.kind](rows, self.column) if self.kind != "accepted_values" else accepted_values(rows, self.column, list(self.values))


def run_all(relation: str, rows: DataFrame, tests: list[Test]) -> DataFrame:
    """relation, column, kind, violations: all tests of a relation in one pass over its rows.

    A row gives an entry for every test that it may violate; entries are counted by test and
    value, in each task first.  Violations are rows for not_null, repeated values for unique,
    and different values for accepted_values.
    """
    entries = []
    for i, t in enumerate(tests):
        value, c = F.col(f"`{t.column}`").cast("string"), F.col(f"`{t.column}`")
        wrong = {"not_null": c.isNull(), "unique": c.isNotNull(), "accepted_values": c.isNotNull() & ~c.isin(*t.values)}[t.kind]
        entries.append(F.when(wrong, F.struct(F.lit(i).alias("test"), value.alias("value"))))
    each = rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    counted = each.groupBy("test", "value").agg(F.count("*").alias("n"))
    found = counted.groupBy("test").agg(F.sum("n").alias("not_null"), F.count_if(F.col("n") > 1).alias("unique"), F.count("*").alias("accepted_values"))
    listed = rows.sparkSession.createDataFrame([(i, relation, t.column, t.kind) for i, t in enumerate(tests)], "test int, relation string, `column` string, kind string")
    count = F.when(F.col("kind") == "not_null", F.col("not_null")).when(F.col("kind") == "unique", F.col("unique")).otherwise(F.col("accepted_values"))
    return listed.join(found, "test", "left").select("relation", "column", "kind", F.coalesce(count, F.lit(0)).cast("long").alias("violations"))


def from_contract(contract: Contract) -> list[Test]:
    """The tests that a contract's rules have an equivalent for."""
    out = []
    for c in contract.columns:
        if c.rules.get("required"):
            out.append(Test(c.name, "not_null"))
        if c.rules.get("unique"):
            out.append(Test(c.name, "unique"))
        if "allowed" in c.rules:
            out.append(Test(c.name, "accepted_values", tuple(c.rules["allowed"])))
    return out


def coverage(contract: Contract) -> dict[str, int]:
    """How many constraints, checks among them, have a generated test, have none, and ask for nothing."""
    generated = len(from_contract(contract))
    nothing = sum(v is False for c in contract.columns for v in c.rules.values())
    total = contract.constraint_count + len(contract.checks)
    return {"generated": generated, "nothing": nothing, "no_equivalent": total - generated - nothing, "total": total}


def documents(contract: Contract, relation: str) -> dict:
    """The tests as a document that a schema file of a modelling tool would hold."""
    columns: dict[str, list] = {}
    for t in from_contract(contract):
        columns.setdefault(t.column, []).append({"accepted_values": {"values": list(t.values)}} if t.values else t.kind)
    return {"version": 2, "models": [{"name": relation, "columns": [{"name": c, "data_tests": tests} for c, tests in columns.items()]}]}


def rendered(contract: Contract, relation: str) -> str:
    """The document's text, ready to be stored beside the models."""
    import yaml

    return yaml.safe_dump(documents(contract, relation), sort_keys=False, allow_unicode=True)


def drifted(contract: Contract, relation: str, stored: str) -> list[str]:
    """The lines in which a stored document isn't what the contract generates now; none if it is up to date."""
    import difflib

    return list(difflib.unified_diff(stored.splitlines(), rendered(contract, relation).splitlines(), "stored", "generated", lineterm=""))


def run_on_held(held: DataFrame, contract: Contract, key: str) -> DataFrame:
    """column, kind, violations, control: the generated tests on held rows, in one pass, and on two poisoned rows that must make each fire."""
    spark, tests = held.sparkSession, from_contract(contract)
    names = [c for c in held.columns if c in contract.names]
    control = None
    for t in tests:  # two rows of the driver's own each
        bad = {"not_null": None, "unique": "twice", "accepted_values": "never allowed"}[t.kind]
        poison = spark.createDataFrame([tuple(bad if n == t.column else "x" for n in names)] * 2, ", ".join(f"`{n}` string" for n in names))
        one = t.run(poison).agg(F.lit(t.column).alias("column"), F.lit(t.kind).alias("kind"), (F.count("*") > 0).alias("control"))
        control = one if control is None else control.union(one)
    found = run_all("held", held.select(*[f"`{n}`" for n in names]), tests)
    return found.join(control, ["column", "kind"]).select("column", "kind", "violations", "control")
