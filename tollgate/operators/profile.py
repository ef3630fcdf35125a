"""A column's view of the same rules: how many values break each, with the first examples in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.contract import Contract
from tollgate.operators import judge

EXAMPLES = 3


def columns(judged: DataFrame, contract: Contract) -> DataFrame:
    """subject, rule, provenance, failed: a row for each rule of the contract that was run, zeros too."""
    present = set(judged.columns)
    rules = [(r.subject, r.label, contract.column(r.subject).provenance) for r in judge.value_rules(contract, present)]
    rules += [("check", c.name, c.provenance) for c in judge.checks_of(contract, present)]
    whose = F.create_map(*[F.lit(x) for subject, rule, provenance in rules for x in (f"{subject}:{rule}", provenance)])
    counted = judged.agg(judge.counts(judged).alias("c")).select(F.explode("c").alias("c"))  # one row, with a sum for every rule
    return counted.select("c.subject", "c.rule", F.element_at(whose, F.concat("c.subject", F.lit(":"), "c.rule")).alias("provenance"), "c.failed")


def examples(judged: DataFrame, ordinal: str, n: int = EXAMPLES) -> DataFrame:
    """subject, rule, place (from 1), value: the first failing values of each column's rules by ``ordinal``.

    A running minimum of n: each task keeps n rows a rule before anything is shuffled.
    """
    one = _failing(judged, ordinal)
    return _placed(one, n)


def _failing(judged: DataFrame, ordinal: str) -> DataFrame:
    """subject, rule, e (at, value) of every failure of a column's rule."""
    data = [c for c in judged.columns if not c.startswith("_") and c != ordinal]
    values = F.create_map(*[x for c in data for x in (F.lit(c), F.col(f"`{c}`").cast("string"))])
    one = judged.select(ordinal, values.alias("values"), F.explode(judge.FAILURES).alias("f")).where("f.subject <> 'check'")
    return one.select("f.subject", "f.rule", F.struct(F.col(ordinal).alias("at"), F.element_at("values", F.col("f.subject")).alias("value")).alias("e"))


def _placed(one: DataFrame, n: int) -> DataFrame:
    local = one.withColumn("part", F.spark_partition_id())
    rank = lambda keys: F.row_number().over(Window.partitionBy(*keys).orderBy("e"))
    first = local.withColumn("k", rank(["part", "subject", "rule"])).where(F.col("k") <= n)
    return first.withColumn("place", rank(["subject", "rule"])).where(F.col("place") <= n).select("subject", "rule", "place", F.col("e.value").alias("value"))


def _first_values(judged: DataFrame, ordinal: str, n: int) -> DataFrame:
    """The first different values: each is taken where it stands first."""
    one = _failing(judged, ordinal).groupBy("subject", "rule", F.col("e.value").alias("value")).agg(F.min("e").alias("e"))
    return _placed(one.select("subject", "rule", "e"), n)


def corpus(judged: DataFrame, contract: Contract, ordinal: str) -> DataFrame:
    """subject, rule, provenance, failed, rate (of all rows), examples: over all partitions, what fired on columns; up to three different examples, in order."""
    fired = columns(judged, contract).where("failed > 0 and subject <> 'check'").select("subject", "rule", "provenance", "failed", F.lit(None).cast("array<string>").alias("examples"))
    few = _first_values(judged, ordinal, EXAMPLES).groupBy("subject", "rule").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("examples"))
    both = fired.unionByName(few.withColumns({"provenance": F.lit(None).cast("string"), "failed": F.lit(None).cast("long")}))
    one = both.groupBy("subject", "rule").agg(F.max("provenance").alias("provenance"), F.max("failed").alias("failed"), F.max("examples").alias("examples"))
    total = judged.agg(F.count("*").alias("rows"))  # one row
    return one.crossJoin(F.broadcast(total)).select("subject", "rule", "provenance", "failed", (F.col("failed") / F.col("rows")).alias("rate"), "examples")


def checks(judged: DataFrame, contract: Contract) -> DataFrame:
    """check, kind, considered, failed, rate (of what it could judge, 0.0 where that is nothing)."""
    names = [c for c in contract.checks if f"_check_{c.name}" in judged.columns]
    one = judged.agg(*[x for c in names for x in (F.count(f"_check_{c.name}").alias(f"n_{c.name}"), F.count_if(~F.col(f"_check_{c.name}")).alias(f"f_{c.name}"))])
    each = F.explode(F.array(*[F.struct(F.lit(c.name).alias("check"), F.lit(c.kind).alias("kind"), F.col(f"n_{c.name}").alias("considered"), F.col(f"f_{c.name}").alias("failed")) for c in names]))
    return one.select(each.alias("c")).select("c.*").withColumn("rate", F.when(F.col("considered") > 0, F.col("failed") / F.col("considered")).otherwise(0.0))


def by_provenance(judged: DataFrame, contract: Contract) -> DataFrame:
    """provenance, rules (that fired), failed: hits of column rules, counted as rows."""
    return columns(judged, contract).where("subject <> 'check'").groupBy("provenance").agg(F.count_if(F.col("failed") > 0).alias("rules"), F.sum("failed").alias("failed"))


def rules_run(contract: Contract) -> int:
    """Every rule, a type a column, and every check."""
    return sum(len(c.rules) + 1 for c in contract.columns) + len(contract.checks)
