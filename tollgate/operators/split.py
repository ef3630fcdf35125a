"""Accepted and held rows, the reasons, and the report."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.contract import Contract
from tollgate.operators import judge
from tollgate.refusals import NothingChecked, ReasonColumnClash
from tollgate.sinks import folders

REASONS = "_contract_failures"


def reason() -> Column:
    """``subject:rule and subject:rule``."""
    return F.array_join(F.transform(judge.FAILURES, lambda f: F.concat(f["subject"], F.lit(":"), f["rule"])), " and ")


def _data(judged: DataFrame) -> list[str]:
    return [c for c in judged.columns if not judge.own(c)]


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(judge.clean(judged)).select(judge.PARTITION, *[f"`{c}`" for c in _data(judged)])


def held(judged: DataFrame) -> DataFrame:
    """Held rows with their reasons; refuses data that have such a column already."""
    columns = _data(judged)
    if REASONS in columns:
        raise ReasonColumnClash(REASONS)
    return judged.where(~judge.clean(judged)).select(judge.PARTITION, *[f"`{c}`" for c in columns], reason().alias(REASONS))


#: The names of a report's fields, fixed values of the format.
FIELDS = {
    "rows": "rows", "accepted": "accepted", "held": "held", "held_share": "held_share", "multi_rule": "rows_breaking_more_than_one_rule",
    "held_only_by_unique": "held_only_by_a_key_collision", "largest_collision": "largest_key_collision", "sum_of_rule_counts": "sum_of_rule_counts",
    "largest_rule_count": "largest_rule_count", "evaluations": "rule_evaluations",
}


def reports(judged: DataFrame, contract: Contract) -> DataFrame:
    """A row for each partition: the counts, held_share, largest_collision, by_rule (subject, rule, rows by descending rows, then name) and considered_<check>.

    One aggregation of one judgement: a sum a rule, a list of rules for each partition.
    """
    total = judge.totals(judged, contract)
    one = judged.groupBy(judge.PARTITION).agg(*[c.alias(n) for n, c in total.items()], F.max(judge.TIMES).alias("largest_collision"), judge.counts(judged).alias("counts"))
    fired = F.filter("counts", lambda x: x["failed"] > 0)
    listed = F.array_sort(F.transform(fired, lambda x: F.struct((-x["failed"]).alias("n"), x["subject"].alias("subject"), x["rule"].alias("rule"))))
    return one.select(
        judge.PARTITION, "rows", "accepted", "held", F.round(F.col("held") / F.col("rows"), 6).alias("held_share"), "multi_rule", "held_only_by_unique", "largest_collision",
        F.aggregate(fired, F.lit(0).cast("long"), lambda a, x: a + x["failed"]).alias("sum_of_rule_counts"), F.coalesce(F.array_max(F.transform(fired, lambda x: x["failed"])), F.lit(0)).alias("largest_rule_count"), "evaluations",
        F.transform(listed, lambda x: F.struct(x["subject"].alias("subject"), x["rule"].alias("rule"), (-x["n"]).alias("rows"))).alias("by_rule"), *[n for n in total if n.startswith("considered_")],
    )


def _told(got: dict, judged: DataFrame, contract: Contract, partition: str, path: str | None) -> dict:
    """A row of ``reports`` as the report that is stored."""
    missing, more = judge.drift(judged, contract)
    return {name: got[c] for c, name in FIELDS.items()} | {
        "partition": partition,
        "path": path,
        "held_share": round(got["held"] / got["rows"], 6) if got["rows"] else 0.0,
        "by_rule": [{"subject": r["subject"], "rule": r["rule"], "rows": r["rows"]} for r in got["by_rule"]],
        "rows_each_check_could_judge": {c.removeprefix("considered_"): n for c, n in sorted(got.items()) if c.startswith("considered_")},
        "contracted_columns_absent": missing,
        "columns_with_no_contract": more,
    }


def told(judged: DataFrame, contract: Contract, partitions: dict[str, str | None]) -> dict[str, dict]:
    """The reports of the partitions (name: path) from one aggregation; of one without rows too, whose held share is 0.0.  Refuses one with rows on which no rule was evaluated."""
    whole = reports(judged, contract)
    none = {c: 0 for c in whole.columns} | {"largest_collision": 1, "by_rule": []}
    found = {r[judge.PARTITION]: r.asDict() for r in whole.collect()}  # a row a partition, with an entry for each rule
    for name in partitions:
        if name in found and not found[name]["evaluations"]:
            raise NothingChecked(f"{name}: {found[name]['rows']} rows, and no rule was evaluated on any")
    return {name: _told(found.get(name, none), judged, contract, name, path) for name, path in partitions.items()}


def report(judged: DataFrame, contract: Contract, partition: str, path: str | None = None) -> dict:
    """The report of one partition."""
    return told(judged.where(F.col(judge.PARTITION) == partition), contract, {partition: path})[partition]


CSV = {"header": "true", "emptyValue": "", "quote": '"', "escape": '"'}


def write_days(judged: DataFrame, contract: Contract, partitions: dict[str, str | None], root: str) -> dict[str, dict]:
    """For each partition (name: path) accepted/ and quarantined/ as CSV with headers, and report.json, under ``root/<name>``; the reports.

    The judgement runs once for any number of partitions: it is written aside under root, and
    the reports, one CSV write a side and one of the reports come from there.  Nothing appears
    under a partition's name before all of it is written; folders are then moved.
    """
    spark = judged.sparkSession
    aside = f"{root.rstrip('/')}/_aside-{uuid.uuid4().hex}"
    try:
        judged.write.partitionBy(judge.PARTITION).parquet(f"{aside}/judged")
        order = [f"`{c}`" for c in judged.columns]
        once = spark.read.schema(judged.schema).parquet(f"{aside}/judged").select(*order)
        found = told(once, contract, partitions)
        for name, side in (("accepted", accepted(once)), ("quarantined", held(once))):
            side.write.partitionBy(judge.PARTITION).options(**CSV).csv(f"{aside}/{name}")
        texts = spark.createDataFrame([(p, json.dumps(r, sort_keys=True, indent=2)) for p, r in found.items()], "_partition string, value string")
        texts.repartition(judge.PARTITION).write.partitionBy(judge.PARTITION).option("lineSep", "\n").text(f"{aside}/report.json")
        for partition in partitions:
            for name in ("accepted", "quarantined", "report.json"):
                folders.put_in_place(spark, f"{aside}/{name}/{judge.PARTITION}={folders.escaped(partition)}", f"{root.rstrip('/')}/{partition}/{name}")
    finally:
        folders.remove(spark, aside)
    return found


def write(judged: DataFrame, contract: Contract, partition: str, directory: str, path: str | None = None) -> dict:
    """As ``write_days``, of one partition into a folder of its own."""
    root, name = directory.rstrip("/").rsplit("/", 1)
    one = judged.where(F.col(judge.PARTITION) == partition)
    if name == partition:
        return write_days(one, contract, {partition: path}, root)[partition]
    found = write_days(one, contract, {partition: path}, f"{directory}/_days")[partition]
    spark = judged.sparkSession
    for side in ("accepted", "quarantined", "report.json"):
        folders.put_in_place(spark, f"{directory}/_days/{partition}/{side}", f"{directory}/{side}")
    folders.remove(spark, f"{directory}/_days")
    return found
