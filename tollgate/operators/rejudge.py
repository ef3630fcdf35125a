"""Judging a quarantine again, what each constraint alone holds, and deliberate breaks with a control."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.contract import Contract, constraints, drop_column, relax_check, relax_column
from tollgate.operators import judge, split
from tollgate.refusals import CannotRelax, NoQuarantine
from tollgate.sinks import folders

HELD = "_was_held"


def rejudge(accepted: DataFrame, held: DataFrame, contract: Contract) -> DataFrame:
    """Every row that was held, judged among all rows: its data, _contract_failures as they were and _failures as they are; refuses a split without rows on either side."""
    if held.isEmpty() and accepted.isEmpty():
        raise NoQuarantine("no rows, accepted or held")
    known = accepted.withColumns({HELD: F.lit(False), split.REASONS: F.lit(None).cast("string")})
    both = known.unionByName(held.withColumn(HELD, F.lit(True)))
    return judge.judged(both, contract, only=F.col(HELD))


def rejudge_summary(again: DataFrame) -> DataFrame:
    """held, recovered, still_held, changed (whose set of reasons is another); zeros where nothing was held."""
    now = F.array_sort(F.transform(judge.FAILURES, lambda f: F.concat(f["subject"], F.lit(":"), f["rule"])))
    then = F.array_sort(F.split(split.REASONS, " and "))
    clean = judge.clean(again)
    return again.agg(F.count("*").alias("held"), F.count_if(clean).alias("recovered"), F.count_if(~clean).alias("still_held"), F.count_if(~clean & (now != then)).alias("changed"))


def stopped(again: DataFrame) -> DataFrame:
    """reason, rows: reasons of recovered rows, which no longer fire."""
    free = again.where(F.size(judge.FAILURES) == 0).select(F.explode(F.split(split.REASONS, " and ")).alias("reason"))
    return free.groupBy("reason").agg(F.count("*").alias("rows"))


def reworded(again: DataFrame, ordinal: str) -> DataFrame:
    """ordinal, was, now: the sorted reasons of rows that are still held for another set of them."""
    now = F.array_sort(F.transform(judge.FAILURES, lambda f: F.concat(f["subject"], F.lit(":"), f["rule"])))
    both = again.where(F.size(judge.FAILURES) > 0).select(ordinal, F.array_sort(F.split(split.REASONS, " and ")).alias("was"), now.alias("now"))
    return both.where(F.col("was") != F.col("now"))


def marginal(judged: DataFrame, contract: Contract) -> DataFrame:
    """subject, rule, removable, recovered: how many rows each constraint alone holds; null where it can't be removed.

    Removing a rule frees just the rows whose only failure it is, so one pass answers for all.
    """
    spark = judged.sparkSession
    listed = spark.createDataFrame([(c.subject, c.rule, c.removable) for c in constraints(contract)], "subject string, rule string, removable boolean")
    one = judged.agg(F.array(*[F.struct(F.lit(s).alias("subject"), F.lit(r).alias("rule"), F.count_if(only).alias("alone")) for s, r, only in judge.alone(judged)]).alias("a"))
    alone = one.select(F.explode("a").alias("a")).select("a.subject", "a.rule", F.lit(None).cast("boolean").alias("removable"), "a.alone")
    both = listed.withColumn("alone", F.lit(0).cast("long")).unionByName(alone).groupBy("subject", "rule").agg(F.max("removable").alias("removable"), F.sum("alone").alias("alone"))
    return both.where("removable is not null").select("subject", "rule", "removable", F.when(F.col("removable"), F.col("alone")).alias("recovered"))


def relaxed(contract: Contract, subject: str, rule: str | None) -> Contract:
    """Without one constraint: a check, a rule, or (rule is None) a whole column."""
    if subject == "check":
        return relax_check(contract, rule or "")
    return drop_column(contract, subject) if rule is None else relax_column(contract, subject, rule)


@dataclass(frozen=True)
class Break:
    """Damage to some rows; subject, rule: what must catch it (a rule ``type`` goes with its column), or None if it should pass.

    columns: what a target's column becomes; copied: columns that targets take from a clean donor row, which then fails with them.
    """

    name: str
    subject: str | None
    rule: str | None
    columns: dict[str, Callable[[Column], Column]]
    copied: tuple[str, ...] = ()


#: Breaks of service requests, by what they do to a column of a clean row.
CATALOGUE = [
    Break("blank_key", "unique_key", "required", {"unique_key": lambda c: F.lit("")}),
    Break("unknown_borough", "borough", "allowed", {"borough": lambda c: F.lit("ATLANTIS")}),
    Break("long_agency", "agency", "max_length", {"agency": lambda c: F.lit("A very long agency")}),
    Break("short_zip", "incident_zip", "matches", {"incident_zip": lambda c: F.lit("0083")}),
    Break("far_north", "latitude", "max", {"latitude": lambda c: F.lit("60.17")}),
    Break("longitude_in_words", "longitude", "type", {"longitude": lambda c: F.lit("seventy-four")}),
    Break("duplicate_key", "unique_key", "unique", {}, ("unique_key",)),
    Break("closed_before_created", "check", "closed_after_created", {"closed_date": lambda c: F.lit("1900-01-01T00:00:00.000"), "status": lambda c: F.lit("Closed")}),
    Break("closed_without_a_date", "check", "closed_request_has_a_closed_date", {"status": lambda c: F.lit("Closed"), "closed_date": lambda c: F.lit("")}),
    Break("open_with_a_date", "check", "open_request_has_no_closed_date", {"status": lambda c: F.lit("Open"), "closed_date": lambda c: F.lit("2999-01-01T00:00:00.000")}),
    Break("wrong_agency", None, None, {"agency": lambda c: F.lit("OTHER")}),
]


BINS = 4096


def targets(judged: DataFrame, ordinal: str, count: int) -> DataFrame:
    """ordinal of ``count`` clean rows spread evenly over all clean ones, never the first; at least twice as many must be clean.

    ordinal is a whole number.  Rows are counted by ranges of it first; only the ranges that
    hold a target are put in order.
    """
    clean = judged.where(judge.clean(judged)).select(ordinal)
    lo, hi, n = clean.agg(F.min(ordinal), F.max(ordinal), F.count("*")).first()
    if count < 1 or count * 2 > n:
        raise CannotRelax(f"{count} targets of {n} clean rows")
    bin_ = F.floor((F.col(ordinal) - F.lit(lo)) / F.lit((hi - lo) // BINS + 1))
    sizes = clean.groupBy(bin_.alias("_bin")).agg(F.count("*").alias("n")).orderBy("_bin").collect()  # ``BINS`` + 1 numbers at the most
    wanted, before, step, k = [], 0, n // (count + 1), 1
    for r in sizes:
        while k <= count and step * k < before + r["n"]:
            wanted.append((r["_bin"], step * k - before + 1))
            k += 1
        before += r["n"]
    asked = judged.sparkSession.createDataFrame(wanted, "_bin long, _place int")
    some = clean.withColumn("_bin", bin_).join(F.broadcast(asked.select("_bin").distinct()), "_bin")  # ``count`` rows
    placed = some.withColumn("_place", F.row_number().over(Window.partitionBy("_bin").orderBy(ordinal)))
    return placed.join(F.broadcast(asked), ["_bin", "_place"]).select(ordinal)


def damaged(rows: DataFrame, chosen: DataFrame, ordinal: str, break_: Break, donor=None) -> DataFrame:
    """rows with the break done to the chosen ones; donor: a clean row, for what the break copies."""
    marked = rows.join(chosen.withColumn("_hit", F.lit(True)), ordinal, "left")
    changes = {c: f(F.col(c)) for c, f in break_.columns.items()} | {c: F.lit(donor[c]) for c in break_.copied}
    return marked.withColumns({c: F.when(F.col("_hit"), new).otherwise(F.col(c)) for c, new in changes.items()}).drop("_hit")


def _without(failures: Column, subject: Column, rule: Column) -> Column:
    """Failures under a contract without the rule; a type goes with its column."""
    return F.filter(failures, lambda f: ~((f["subject"] == subject) & ((rule == "type") | (f["rule"] == rule))))


def outcomes(rows: DataFrame, contract: Contract, ordinal: str, breaks: list[Break], count: int) -> DataFrame:
    """A row a break: name, targets, damaged, new_holds, caught, named, collateral, control_holds, amplification: what the contract says of the damage.

    damaged: rows that must fail, the donor among them; control_holds: how many of them still do
    by a contract without the rule, which must be none; amplification: rows lost for each row
    written to.  Rules are judged one by one, so a contract without one is the same failures
    without that one's.

    All breaks are judged at once.  Only rows that a break can touch are judged again: its
    targets, a copy for each break, and the rows of their partition whose unique values a target
    had or has now; the partition and the break together are where values must be unique.
    """
    for b in breaks:
        if b.subject is not None:
            relaxed(contract, b.subject, None if b.rule == "type" else b.rule)  # refuses a rule that can't go
    data = rows.columns
    before = folders.kept(judge.judged(rows, contract), "judged")
    chosen = folders.kept(targets(before, ordinal, count), "targets")
    copied, donor = {c for b in breaks for c in b.copied}, None
    if copied:
        donor = before.where(judge.clean(before)).agg(F.max_by(F.struct(ordinal, *copied), ordinal).alias("r")).first()["r"]  # one row
        if not chosen.where(F.col(ordinal) == donor[ordinal]).isEmpty():
            raise CannotRelax("the donor is a target: fewer of them")
    spark = rows.sparkSession
    was, hit, name = "_was", "_hit", "_break"
    hurt = before.join(F.broadcast(chosen), ordinal, "left_semi").select(*data).withColumn(name, F.explode(F.array(*[F.lit(b.name) for b in breaks])))  # ``count`` numbers
    changes = {}
    for c in {c for b in breaks for c in (*b.columns, *b.copied)}:
        new = F.col(c)
        for b in breaks:
            if c in b.columns or c in b.copied:
                new = F.when(F.col(name) == b.name, F.lit(donor[c]) if c in b.copied else b.columns[c](F.col(c))).otherwise(new)
        changes[c] = new
    after = hurt.withColumns(changes)
    none = F.array().cast(judge.FAILURE)
    world = after.withColumns({was: none, hit: F.lit(True)})
    keys = [c.name for c in contract.columns if c.rules.get("unique") and c.name in data]
    touched = None
    for c in [c for c in keys if c in changes]:
        moved = hurt.select(judge.PARTITION, name, F.lit(c).alias("_key"), F.explode(F.array(F.col(c), changes[c])).alias("_value"), (~F.col(c).eqNullSafe(changes[c])).alias("_moved")).where("_moved").drop("_moved").distinct()
        touched = moved if touched is None else touched.union(moved)
    if touched is not None:
        beside = before.join(F.broadcast(chosen), ordinal, "left_anti").select(*data, F.col(judge.FAILURES).alias(was))
        found = None
        for c in [c for c in keys if c in changes]:
            at = touched.where(F.col("_key") == c).select(F.col(judge.PARTITION).alias("_p"), F.col("_value").alias("_v"), name)
            one = beside.join(at, (F.col(judge.PARTITION) == F.col("_p")) & (F.col(c) == F.col("_v"))).select(*data, was, name)
            found = one if found is None else found.union(one).dropDuplicates([ordinal, name])
        donates = F.col(name).isin(*[b.name for b in breaks if b.copied]) & (F.col(ordinal) == F.lit(donor[ordinal] if donor else None)) if copied else F.lit(False)
        world = world.unionByName(found.withColumn(hit, donates))
    apart = world.withColumn(judge.PARTITION, F.concat_ws("\x00", judge.PARTITION, name))
    again = judge.judged(apart, contract)
    known = spark.createDataFrame([(b.name, b.subject or "", b.rule or "", count + (1 if b.copied else 0)) for b in breaks], f"{name} string, _subject string, _rule string, _damaged long")
    told = again.join(F.broadcast(known), name)  # a row a break
    fresh = ~judge.clean(again) & (F.size(was) == 0)
    named = F.exists(judge.FAILURES, lambda f: (f["subject"] == F.col("_subject")) & (f["rule"] == F.col("_rule")))
    still = F.col(hit) & (F.size(_without(F.col(judge.FAILURES), F.col("_subject"), F.col("_rule"))) > 0) & (F.size(_without(F.col(was), F.col("_subject"), F.col("_rule"))) == 0)
    found = told.groupBy(name, "_damaged").agg(F.count_if(fresh).alias("new_holds"), F.count_if(fresh & F.col(hit)).alias("caught"), F.count_if(fresh & F.col(hit) & named).alias("named"), F.count_if(fresh & ~F.col(hit)).alias("collateral"), F.count_if(still).alias("control_holds"))
    return found.select(F.col(name).alias("name"), F.lit(count).cast("long").alias("targets"), F.col("_damaged").alias("damaged"), "new_holds", "caught", "named", "collateral", "control_holds", (F.col("new_holds") / F.lit(float(count))).alias("amplification"))


def outcome(rows: DataFrame, contract: Contract, ordinal: str, break_: Break, count: int) -> DataFrame:
    """The row of one break."""
    return outcomes(rows, contract, ordinal, [break_], count)


def repeated(rows: DataFrame, times: int) -> DataFrame:
    """rows ``times`` over, twice at least: a load that ran again."""
    if times < 2:
        raise ValueError("twice at least")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_copy")
