"""Judging rows: the contract becomes expressions, and one plan finds every failure of every row.

A judgement is made in layers, so that each text is stripped, read as a number and read as a
time once, however many rules ask for it.  What fails is kept as bits of a few whole numbers,
which counts and summaries add up; only rows that are looked at get a list of failures.

Uniqueness is the only rule that looks at other rows: values that occur twice in a partition
are counted with a map-side combine and joined back.  Rows without a value carry another
value of the join's last key, so that they are dealt over all tasks and never gather.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.contract import Check, Contract
from tollgate.contract import Column as Described
from tollgate.functions import text
from tollgate.refusals import NothingChecked

PARTITION, FAILURES, EVALUATIONS = "_partition", "_failures", "_evaluations"
#: Columns that a judgement adds for counting: bits of failed rules, and how often the most frequent key of a row occurs.
BITS, TIMES = "_failed_bits_", "_key_times"
FAILURE = "array<struct<subject:string,rule:string>>"
WORD = 62  # rules in one whole number


@dataclass(frozen=True)
class Rule:
    """subject, label; fails: of the columns of ``_seen``, never null."""

    subject: str
    label: str
    fails: Column


def _read(kind: str, name: str) -> str:
    """text, there, number or time: the name of a column that a judgement reads once."""
    return f"__{kind}_{name}"


def _rules_of(c: Described) -> list[Rule]:
    """In the order in which a row's failures are listed."""
    value, there, number = F.col(f"`{_read('text', c.name)}`"), F.col(f"`{_read('there', c.name)}`"), F.col(f"`{_read('number', c.name)}`")
    kinds = {"string": lambda: F.lit(True), "integer": lambda: value.rlike(text.INTEGER), "number": lambda: number.isNotNull(), "timestamp": lambda: F.col(f"`{_read('time', c.name)}`").isNotNull()}
    within = {"min": lambda least: number >= float(least), "max": lambda most: number <= float(most)}
    passes = {"type": kinds[c.type]()}
    if "allowed" in c.rules:
        passes["allowed"] = value.isin(*[str(v) for v in c.rules["allowed"]])
    if "max_length" in c.rules:
        passes["max_length"] = F.char_length(value) <= int(c.rules["max_length"])
    if "matches" in c.rules:
        passes["matches"] = value.rlike(f"^(?:{c.rules['matches']})")
    passes |= {rule: number.isNull() | (~F.isnan(number) & ok(c.rules[rule])) for rule, ok in within.items() if rule in c.rules}
    if c.rules.get("unique"):
        passes["unique"] = F.coalesce(F.col(f"`{_read('times', c.name)}`"), F.lit(1)) <= 1
    first = [Rule(c.name, "required", ~there)] if c.rules.get("required") else []
    return first + [Rule(c.name, label, there & ~ok) for label, ok in passes.items()]


def value_rules(contract: Contract, present: set[str]) -> list[Rule]:
    """The rules of all columns that are there, in the contract's order."""
    return [r for c in contract.columns if c.name in present for r in _rules_of(c)]


def _check_passes(check: Check) -> Column:
    """True, false, or null where the check has nothing to say."""
    of = lambda kind, arg: F.col(f"`{_read(kind, check.args[arg])}`")
    if check.kind == "ordering":
        return of("time", "after") >= of("time", "before")
    if check.kind not in ("requires_when", "forbids_when"):
        raise ValueError(f"no check is called {check.kind}")
    fires = F.coalesce(of("text", "when_column"), F.lit("")).isin(*[str(v) for v in check.values])
    return F.when(fires, of("there", "then_required") if check.kind == "requires_when" else ~of("there", "then_absent"))


def checks_of(contract: Contract, present: set[str]) -> list[Check]:
    return [c for c in contract.checks if set(c.columns) <= present]


def collisions(rows: DataFrame, name: str) -> DataFrame:
    """_partition, value, times: present values that a partition has twice or more."""
    col = F.col(f"`{name}`")
    counted = rows.where(~text.is_null(col)).groupBy(PARTITION, col.alias("value")).agg(F.count("*").alias("times"))
    return counted.where("times > 1")


def _with_times(rows: DataFrame, name: str) -> DataFrame:
    """rows and how often the partition has the column's value, null where it is null or alone."""
    again = collisions(rows, name).select(F.col(PARTITION).alias("__p"), F.col("value").alias("__v"), F.pmod("times", F.lit(1)).alias("__s"), F.col("times").alias(_read("times", name)))
    salt = F.when(text.is_null(F.col(f"`{name}`")), F.pmod(F.xxhash64(*[f"`{c}`" for c, kind in rows.dtypes if "map<" not in kind]), F.lit(1 << 16)) + 1).otherwise(F.lit(0))
    salted = rows.withColumn("__salt", salt.cast("long"))
    met = (salted[PARTITION] == again["__p"]) & (salted[name] == again["__v"]) & (salted["__salt"] == again["__s"])
    return salted.join(again, met, "left").drop("__p", "__v", "__s", "__salt")


def _seen(rows: DataFrame, contract: Contract, checks: list[Check]) -> DataFrame:
    """rows with each contract column's stripped text, whether there is one, and its number and time where something asks for them."""
    there = [c for c in contract.columns if c.name in rows.columns]
    ordered = {x for c in checks if c.kind == "ordering" for x in c.columns}
    value = lambda c: F.col(f"`{_read('text', c.name)}`")
    out = rows.withColumns({_read("text", c.name): text.stripped(F.col(f"`{c.name}`")) for c in there})
    more = {_read("there", c.name): ~text.null_text(value(c)) for c in there}
    more |= {_read("number", c.name): text.number_of(value(c)) if c.type == "number" or {"min", "max"} & set(c.rules) else F.lit(None).cast("double") for c in there}
    more |= {_read("time", c.name): text.timestamp_of(value(c)) for c in there if c.type == "timestamp" or c.name in ordered}
    return out.withColumns(more)


#: The longest method that a JVM still compiles; Spark's own bound is that of a class file.
COMPILED, SPARKS = "8000", "65535"


def _compiled(spark: SparkSession) -> None:
    """Stages whose generated method no JVM would compile are generated in smaller pieces, unless the session has a bound of its own."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == SPARKS:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED)


def _level(parts: list[Column], join: Callable[[Column, Column], Column]) -> Column:
    """All parts joined, two by two, so that an expression of many rules isn't deep."""
    while len(parts) > 1:
        parts = [join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def judged(rows: DataFrame, contract: Contract, only: Column | None = None) -> DataFrame:
    """rows with _failures, _evaluations, a nullable verdict _check_<name> for each check, and the columns ``BITS`` and ``TIMES``; rows need _partition.

    only: which rows are judged; values are unique among all of them still.
    """
    present = set(rows.columns)
    if not present & set(contract.names):
        raise NothingChecked("none of the contract's columns are there")
    _compiled(rows.sparkSession)
    unique = [c.name for c in contract.columns if c.name in present and c.rules.get("unique")]
    out = rows
    for name in unique:
        out = _with_times(out, name)
    out = out if only is None else out.where(only)
    rules, checks = value_rules(contract, present), checks_of(contract, present)
    out = _seen(out, contract, checks).withColumns({f"_check_{c.name}": _check_passes(c) for c in checks})
    verdict = lambda c: F.col(f"`_check_{c.name}`")
    found = [(r.subject, r.label, r.fails) for r in rules] + [("check", c.name, F.coalesce(~verdict(c), F.lit(False))) for c in checks]
    # always 0, and not deterministic: a condition on what failed is asked of these layers' result, not written out below them
    barrier = F.call_function("shiftright", F.spark_partition_id(), F.lit(31)).cast("long")
    words, none = [], F.lit(0).cast("long")
    for k in range(0, len(found), WORD):
        some = found[k : k + WORD]
        word = _level([barrier, *[F.when(fails, F.lit(1 << i).cast("long")).otherwise(none) for i, (_, _, fails) in enumerate(some)]], lambda a, b: a.bitwiseOR(b))
        words.append(word.alias(f"{BITS}{k // WORD}", metadata={"subjects": [s for s, _, _ in some], "rules": [r for _, r, _ in some]}))
    work = [F.lit(sum(r.label == "required" for r in rules)).cast("long")]
    work += [F.when(F.col(f"`{_read('there', name)}`"), F.lit(sum(r.subject == name and r.label != "required" for r in rules)).cast("long")).otherwise(none) for name in dict.fromkeys(r.subject for r in rules)]
    done = _level([*work, *[verdict(c).isNotNull().cast("long") for c in checks]], lambda a, b: a + b)
    times = F.greatest(F.lit(1).cast("long"), *[F.coalesce(F.col(f"`{_read('times', n)}`"), F.lit(1)).cast("long") for n in [*unique, *unique]]) if unique else F.lit(1).cast("long")
    out = out.select(*[f"`{c}`" for c in rows.columns], *[verdict(c) for c in checks], done.alias(EVALUATIONS), times.alias(TIMES), *words)
    return out.select(*[f"`{c}`" for c in rows.columns], *[verdict(c) for c in checks], _listed(out).alias(FAILURES), EVALUATIONS, TIMES, *[w for w in out.columns if w.startswith(BITS)])


def bits(judged_: DataFrame) -> list[tuple[str, int, str, str]]:
    """Column, place, subject and rule of every bit."""
    words = [f for f in judged_.schema.fields if f.name.startswith(BITS)]
    return [(f.name, i, s, r) for f in words for i, (s, r) in enumerate(zip(f.metadata["subjects"], f.metadata["rules"]))]


def _quoted(text_: str) -> str:
    """A text as it stands in SQL."""
    return "'" + text_.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(words: DataFrame) -> Column:
    """The failures that the bits stand for."""
    labels = F.expr(f"array({', '.join(f'struct({_quoted(s)} as subject, {_quoted(r)} as rule)' for _, _, s, r in bits(words))})")
    names = [w for w in words.columns if w.startswith(BITS)]
    of = lambda i: F.col(names[0]) if len(names) == 1 else F.get(F.array(*names), (i / WORD).cast("int"))
    failed = F.filter(labels, lambda _, i: F.call_function("shiftright", of(i), i % WORD).bitwiseAND(F.lit(1)) == 1)
    none = F.array().cast(FAILURE)
    return F.when(clean(words), none).otherwise(failed.cast(FAILURE)) if names else none


def clean(judged_: DataFrame) -> Column:
    """Whether a row breaks nothing."""
    out = F.lit(True)
    for c in judged_.columns:
        if c.startswith(BITS):
            out = out & (F.col(c) == 0)
    return out


def own(name: str) -> bool:
    """Whether a column is one that a judgement adds."""
    return name in (PARTITION, FAILURES, EVALUATIONS, TIMES) or name.startswith(("_check_", BITS))


def _failing(judged_: DataFrame, among: list[tuple[str, int, str, str]]) -> dict[str, int]:
    """By column, the bits of the given rules."""
    out: dict[str, int] = {}
    for word, i, _, _ in among:
        out[word] = out.get(word, 0) | 1 << i
    return out


def alone(judged_: DataFrame) -> list[tuple[str, str, Column]]:
    """subject, rule and whether a row breaks that rule only."""
    words = [c for c in judged_.columns if c.startswith(BITS)]
    only = lambda word, i: F.expr(" and ".join([f"{word} = {1 << i}L", *[f"{w} = 0L" for w in words if w != word]]))
    return [(subject, rule, only(word, i)) for word, i, subject, rule in bits(judged_)]


def drift(rows: DataFrame, contract: Contract) -> tuple[list[str], list[str]]:
    """(missing, uncontracted) columns."""
    there = [c for c in rows.columns if not c.startswith("_")]
    return [n for n in contract.names if n not in there], [c for c in there if c not in contract.names]


def counts(judged_: DataFrame) -> Column:
    """An aggregate: an array of subject, rule, failed for every rule, zeros too."""
    one = [f"struct({_quoted(s)} as subject, {_quoted(r)} as rule, coalesce(sum(shiftright({word}, {i}) & 1L), 0L) as failed)" for word, i, s, r in bits(judged_)]
    return F.expr(f"array({', '.join(one)})")


def rule_counts(judged_: DataFrame) -> DataFrame:
    """subject, rule, failed of the rules that fail: one sum a rule, no row for each failure."""
    return judged_.agg(counts(judged_).alias("c")).select(F.explode("c").alias("c")).select("c.subject", "c.rule", "c.failed").where("failed > 0")


def held_only_by(rule: str) -> Column:
    """A count of rows whose every failure is of that rule, on whatever column."""
    return F.count_if((F.size(FAILURES) > 0) & F.forall(FAILURES, lambda f: f["rule"] == rule))


def _only(judged_: DataFrame, rule: str) -> Column:
    """As ``held_only_by``, from the bits."""
    mine = _failing(judged_, [b for b in bits(judged_) if b[3] == rule and b[2] != "check"])
    out = ~clean(judged_)
    for word in [c for c in judged_.columns if c.startswith(BITS)]:
        out = out & (F.col(word).bitwiseAND(F.lit(~mine.get(word, 0)).cast("long")) == 0)
    return F.count_if(out)


def totals(judged_: DataFrame, contract: Contract) -> dict[str, Column]:
    """Aggregates by name: rows, accepted, held, evaluations, multi_rule, held_only_by_unique, considered_<check>."""
    failed = F.lit(0)
    for word in [c for c in judged_.columns if c.startswith(BITS)]:
        failed = failed + F.bit_count(word)
    checks = [c.name for c in contract.checks if f"_check_{c.name}" in judged_.columns]
    return {
        "rows": F.count("*"),
        "accepted": F.count_if(clean(judged_)),
        "held": F.count_if(~clean(judged_)),
        "evaluations": F.sum(EVALUATIONS),
        "multi_rule": F.count_if(failed > 1),
        "held_only_by_unique": _only(judged_, "unique"),
        **{f"considered_{c}": F.count(f"_check_{c}") for c in checks},
    }


def summary(judged_: DataFrame, contract: Contract) -> DataFrame:
    """A row for each partition: rows, accepted, held, evaluations, multi_rule, held_only_by_unique, considered_<check>."""
    return judged_.groupBy(PARTITION).agg(*[c.alias(n) for n, c in totals(judged_, contract).items()])


def refuse_if_idle(judged_: DataFrame) -> None:
    """Refuses rows on which no rule was evaluated."""
    got = judged_.agg(F.count("*").alias("rows"), F.sum(EVALUATIONS).alias("work")).first()
    if got["rows"] and not got["work"]:
        raise NothingChecked(f"{got['rows']} rows, and no rule was evaluated on any")


def largest_collision(rows: DataFrame, contract: Contract) -> DataFrame:
    """column, largest: how often a unique column's most frequent value occurs in a partition, 1 at least."""
    out = None
    for c in contract.columns:
        if c.rules.get("unique") and c.name in rows.columns:
            one = collisions(rows, c.name).agg(F.greatest(F.lit(1), F.coalesce(F.max("times"), F.lit(1))).cast("long").alias("largest")).select(F.lit(c.name).alias("column"), "largest")
            out = one if out is None else out.union(one)
    return out
