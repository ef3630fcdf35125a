"""A data contract: columns with rules, checks across columns, freshness and volume."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

import yaml

from tollgate.refusals import CannotRelax, ContractError

TYPES = ("string", "integer", "number", "timestamp")
#: What a rule's value must be an instance of.
RULES: dict[str, type | tuple[type, ...]] = {"required": bool, "unique": bool, "allowed": list, "max_length": int, "matches": str, "min": (int, float), "max": (int, float)}
CHECKS = {"ordering": ("before", "after"), "requires_when": ("when_column", "then_required"), "forbids_when": ("when_column", "then_absent")}
PROVENANCES = ("documented", "asserted")
REFERENCES, SCOPES = ("wall_clock", "partition_end", "extract"), ("tail", "all")


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    rules: dict[str, Any]
    provenance: str
    note: str = ""


@dataclass(frozen=True)
class Check:
    name: str
    kind: str
    args: dict[str, Any]
    provenance: str
    note: str = ""

    @property
    def columns(self) -> list[str]:
        return [self.args[a] for a in CHECKS[self.kind]]

    @property
    def values(self) -> list[str]:
        return [self.args["when_equals"]] if "when_equals" in self.args else list(self.args.get("when_in", []))


@dataclass(frozen=True)
class Contract:
    dataset: str
    source: dict[str, Any]
    freshness: dict[str, Any]
    volume: dict[str, Any]
    columns: list[Column]
    checks: list[Check] = field(default_factory=list)

    def column(self, name: str) -> Column | None:
        return next((c for c in self.columns if c.name == name), None)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def constraint_count(self) -> int:
        return sum(len(c.rules) for c in self.columns)

    @property
    def asserted_count(self) -> int:
        """How many of the columns' constraints no document backs."""
        return sum(len(c.rules) for c in self.columns if c.provenance == "asserted")


def _must(ok: Any, why: str) -> None:
    if not ok:
        raise ContractError(why)


def _provenance(entry: dict, what: str) -> str:
    _must(entry.get("provenance") in PROVENANCES, f"{what}: provenance must be one of {', '.join(PROVENANCES)}")
    return entry["provenance"]


def _column(entry: Any) -> Column:
    _must(isinstance(entry, dict) and entry.get("name"), f"a column without a name: {entry!r}")
    name = entry["name"]
    _must(entry.get("type") in TYPES, f"{name}: type must be one of {', '.join(TYPES)}")
    rules = {k: v for k, v in entry.items() if k not in ("name", "type", "provenance", "note")}
    for rule, value in rules.items():
        _must(rule in RULES, f"{name}: no rule is called {rule}")
        _must(isinstance(value, RULES[rule]), f"{name}: {rule} can't be {value!r}")
    _must(rules, f"{name}: no rules")
    _must(not ("min" in rules and "max" in rules and rules["min"] > rules["max"]), f"{name}: min is above max")
    return Column(name, entry["type"], rules, _provenance(entry, name), entry.get("note", ""))


def _check(entry: Any, known: set[str]) -> Check:
    _must(isinstance(entry, dict) and entry.get("name"), f"a check without a name: {entry!r}")
    name, kind = entry["name"], entry.get("kind")
    _must(kind in CHECKS, f"{name}: kind must be one of {', '.join(CHECKS)}")
    for arg in CHECKS[kind]:
        _must(arg in entry, f"{name}: {arg} is missing")
        _must(entry[arg] in known, f"{name}: {entry[arg]} isn't a column of the contract")
    if kind != "ordering":
        _must(("when_equals" in entry) != ("when_in" in entry), f"{name}: give one of when_equals and when_in")
        _must("when_in" not in entry or isinstance(entry["when_in"], list), f"{name}: when_in must be a list")
    args = {k: v for k, v in entry.items() if k not in ("name", "kind", "provenance", "note")}
    return Check(name, kind, args, _provenance(entry, name), entry.get("note", ""))


def parse(document: Any) -> Contract:
    """The contract of a parsed YAML document."""
    _must(isinstance(document, dict), "a contract is a mapping")
    for key in ("dataset", "source", "freshness", "volume", "columns"):
        _must(key in document, f"{key} is missing")
    source, freshness, volume = document["source"], document["freshness"], document["volume"]
    for key in ("kind", "partition_column", "partition_grain"):
        _must(isinstance(source, dict) and key in source, f"source: {key} is missing")
    _must(isinstance(freshness, dict) and isinstance(freshness.get("max_lag_hours"), (int, float)), "freshness: max_lag_hours is missing")
    _provenance(freshness, "freshness")
    _must(freshness.get("reference") in REFERENCES, f"freshness: reference must be one of {', '.join(REFERENCES)}")
    _must(freshness.get("applies_to") in SCOPES, f"freshness: applies_to must be one of {', '.join(SCOPES)}")
    _must(isinstance(volume, dict) and isinstance(volume.get("min_rows_per_partition"), int), "volume: min_rows_per_partition is missing")
    _provenance(volume, "volume")
    _must(isinstance(document["columns"], list) and document["columns"], "no columns")
    columns = [_column(c) for c in document["columns"]]
    names = [c.name for c in columns]
    _must(len(set(names)) == len(names), "two columns have one name")
    _must(source["partition_column"] in names, "the partition column isn't in the contract")
    checks = [_check(c, set(names)) for c in document.get("checks") or []]
    _must(len({c.name for c in checks}) == len(checks), "two checks have one name")
    return Contract(document["dataset"], source, freshness, volume, columns, checks)


def load(path: str) -> Contract:
    with open(path, encoding="utf-8") as f:
        return parse(yaml.safe_load(f))


@dataclass(frozen=True)
class Constraint:
    """A rule of the contract, and whether and why not it can be removed."""

    subject: str
    rule: str
    removable: bool
    why_not: str = ""

    @property
    def label(self) -> str:
        return f"{self.subject}:{self.rule}"


def constraints(contract: Contract) -> list[Constraint]:
    """All rules but types, by column with rules sorted by name, then the checks."""
    found = []
    for c in contract.columns:
        for rule in sorted(c.rules):
            if c.rules[rule] is False:
                found.append(Constraint(c.name, rule, False, "permits"))
            elif len(c.rules) == 1:
                found.append(Constraint(c.name, rule, False, "only rule on this column"))
            else:
                found.append(Constraint(c.name, rule, True))
    return found + [Constraint("check", c.name, True) for c in contract.checks]


def relax_column(contract: Contract, name: str, rule: str) -> Contract:
    """The contract without one rule of a column."""
    column = contract.column(name)
    if column is None or rule not in column.rules:
        raise CannotRelax(f"{name} has no rule {rule}")
    rest = {k: v for k, v in column.rules.items() if k != rule}
    if not rest:
        raise CannotRelax(f"{rule} is the only rule on {name}")
    return replace(contract, columns=[replace(c, rules=rest) if c.name == name else c for c in contract.columns])


def drop_column(contract: Contract, name: str) -> Contract:
    """The contract without a column that nothing else refers to."""
    if contract.column(name) is None:
        raise CannotRelax(f"{name} isn't in the contract")
    if name == contract.source["partition_column"] or any(name in c.columns for c in contract.checks):
        raise CannotRelax(f"something else refers to {name}")
    return replace(contract, columns=[c for c in contract.columns if c.name != name])


def relax_check(contract: Contract, name: str) -> Contract:
    """The contract without a check."""
    if name not in [c.name for c in contract.checks]:
        raise CannotRelax(f"no check is called {name}")
    return replace(contract, checks=[c for c in contract.checks if c.name != name])
