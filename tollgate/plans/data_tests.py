"""The data tests of every relation of a run, from raw to gold: what the contract generates, and what is stated here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.contract import Contract
from tollgate.operators import checks
from tollgate.operators.checks import Test

STATUSES = ("Open", "Closed", "Assigned", "Pending", "In Progress", "Started", "Draft", "Unspecified")
CASTS = {"created_date": "created_at", "closed_date": "closed_at", "latitude": "latitude", "longitude": "longitude"}
#: Beside the tests that a contract generates for the raw relation.
STATED: dict[str, tuple[Test, ...]] = {
    "raw": (Test("_partition", "not_null"),),
    "ledger": (Test("_partition", "not_null"), Test("_partition", "unique")),
    "stg_requests": (Test("unique_key", "not_null"), Test("unique_key", "unique"), Test("created_at", "not_null"), Test("partition_day", "not_null")),
    "slv_requests": (Test("unique_key", "not_null"), Test("unique_key", "unique"), Test("status", "accepted_values", STATUSES)),
    "dim_complaint_type": (Test("complaint_type", "not_null"), Test("complaint_type", "unique"), Test("request_count", "not_null")),
    "gold_agency_daily": (Test("created_date", "not_null"), Test("agency", "not_null"), Test("request_count", "not_null")),
    "gold_complaint_resolution": (Test("complaint_type", "not_null"), Test("complaint_type", "unique"), Test("request_count", "not_null")),
}


def tests(contract: Contract) -> dict[str, list[Test]]:
    """By relation, every test of one relation."""
    return {relation: [*(checks.from_contract(contract) if relation == "raw" else ()), *stated] for relation, stated in STATED.items()}


def run(relations: dict[str, DataFrame], contract: Contract) -> DataFrame:
    """relation, column, kind, violations of every test: a pass over each relation, and the two tests that look at more than one."""
    whole = lambda rows, relation, kind: rows.agg(F.lit(relation).alias("relation"), F.lit("*").alias("column"), F.lit(kind).alias("kind"), F.count("*").alias("violations"))
    out = whole(checks.lossless_cast(relations["raw"], relations["stg_requests"], CASTS), "stg_requests", "lossless_cast")
    out = out.union(whole(checks.totals_agree(relations["slv_requests"], relations["gold_agency_daily"], relations["gold_complaint_resolution"]), "gold", "totals_agree"))
    for relation, listed in tests(contract).items():
        out = out.union(checks.run_all(relation, relations[relation], listed))
    return out
