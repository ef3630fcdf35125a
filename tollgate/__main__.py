"""The command line: ``python -m tollgate <run> ...``; the exit code is the run's."""

from __future__ import annotations

import argparse
import importlib
import sys
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tollgate import contract as contracts
from tollgate import runs
from tollgate.operators import checks, feed
from tollgate.plans import models
from tollgate.sinks import store
from tollgate.sources import api, files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tollgate")
    p.add_argument("run", choices=["quarantine", "rejudge", "marginal", "load", "backfill", "feed", "breaks", "profile", "generate", "lineage", "damage", "probe", "pull", "run"])
    p.add_argument("--contract", help="the contract's YAML file")
    p.add_argument("--raw", help="folder of raw CSV partitions")
    p.add_argument("--quarantine", help="folder of judged partitions")
    p.add_argument("--store", help="folder of the raw layer")
    p.add_argument("--manifest", help="the manifest's JSON file")
    p.add_argument("--partition", help="one day; all of them without it")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--write", action="store_true", help="write the split and the report")
    p.add_argument("--twice", action="store_true", help="load again and compare")
    p.add_argument("--reference", choices=contracts.REFERENCES)
    p.add_argument("--applies-to", choices=contracts.SCOPES)
    p.add_argument("--holdout", type=int, default=5)
    p.add_argument("--count", type=int, default=1, help="rows to damage")
    p.add_argument("--mart", action="store_true", help="what two of the breaks do to the marts over the store")
    p.add_argument("--base", help="address of the paged source")
    p.add_argument("--getter", help="module:function that gets a page of the source by its address")
    p.add_argument("--days", type=int, default=1, help="days to pull from --start on")
    p.add_argument("--page", type=int, default=api.PAGE, help="rows of a page")
    p.add_argument("--relation", default="raw", help="the relation that generated tests are of")
    p.add_argument("--check", help="a stored document that must be what is generated now")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None, now: datetime | None = None) -> int:
    a = parser().parse_args(argv)
    now = now or datetime.now()
    if a.run == "lineage":
        print("\n".join(" ".join(layer) for layer in models.layers()))
        return 0
    contract = contracts.load(a.contract)
    if a.run == "generate":
        if not a.check:
            print(checks.rendered(contract, a.relation), end="")
            return 0
        with open(a.check, encoding="utf-8") as f:
            drift = checks.drifted(contract, a.relation, f.read())
        print("\n".join(drift) or "up to date")
        return 1 if drift else 0
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    known = files.manifest(spark, a.manifest) if a.manifest else spark.createDataFrame([], files.MANIFEST)
    if a.run == "quarantine":
        run = runs.quarantine(spark, contract, a.raw, a.quarantine if a.write else None, a.partition)
    elif a.run == "rejudge":
        run = runs.rejudged(spark, contract, a.quarantine, a.partition)
    elif a.run == "marginal":
        run = runs.marginal(spark, contract, a.quarantine, a.partition)
    elif a.run == "load":
        run = runs.load(spark, contract, a.quarantine, a.store, known, now, a.partition, a.twice)
    elif a.run == "backfill":
        run = runs.backfill(spark, contract, a.quarantine, a.store, known, a.start, a.end, now, a.twice)
    elif a.run == "probe":
        run = runs.probe(spark, contract, a.quarantine, a.store, known, now)
    elif a.run == "pull":
        module, _, name = a.getter.partition(":")
        run = runs.pull(spark, getattr(importlib.import_module(module), name), contract, a.base, a.raw, a.manifest, a.start, a.days, a.page, now)
    elif a.run == "run":
        run = runs.run_range(spark, contract, a.raw, a.quarantine, a.store, a.start, a.end, known, now)
    elif a.run == "profile":
        run = runs.profiled(spark, contract, a.raw, a.partition)
    elif a.run == "damage":
        paths = list(runs.partitions(spark, a.raw).values())
        changed = [r for r in files.inference_damage(spark, paths, contract.names).collect() if r["changed"]]  # a row for each column
        run = runs.Run(1 if changed else 0, [f"{r['column']} as {r['type']}: {r['changed']} cells" for r in changed] or ["no cell changes"])
    else:
        found = runs.partitions(spark, a.raw, a.partition)
        if not found:
            print(f"no partitions under {a.raw}")
            return 2
        if a.run == "breaks":
            day, path = next(iter(found.items()))
            rows = files.numbered(files.read_csv(spark, path, contract.names)).withColumn("_partition", F.lit(day))
            raw = store.RawStore(spark, a.store, contract).table() if a.mart else None
            run = runs.breaks(spark, contract, rows, "_ordinal", a.count, raw, now)
        else:
            column = contract.source["partition_column"]
            events = files.read_days(spark, list(found.values()), contract.names)
            run = runs.feed_checks(spark, contract, known, feed.newest_events(events, column), now, a.reference, a.applies_to, a.holdout)
    print("\n".join(run.lines))
    return run.code


if __name__ == "__main__":
    sys.exit(main())
