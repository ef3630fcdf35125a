"""What a user starts: partitions judged, split, loaded, modelled and judged again, each run with an exit code.

0: as it should be; 1: something to look at (a recovery, a drift, a gap, a break that wasn't
caught); 2: nothing was there to work on.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.contract import Contract
from tollgate.operators import feed, history, judge, profile, rejudge, split
from tollgate.plans import data_tests, models
from tollgate.refusals import BackfillStopped, MissingPartitions, NothingChecked, UnjudgedPartition
from tollgate.sinks import folders, store
from tollgate.sources import api, files

DAY = r"(\d{4}-\d{2}-\d{2})"


@dataclass
class Run:
    code: int
    lines: list[str] = field(default_factory=list)


def partitions(spark: SparkSession, root: str, only: str | None = None) -> dict[str, str]:
    """Partition: path, of the days whose file or folder lies under root."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    at = F.regexp_extract("path", f"^(.*/[^/]*{DAY}[^/]*)", 1)
    day = F.regexp_extract(at, f"{DAY}[^/]*$", 1)
    names = found.select(day.alias("day"), at.alias("at")).where("day <> ''").groupBy("day").agg(F.min("at").alias("at")).collect()  # a name a day
    return {r["day"]: r["at"] for r in sorted(names) if only in (None, r["day"])}


def judged_partition(spark: SparkSession, contract: Contract, path: str, partition: str, one_line: bool = False) -> DataFrame:
    """The rows of a partition's files, judged; refuses rows with more fields than columns."""
    names = files.header(spark, path)
    rows = files.refuse_long_rows(files.read_csv(spark, path, names, strict=False, one_line=one_line)).withColumn(judge.PARTITION, F.lit(partition))
    return judge.judged(rows, contract)


def quarantine(spark: SparkSession, contract: Contract, raw: str, out: str | None, only: str | None = None, between: tuple[str, str] | None = None) -> Run:
    """Judges every partition and, with ``out``, writes accepted and held rows and the reports: one plan for all days that have the same columns."""
    found = {d: p for d, p in partitions(spark, raw, only).items() if between is None or between[0] <= d <= between[1]}
    if not found:
        return Run(2, [f"no partitions under {raw}"])
    alike: dict[tuple[str, ...], dict[str, str]] = {}
    for day, path in found.items():
        alike.setdefault(tuple(files.header(spark, path)), {})[day] = path
    reports = {}
    for names, days in alike.items():
        rows = files.refuse_long_rows(files.read_days(spark, list(days.values()), list(names), strict=False))
        judged = judge.judged(rows, contract)
        reports |= split.write_days(judged, contract, days, out) if out else split.told(judged, contract, days)
    return Run(0, [f"{day}: {r['rows']} rows, {r['held']} held, share {r['held_share']}" for day, r in sorted(reports.items())])


def _days(spark: SparkSession, quarantined: str, only: str | None) -> list[str]:
    try:
        return list(partitions(spark, quarantined, only))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []


def _split(spark: SparkSession, contract: Contract, quarantined: str, days: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, held) rows of many days in one read each."""
    read = lambda side, names: files.read_days(spark, [f"{quarantined}/{d}/{side}" for d in days], names)
    return read("accepted", contract.names), read("quarantined", [*contract.names, split.REASONS])


def rejudged(spark: SparkSession, contract: Contract, quarantined: str, only: str | None = None) -> Run:
    """Judges held rows again; 1 if any would now be accepted, which under an unchanged contract is a defect."""
    days = _days(spark, quarantined, only)
    if not days:
        return Run(2, [f"nothing under {quarantined}"])
    again = rejudge.rejudge(*_split(spark, contract, quarantined, days), contract)
    by_day = {r[judge.PARTITION]: (r["held"], r["recovered"]) for r in again.groupBy(judge.PARTITION).agg(F.count("*").alias("held"), F.count_if(judge.clean(again)).alias("recovered")).collect()}  # a row a day
    lines = [f"{day}: {held} held, {recovered} recovered" for day in days for held, recovered in [by_day.get(day, (0, 0))]]
    lines += [f"{r['reason']} stopped firing on {r['rows']} rows" for r in rejudge.stopped(again).orderBy("reason").collect()]  # a row for each rule
    return Run(1 if any(recovered for _, recovered in by_day.values()) else 0, lines)


def marginal(spark: SparkSession, contract: Contract, quarantined: str, only: str | None = None) -> Run:
    """How many rows of the whole quarantine each constraint alone holds."""
    days = _days(spark, quarantined, only)
    if not days:
        return Run(2, [f"nothing under {quarantined}"])
    accepted, held = _split(spark, contract, quarantined, days)
    both = accepted.unionByName(held.drop(split.REASONS))
    table = rejudge.marginal(judge.judged(both, contract), contract).orderBy(F.desc("recovered"), "subject", "rule").collect()  # a row for each constraint
    return Run(0, [f"{r['subject']}:{r['rule']} {'n/a' if r['recovered'] is None else r['recovered']}" for r in table])


def _load(spark: SparkSession, raw_store: store.RawStore, quarantined: str, partition: str, manifest: DataFrame, now: datetime) -> int:
    directory = f"{quarantined}/{partition}"
    verdict = files.read_verdict(spark, directory, partition)
    accepted = files.read_csv(spark, f"{directory}/accepted", raw_store.contract.names)
    sha = files.digest_of(manifest, spark.createDataFrame([(partition,)], "partition string")).first()["sha256"]  # one row
    return raw_store.load(accepted, partition, verdict, sha or "", now)


def load(spark: SparkSession, contract: Contract, quarantined: str, path: str, manifest: DataFrame, now: datetime, only: str | None = None, twice: bool = False) -> Run:
    """Loads every judged partition, with ``twice`` again, which must change nothing but the stamp; 1 on a drift between table and ledger."""
    raw_store = store.RawStore(spark, path, contract)
    days = _days(spark, quarantined, only)
    if not days:
        return Run(2, [f"nothing under {quarantined}"])
    lines = [f"{day}: {_load(spark, raw_store, quarantined, day, manifest, now)} rows" for day in days]
    stamp = store.stamp(raw_store.table())
    if twice:
        for day in days:
            _load(spark, raw_store, quarantined, day, manifest, now)
        again = store.stamp(raw_store.table())
        lines.append(f"again: {stamp} and {again}")
        if again != stamp:
            return Run(1, lines)
    drift = raw_store.reconcile().count()
    return Run(1 if drift else 0, [*lines, stamp, f"{drift} partitions drifted"])


def backfill(spark: SparkSession, contract: Contract, quarantined: str, path: str, manifest: DataFrame, start: str, end: str, now: datetime, twice: bool = False) -> Run:
    """Loads a range of days in order, with ``twice`` again, which must change nothing but the stamp; 1 on a gap, a stop, a difference or a drift."""
    raw_store = store.RawStore(spark, path, contract)
    judged = spark.createDataFrame([(d,) for d in _days(spark, quarantined, None)], "partition string")
    one = lambda day: _load(spark, raw_store, quarantined, day, manifest, now)
    try:
        done = store.backfill(raw_store, start, end, judged, one)
        lines, same = [f"{len(done)} partitions", store.stamp(raw_store.table())], True
        if twice:
            store.backfill(raw_store, start, end, judged, one)
            lines.append(store.stamp(raw_store.table()))
            same = lines[-1] == lines[-2]
            lines.append("identical" if same else "DIFFERENT")
    except (MissingPartitions, BackfillStopped) as e:
        return Run(1, [f"{type(e).__name__}: {e}"])
    drift, orphans = raw_store.reconcile().count(), [r["_partition"] for r in raw_store.orphans(judged).collect()]  # a name a day
    return Run(1 if drift or not same else 0, [*lines, f"{drift} partitions drifted", *[f"{o} isn't in the source" for o in orphans]])


def probe(spark: SparkSession, contract: Contract, quarantined: str, path: str, manifest: DataFrame, now: datetime) -> Run:
    """What a backfill does when it runs twice, meets a gap, fails in the middle, and has a day that the source has no more, on stores of its own under path; 1 if any arm isn't as it should be."""
    days = _days(spark, quarantined, None)
    if len(days) < 3:
        return Run(2, [f"three judged partitions at least, {len(days)} under {quarantined}"])
    aside = f"{path.rstrip('/')}/probe-{uuid.uuid4().hex}"
    listed = lambda some: spark.createDataFrame([(d,) for d in some], "partition string")
    fresh = lambda name: store.RawStore(spark, f"{aside}/{name}", contract)
    loads = lambda s: lambda day: _load(spark, s, quarantined, day, manifest, now)
    lines, good = [], True

    def say(arm: str, ok: bool, what: str) -> None:
        nonlocal good
        good = good and ok
        lines.append(f"{arm}: {'ok' if ok else 'NOT OK'}, {what}")

    try:
        twice = fresh("twice")
        stamps = []
        for _ in range(2):
            store.backfill(twice, days[0], days[-1], listed(days), loads(twice))
            stamps.append(store.stamp(twice.table()))
        say("the same range twice", stamps[0] == stamps[1] and twice.ledger().count() == len(days), f"{stamps[0]} and {stamps[1]}")
        hole, gap = days[len(days) // 2], fresh("gap")
        try:
            store.backfill(gap, days[0], days[-1], listed([d for d in days if d != hole]), loads(gap))
            say("a range with a gap", False, "not refused")
        except MissingPartitions as e:
            say("a range with a gap", hole in str(e) and gap.ledger().isEmpty(), f"refused for {e}")
        broken = fresh("broken")

        def miscounted(day: str) -> None:
            if day != hole:
                _load(spark, broken, quarantined, day, manifest, now)
                return
            verdict = files.read_verdict(spark, f"{quarantined}/{day}", day)
            accepted = files.read_csv(spark, f"{quarantined}/{day}/accepted", contract.names)
            broken.load(accepted, day, verdict | {"accepted": verdict["accepted"] + 1}, "", now)

        try:
            store.backfill(broken, days[0], days[-1], listed(days), miscounted)
            say("a day that fails", False, "not stopped")
        except BackfillStopped as e:
            there = [r["_partition"] for r in broken.ledger().collect()]  # a name a day
            say("a day that fails", e.partition == hole and there == e.completed == days[: days.index(hole)] and broken.reconcile().isEmpty(), f"stopped at {e.partition} after {len(e.completed)}, {type(e.cause).__name__}")
        gone = fresh("gone")
        store.backfill(gone, days[0], days[-1], listed(days), loads(gone))
        store.backfill(gone, days[0], days[-2], listed(days[:-1]), loads(gone))
        left = [r["_partition"] for r in gone.orphans(listed(days[:-1])).collect()]  # a name a day
        say("a day that the source has no more", left == days[-1:] and gone.reconcile().isEmpty(), f"orphans {left}, no drift")
    finally:
        folders.remove(spark, aside)
    return Run(0 if good else 1, lines)


def pull(spark: SparkSession, get, contract: Contract, base: str, raw: str, manifest_path: str, start: str, days: int, size: int, now: datetime) -> Run:
    """Fetches days of a paged source into raw, a folder a day, and puts them into the manifest; a day that isn't whole stops before it is there."""
    column, key = contract.source["partition_column"], contract.columns[0].name
    known, lines = files.manifest(spark, manifest_path), []
    for i in range(days):
        day = date.fromisoformat(start) + timedelta(days=i)
        entry = api.fetch_day(spark, get, base, contract.names, column, key, day, raw, size, lambda: now)
        known = files.upsert(known, entry)
        r = entry.first()
        lines.append(f"{r['partition']} {r['rows']} rows {r['bytes']} bytes {r['sha256'][:12]}")
    entries = known.collect()  # a row a day
    files.save_manifest(spark.createDataFrame(entries, known.schema), manifest_path)
    return Run(0, [*lines, f"{len(entries)} partitions, {sum(r['rows'] for r in entries)} rows"])


def feed_checks(spark: SparkSession, contract: Contract, manifest: DataFrame, newest: DataFrame, now: datetime, reference: str | None = None, applies_to: str | None = None, holdout: int = 5) -> Run:
    """Freshness, volume, headroom and the floor that would be fitted; the overrides change the run, not the contract."""
    if manifest.isEmpty():
        return Run(2, ["no partitions"])
    both = feed.freshness(contract, manifest, newest, now, reference, applies_to).select("partition", "clause", "verdict").unionByName(feed.volume(contract, manifest).select("partition", "clause", "verdict"))
    lines = [f"{r['clause']} {r['verdict']}: {r['n']}" for r in both.groupBy("clause", "verdict").agg(F.count("*").alias("n")).orderBy("clause", "verdict").collect()]  # a row for each verdict
    lines.append(str(feed.headroom(manifest, contract.volume["min_rows_per_partition"]).first().asDict()))
    try:
        lines.append(str(feed.fit_floor(manifest, holdout).first().asDict()))
    except NothingChecked as e:
        lines.append(str(e))
    return Run(0, lines)


def breaks(spark: SparkSession, contract: Contract, rows: DataFrame, ordinal: str, count: int = 1, raw: DataFrame | None = None, now: datetime | None = None) -> Run:
    """Every break of the catalogue, and the partition replayed; 1 if one isn't caught by its rule, or is refused without it.  raw: the raw layer, for what two of the breaks do to the marts."""
    lines, bad = [], 0
    listed = {b.name: b for b in rejudge.CATALOGUE}
    found = {r["name"]: r for r in rejudge.outcomes(rows, contract, ordinal, rejudge.CATALOGUE, count).collect()}  # a row a break
    for name, b in listed.items():
        r = found[name]
        ok = r["new_holds"] == 0 if b.subject is None else r["caught"] == r["named"] == r["damaged"] and not r["control_holds"]
        bad += not ok
        lines.append(f"{name}: {'ok' if ok else 'NOT OK'} {r.asDict()}")
    twice = judge.judged(rejudge.repeated(rows, 2), contract)
    whole = twice.agg(*[c.alias(n) for n, c in judge.totals(twice, contract).items()]).first()
    lines.append(f"replayed: {whole['rows']} rows, {whole['held']} held, {whole['held_only_by_unique']} only by a key")
    if raw is not None:
        lines += [mart_arm(spark, contract, rows, ordinal, listed[name], count, raw, now) for name in ("unknown_borough", "wrong_agency")]
    return Run(1 if bad else 0, lines)


def mart_arm(spark: SparkSession, contract: Contract, rows: DataFrame, ordinal: str, b: rejudge.Break, count: int, raw: DataFrame, now: datetime | None) -> str:
    """What the gold tables say when a partition (the rows) is damaged, judged and put in place of its rows in raw: held rows leave the totals, mislabelled ones only move."""
    chosen = rejudge.targets(judge.judged(rows, contract), ordinal, count)
    hurt = judge.judged(rejudge.damaged(rows, folders.kept(chosen, "targets"), ordinal, b), contract)
    partitions_ = [r[judge.PARTITION] for r in rows.select(judge.PARTITION).distinct().collect()]  # a name a day
    accepted = split.accepted(hurt).drop(ordinal).withColumns({"_source_sha256": F.lit("break"), "_loaded_at": F.lit(now).cast("timestamp_ntz")})
    after = raw.where(~F.col(judge.PARTITION).isin(*partitions_)).unionByName(accepted.select(*[f"`{c}`" for c in raw.columns]))
    digest = lambda table: {r["table"]: (r["digest"], r["requests"]) for r in models.gold_digest(models.build(table, once=True)).collect()}
    was, now_ = digest(raw), digest(after)
    moved = sorted(t for t in was if was[t][0] != now_[t][0])
    return f"{b.name}: gold changed in {', '.join(moved) or 'nothing'}; " + "; ".join(f"{t} {was[t][1]} requests, then {now_[t][1]}" for t in sorted(was))


def profiled(spark: SparkSession, contract: Contract, raw: str, only: str | None = None) -> Run:
    """What fires over all partitions, by column rule and check, and hits by provenance."""
    found = partitions(spark, raw, only)
    if not found:
        return Run(2, [f"no partitions under {raw}"])
    both = files.read_days(spark, list(found.values()), files.header(spark, next(iter(found.values()))))
    judged = judge.judged(files.numbered(both), contract)
    tables = (profile.corpus(judged, contract, "_ordinal").orderBy(F.desc("failed")), profile.checks(judged, contract), profile.by_provenance(judged, contract))
    missing, more = judge.drift(both, contract)
    return Run(0, [*[str(r.asDict()) for t in tables for r in t.collect()], f"{profile.rules_run(contract) * len(found)} rules run", f"missing: {missing}", f"no contract: {more}"])  # a row for each rule


@dataclass
class Day:
    """One partition through the whole run."""

    partition: str
    report: dict
    loaded: int
    marts: dict[str, DataFrame]
    failing: list[str]


def history_of(spark: SparkSession, warehouse: str) -> history.StoredHistory:
    """The history of requests that runs keep."""
    return history.StoredHistory(spark, f"{warehouse}/history", "unique_key", ["status", "closed_at"])


def modelled(spark: SparkSession, contract: Contract, warehouse: str, now: datetime) -> tuple[dict[str, DataFrame], list[str]]:
    """Builds the models over what is loaded, takes it into the history and runs every data test: the models, and the tests that fail."""
    raw_store = store.RawStore(spark, warehouse, contract)
    built = models.materialize(raw_store.table(), f"{warehouse}/models")
    history_of(spark, warehouse).run(models.history_source(built["stg_requests"]), now)
    tested = data_tests.run(built | {"ledger": raw_store.ledger()}, contract).where("violations > 0").collect()  # a row a test
    return built, sorted(f"{r['relation']} {r['column']} {r['kind']}: {r['violations']}" for r in tested)


def run_partition(spark: SparkSession, contract: Contract, raw: str, quarantined: str, warehouse: str, partition: str, manifest: DataFrame, now: datetime) -> Day:
    """judge, split, load, model, keep the history of and test one partition; a refusal anywhere stops the run before what comes after it."""
    found = partitions(spark, raw, partition)
    if partition not in found:
        raise UnjudgedPartition(f"{partition} isn't under {raw}")
    report = split.write(judged_partition(spark, contract, found[partition], partition), contract, partition, f"{quarantined}/{partition}", found[partition])
    loaded = _load(spark, store.RawStore(spark, warehouse, contract), quarantined, partition, manifest, now)
    built, failing = modelled(spark, contract, warehouse, now)
    return Day(partition, report, loaded, {n: df for n, df in built.items() if n.startswith("gold")}, failing)


def run_range(spark: SparkSession, contract: Contract, raw: str, quarantined: str, warehouse: str, start: str, end: str, manifest: DataFrame, now: datetime) -> Run:
    """Judges every day of a range, backfills it, models what is loaded and tests it; 1 on a gap, a stop, a drift or a test that fails."""
    judged = quarantine(spark, contract, raw, quarantined, between=(start, end))
    if judged.code:
        return judged
    loaded = backfill(spark, contract, quarantined, warehouse, manifest, start, end, now)
    if loaded.code:
        return Run(loaded.code, judged.lines + loaded.lines)
    failing = modelled(spark, contract, warehouse, now)[1]
    return Run(1 if failing else 0, [*judged.lines, *loaded.lines, f"{len(failing)} data tests fail", *failing])
