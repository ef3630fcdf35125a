"""Whole runs over folders of CSV partitions, and their exit codes."""

import ast
import json
from datetime import date, datetime
from pathlib import Path

import pytest
import yaml
from pyspark.sql import functions as F

from tests.test_judge import BASE
from tollgate import __main__ as cli
from tollgate import contract as contracts
from tollgate import refusals, runs
from tollgate.operators import checks, diff, judge
from tollgate.plans import models
from tollgate.refusals import ContentMismatch, LoadCountMismatch
from tollgate.sinks import store
from tollgate.sources import api, files

NOW = datetime(2025, 1, 15, 12)
DAYS = {"2025-01-01": "a,1,open,x\nb,11,open,x\nc,,shut,\n", "2025-01-02": 'd,2,shut,"two, fields"\ne,3,ajar,\n', "2025-01-03": "f,4,open,\n"}


@pytest.fixture
def here(tmp_path):
    (tmp_path / "contract.yml").write_text(yaml.safe_dump(BASE))
    (tmp_path / "raw").mkdir()
    for day, text in DAYS.items():
        (tmp_path / "raw" / f"created_date={day}.csv").write_text("k,n,state,memo\n" + text)
    entries = [{"partition": d, "rows": len(t.splitlines()), "expected_rows": 0, "bytes": 0, "sha256": d * 2, "path": d} for d, t in DAYS.items()]
    (tmp_path / "manifest.json").write_text(json.dumps({"partitions": entries}))
    return tmp_path


def run(spark, here, *args):
    paths = [f"--{n}={here / f}" for n, f in (("contract", "contract.yml"), ("raw", "raw"), ("quarantine", "held"), ("store", "store"), ("manifest", "manifest.json"))]
    return cli.main([*args, *paths], spark, NOW)


def test_from_raw_to_the_store(spark, here, capsys):
    assert run(spark, here, "rejudge") == 2 and run(spark, here, "load") == 2
    assert run(spark, here, "quarantine") == 0 and not (here / "held").exists()
    assert run(spark, here, "quarantine", "--write") == 0
    report = json.loads((next((here / "held/2025-01-01/report.json").glob("part-*"))).read_text())
    assert (report["rows"], report["held"], report["held_share"], report["largest_key_collision"]) == (3, 2, 0.666667, 1)
    assert report["by_rule"] == [{"subject": "check", "rule": "shut_has_n", "rows": 1}, {"subject": "n", "rule": "max", "rows": 1}]
    assert report["rows_each_check_could_judge"] == {"shut_has_n": 1} and report["contracted_columns_absent"] == []
    assert run(spark, here, "rejudge") == 0 and run(spark, here, "marginal") == 0
    capsys.readouterr()
    assert run(spark, here, "load", "--twice") == 0
    assert "2025-01-01: 1 rows" in capsys.readouterr().out
    raw = store.RawStore(spark, f"{here}/store", contracts.parse(BASE)).table()
    assert {(r.k, r._source_sha256) for r in raw.collect()} == {("a", "2025-01-01" * 2), ("d", "2025-01-02" * 2), ("f", "2025-01-03" * 2)}
    assert run(spark, here, "backfill", "--start=2025-01-01", "--end=2025-01-03", "--twice") == 0
    assert "identical" in capsys.readouterr().out
    assert run(spark, here, "probe") == 0
    out = capsys.readouterr().out
    assert out.count(": ok, ") == 4 and "refused for 2025-01-02" in out and "stopped at 2025-01-02 after 1, LoadCountMismatch" in out and "orphans ['2025-01-03']" in out
    assert run(spark, here, "backfill", "--start=2025-01-01", "--end=2025-01-04") == 1
    assert files.read_held(spark, f"{here}/held", contracts.parse(BASE)).groupBy("_partition").count().orderBy("_partition").collect() == [("2025-01-01", 2), ("2025-01-02", 1)]


def test_a_changed_contract_recovers_rows(spark, here, capsys):
    run(spark, here, "quarantine", "--write")
    looser = BASE | {"columns": [c | {"max": 20} if c["name"] == "n" else c for c in BASE["columns"]]}
    (here / "contract.yml").write_text(yaml.safe_dump(looser))
    capsys.readouterr()
    assert run(spark, here, "rejudge") == 1
    assert "n:max stopped firing on 1 rows" in capsys.readouterr().out


def test_other_runs(spark, here, capsys):
    for name in ("profile", "feed", "damage"):
        assert run(spark, here, name) == 0, name
    assert run(spark, here, "lineage") == 0
    capsys.readouterr()
    assert run(spark, here, "generate") == 0
    text = capsys.readouterr().out
    (here / "tests.yml").write_text(text)
    assert run(spark, here, "generate", f"--check={here}/tests.yml") == 0
    (here / "tests.yml").write_text(text.replace("not_null", "nothing"))
    assert run(spark, here, "generate", f"--check={here}/tests.yml") == 1
    assert checks.drifted(contracts.parse(BASE), "raw", text) == []
    assert cli.main(["profile", f"--contract={here}/contract.yml", f"--raw={here}/raw", "--partition=1999-01-01"], spark, NOW) == 2


def test_rows_with_more_fields_are_refused_and_short_ones_are_not(spark, tmp_path):
    for name, text in (("short", "a,1\nb,2,open,x\n"), ("long", "a,1,open,x,more\n"), ("comma", "a,1,open,x,\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "day.csv").write_text("k,n,state,memo\n" + text)
        rows = files.read_csv(spark, str(tmp_path / name), ["k", "n", "state", "memo"], strict=False)
        if name == "short":
            assert sorted((r.k, r.memo) for r in files.refuse_long_rows(rows).collect()) == [("a", None), ("b", "x")]
        else:
            with pytest.raises(ContentMismatch):
                files.refuse_long_rows(rows)


def test_headers_are_read_as_csv_and_lines_can_be_split(spark, tmp_path):
    (tmp_path / "b.csv").write_text('"k, the key",n\n1,2\n3,4\n')
    assert files.header(spark, str(tmp_path)) == ["k, the key", "n"]
    got = files.read_csv(spark, str(tmp_path), ["k, the key", "n"], one_line=True)
    assert sorted(map(tuple, got.collect())) == [("1", "2"), ("3", "4")]


def test_damage_by_column_and_mixed_files(spark, tmp_path):
    (tmp_path / "1.csv").write_text("day,zip,n\n2025-01-01,10001,1\n2025-01-01,10002,2\n")
    (tmp_path / "2.csv").write_text("day,zip,n\n2025-01-02,00083,x\n2025-01-02,10004,4\n")
    paths = [str(tmp_path / f"{i}.csv") for i in (1, 2)]
    out = {r.column: (r.type, r.changed) for r in files.inference_damage(spark, paths, ["day", "zip", "n"]).collect()}
    assert out["zip"] == ("int", 1) and out["n"] == ("int", 1) and out["day"][1] == 0
    with pytest.raises(ContentMismatch):
        files.refuse_mixed(spark, paths)
    assert files.refuse_mixed(spark, paths[:1])["zip"] == "int"


def test_a_fetched_day_and_its_manifest(spark, tmp_path):
    def get(url):
        if "count" in url:
            return [{"n": "5"}]
        at = int(url.split("offset=")[1])
        return [{"k": str(i), "ts": "t"} for i in range(at, min(5, at + 2))]

    entry = api.fetch_day(spark, get, "http://x", ["k", "ts"], "ts", "k", date(2025, 1, 1), str(tmp_path), 2, lambda: NOW)
    r = entry.first()
    assert (r.partition, r.rows, r.expected_rows, r.fetched_at) == ("2025-01-01", 5, 5, "2025-01-15T12:00:00") and r.bytes > 0 and len(r.sha256) == 64
    files.save_manifest(entry, f"{tmp_path}/manifest")
    again = files.manifest(spark, f"{tmp_path}/manifest")
    assert again.collect() == entry.collect()
    asked = spark.createDataFrame([("2025-01-01",), ("2025-01-02",)], "partition string")
    assert {x.partition: x.sha256 for x in files.digest_of(again, asked).collect()} == {"2025-01-01": r.sha256, "2025-01-02": None}


def test_a_recorded_diff_is_replayed(spark, tmp_path):
    before = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), ("c", "3", "z")], "key string, n string, s string")
    after = spark.createDataFrame([("a", "1", "x"), ("b", "9", None), ("d", "4", "w")], "key string, n string, s string")
    diff.save(diff.recorded(before, after, "key", "2025-01-01"), f"{tmp_path}/diff")
    stored = diff.load(spark, f"{tmp_path}/diff")
    assert stored.groupBy("kind").count().orderBy("kind").collect() == [("added", 1), ("changed", 2), ("removed", 1), ("rows_after", 1), ("rows_before", 1)]
    assert sorted(map(tuple, diff.replayed(before, stored, "key").collect())) == [("a", "1", "x"), ("b", "9", "")]
    with pytest.raises(LoadCountMismatch):
        diff.replayed(before.limit(2), stored, "key")


def requests(here):
    head = "unique_key,created_date,closed_date,agency,complaint_type,descriptor,incident_zip,borough,status,latitude,longitude\n"
    (here / "raw311").mkdir()
    for day in ("2025-01-01", "2025-01-02"):
        rows = [f"{day[-1]}{i},{day}T00:0{i % 9}:00.000,{day}T09:00:00.000,NYPD,Noise,,10001,QUEENS,Closed,40.7,-73.9" for i in range(20)]
        (here / "raw311" / f"{day}.csv").write_text(head + "\n".join(rows) + "\n")
    return contracts.load(str(Path(models.__file__).parent / "service_requests.yml"))


def test_one_partition_through_everything_and_the_catalog(spark, here):
    contract = requests(here)
    known = spark.createDataFrame([("2025-01-01", "f" * 64)], "partition string, sha256 string")
    day = runs.run_partition(spark, contract, f"{here}/raw311", f"{here}/q", f"{here}/w", "2025-01-01", known, NOW)
    assert (day.report["rows"], day.loaded, day.failing) == (20, 20, [])
    assert day.marts["gold_agency_daily"].first().request_count == 20
    whole = runs.run_range(spark, contract, f"{here}/raw311", f"{here}/q", f"{here}/w", "2025-01-01", "2025-01-02", known, NOW)
    assert whole.code == 0 and "2 partitions" in whole.lines
    assert "0 data tests fail" in whole.lines
    raw = store.RawStore(spark, f"{here}/w", contract).table()
    try:
        spark.sql("create database gold_dev")
        raw.limit(3).selectExpr("unique_key", "1L as request_count").write.saveAsTable("gold_dev.gold_agency_daily")
        assert sorted(models.published_gold(spark)) == ["gold_dev.gold_agency_daily"]
        spark.sql("drop database gold_dev cascade")
        built = models.publish(raw)
        assert models.table_name("dim_complaint_type") == "silver.dim_complaint_type"
        digest = {r.table: (r.rows, r.requests) for r in models.gold_digest(models.published_gold(spark)).collect()}
        assert digest == {"gold.gold_agency_daily": (2, 40), "gold.gold_complaint_resolution": (1, 40)} and built["slv_requests"].count() == 40
    finally:
        for name in ("gold", "gold_dev", "silver"):
            spark.sql(f"drop database if exists {name} cascade")
    with pytest.raises(refusals.Refusal):
        models.published_gold(spark)


def test_breaks_run(spark, here):
    contract = requests(here)
    read = files.numbered(files.read_csv(spark, f"{here}/raw311/2025-01-01.csv", contract.names), "_i")
    rows = read.withColumn("_partition", F.lit("2025-01-01"))
    meta = {"_source_sha256": F.lit("0"), "_loaded_at": F.lit(NOW).cast("timestamp_ntz")}
    raw = rows.drop("_i").withColumns(meta).unionByName(rows.drop("_i").withColumns(meta).withColumns({"_partition": F.lit("2025-01-02"), "unique_key": F.concat(F.lit("x"), "unique_key")}))
    done = runs.breaks(spark, contract, rows, "_i", 2, raw, NOW)
    assert done.code == 0 and len(done.lines) == 11 + 1 + 2
    assert done.lines[11] == "replayed: 40 rows, 40 held, 40 only by a key"
    assert done.lines[12] == "unknown_borough: gold changed in gold_agency_daily, gold_complaint_resolution; gold_agency_daily 40 requests, then 38; gold_complaint_resolution 40 requests, then 38"
    assert "gold_agency_daily 40 requests, then 40" in done.lines[13] and "gold changed in gold_agency_daily" in done.lines[13]


def test_every_refusal_is_raised_somewhere():
    names = {n for n, x in vars(refusals).items() if isinstance(x, type) and issubclass(x, refusals.Refusal) and x is not refusals.Refusal}
    raised = set()
    for path in (Path(refusals.__file__).parent).rglob("*.py"):
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Raise) and isinstance(node.exc, ast.Call) and isinstance(node.exc.func, ast.Name):
                raised.add(node.exc.func.id)
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id == "_must":
                raised.add("ContractError")
    assert len(names) == 17 and names <= raised


def test_days_are_judged_in_one_evaluation(spark, here):
    """However many days, the judgement is in one job's plan: everything else reads what that job wrote."""
    contract, seen = contracts.parse(BASE), []

    class Listener:
        class Java:
            implements = ["org.apache.spark.sql.util.QueryExecutionListener"]

        def onSuccess(self, name, execution, nanos):
            seen.append(execution.optimizedPlan().toString())

        def onFailure(self, name, execution, error):
            pass

    gateway = spark.sparkContext._gateway
    from pyspark.java_gateway import ensure_callback_server_started

    ensure_callback_server_started(gateway)
    listener = Listener()
    spark._jsparkSession.listenerManager().register(listener)
    try:
        assert runs.quarantine(spark, contract, f"{here}/raw", f"{here}/out").code == 0
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark._jsparkSession.listenerManager().unregister(listener)
    # plans that judge name the columns that a judgement reads texts into; the reports and both sides are of what is stored
    assert sum("__text_" in p for p in seen) == 1 and len(seen) > 3
    for day, text in DAYS.items():
        report = json.loads((next((here / f"out/{day}/report.json").glob("part-*"))).read_text())
        accepted, held = files.read_split(spark, f"{here}/out/{day}", contract, day)
        assert (report["rows"], report["accepted"], report["held"]) == (len(text.splitlines()), accepted.count(), held.count())
    assert not list((here / "out").glob("_aside*"))


def test_days_with_other_columns_are_judged_apart(spark, here):
    (here / "raw" / "created_date=2025-01-04.csv").write_text("k,n,extra\ng,1,z\ng,99,z\n")
    done = runs.quarantine(spark, contracts.parse(BASE), f"{here}/raw", f"{here}/out")
    assert done.lines[-1] == "2025-01-04: 2 rows, 2 held, share 1.0" and len(done.lines) == 4
    report = json.loads((next((here / "out/2025-01-04/report.json").glob("part-*"))).read_text())
    assert report["contracted_columns_absent"] == ["state", "memo"] and report["columns_with_no_contract"] == ["extra"] and report["largest_key_collision"] == 2
    assert runs.rejudged(spark, contracts.parse(BASE), f"{here}/out", "2025-01-03").lines == ["2025-01-03: 0 held, 0 recovered"]


def test_two_extracts_through_runs_are_kept_as_history(spark, here, monkeypatch):
    from tollgate.operators import history
    from tollgate.sinks.commits import Commits

    contract = requests(here)
    known = spark.createDataFrame([("2025-01-01", "f" * 64)], "partition string, sha256 string")
    go = lambda day, at: runs.run_partition(spark, contract, f"{here}/raw311", f"{here}/q", f"{here}/w", day, known, datetime(2025, 2, at))
    go("2025-01-01", 1)
    stored = runs.history_of(spark, f"{here}/w")
    first = sorted(map(tuple, stored.table().collect()))
    text = (here / "raw311/2025-01-01.csv").read_text().splitlines()
    (here / "raw311/2025-01-01.csv").write_text("\n".join([text[0], text[1].replace("T09:00", "T10:30"), text[2].replace(",Closed,", ",Open,").replace("2025-01-01T09:00:00.000", ""), *text[3:]]) + "\n")
    commit, calls = Commits.commit, []

    def dies(self, seen, state):
        calls.append(self.path)
        if self.path.endswith("history/commits"):
            raise KeyboardInterrupt
        return commit(self, seen, state)

    monkeypatch.setattr(Commits, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        go("2025-01-01", 2)
    monkeypatch.setattr(Commits, "commit", commit)
    assert sorted(map(tuple, stored.table().collect())) == first
    go("2025-01-01", 3)
    stg = lambda raw: models.history_source(models.staging(raw))
    at = lambda d: F.lit(f"2025-02-0{d} 00:00:00").cast("timestamp_ntz")
    raw = store.RawStore(spark, f"{here}/w", contract)
    old = history.snapshot(None, stg(raw.table(version=1)), "unique_key", ["status", "closed_at"], at(1))
    want = history.snapshot(old, stg(raw.table()), "unique_key", ["status", "closed_at"], at(3))
    assert sorted(map(str, stored.table().collect())) == sorted(map(str, want.collect()))
    assert history.version_summary(stored.table(), "unique_key").first().asDict() == {"versions": 22, "keys": 20, "current": 20, "superseded": 2}
    assert len(stored.vacuum()) == 1 and stored.table().count() == 22
