"""Diffs, history, partition clauses, models and the stream: small fixtures with known answers."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_judge import BASE
from tollgate import contract as contracts
from tollgate.operators import diff, feed, history, quantiles
from tollgate.plans import models
from tollgate.refusals import ContentMismatch, LoadCountMismatch, NoHistory, NothingChecked, Refusal
from tollgate.streaming.judged import judge_stream

CONTRACT = contracts.parse(BASE)
ROWS = "key string, status string, closed string"
BEFORE = [("1", "Open", None), ("2", "Open", ""), ("3", "Shut", "x"), ("4", "Open", None)]
AFTER = [("1", "Shut", "y"), ("2", "Open", None), ("3", "Shut", "z"), ("5", "Open", None)]


@pytest.fixture(scope="module")
def two(spark):
    return spark.createDataFrame(BEFORE, ROWS), spark.createDataFrame(AFTER, ROWS)


def at(day):
    return F.lit(f"2025-01-0{day} 00:00:00").cast("timestamp_ntz")


def test_cells(two):
    moved = diff.cells(*two, "key")
    assert sorted(tuple(r) for r in moved.collect()) == [("1", "closed", "", "y"), ("1", "status", "Open", "Shut"), ("3", "closed", "x", "z")]
    assert {r.column: (r.cells, r.rows) for r in diff.counters(moved, "key").collect()} == {"closed": (2, 2), "status": (1, 1)}
    assert sorted(tuple(r) for r in diff.added_removed(*two, "key").collect()) == [("4", "removed"), ("5", "added")]
    same = diff.cells(two[0], two[0], "key")
    assert same.count() == 0
    with pytest.raises(NothingChecked):
        diff.cells(two[0].limit(0), two[1].limit(0), "key")
    assert diff.cells(two[0].limit(0), two[1], "key").count() == 0


def test_replay(spark, two):
    before, after = two
    moved, gone = diff.cells(before, after, "key"), diff.added_removed(before, after, "key").where("state = 'removed'")
    got = sorted((r.key, r.status, r.closed or "") for r in diff.applied(before, moved, gone, "key", 4).collect())
    assert got == [(k, s, c or "") for k, s, c in AFTER if k != "5"]
    with pytest.raises(LoadCountMismatch):
        diff.applied(before, moved, gone, "key", 5)
    with pytest.raises(ContentMismatch):
        diff.applied(before.where("key <> '1'"), moved, gone, "key")
    with pytest.raises(ContentMismatch):
        diff.applied(before.withColumn("status", F.lit("Other")), moved, gone, "key")


def test_the_last_duplicate_wins(spark):
    rows = spark.createDataFrame([("a", "1", 0), ("a", "2", 1), ("b", "3", 2)], "key string, v string, i int")
    assert sorted((r.key, r.v) for r in diff.keyed(rows, "key", "i").collect()) == [("a", "2"), ("b", "3")]
    with pytest.raises(NothingChecked):
        diff.keyed(rows, "other")


def test_multisets(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "v string") for v in (["x", "x", None, "y"], ["x", None, None, "z"]))
    assert sorted((r.side, r.v or "") for r in diff.multiset_difference(a, b).collect()) == [("first", "x"), ("first", "y"), ("second", ""), ("second", "z")]
    assert diff.null_safe_counts(a, b, "v").first().differing == 2


def test_multisets_are_read_and_shuffled_once(spark):
    a, b = (spark.range(1000).selectExpr("cast(id % 7 as string) as v", f"id % {m} as w") for m in (5, 6))
    out = diff.multiset_difference(a, b)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    want = a.exceptAll(b).selectExpr("'first' as side", "*").union(b.exceptAll(a).selectExpr("'second' as side", "*"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect())) and diff.uneven_rows(a, b) == want.count()
    assert plan.count("Range") == 2
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2  # the plan and its first form


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_are_exact(spark, seed):
    import random

    rnd = random.Random(seed)
    value = lambda: rnd.choice([None, 0.0, 5e-324, rnd.random(), -rnd.random() * 1e6, 1e300, float(rnd.randrange(9)), rnd.gauss(0, 1)])
    rows = spark.createDataFrame([(rnd.choice(["a", "b", None]), rnd.randrange(40) // 39, value()) for _ in range(1500)] + [("none", 1, None), ("one", 1, 3.5)], "g string, h int, v double").repartition(5)
    wanted = {"low": 0.0, "q": 0.25, "mid": 0.5, "p90": 0.9, "top": 1.0}
    got = {(r.g, r.h): [r[n] for n in wanted] for r in quantiles.quantiles(rows, ["g", "h"], "v", wanted).collect()}
    plain = rows.where("v is not null").groupBy("g", "h").agg(*[F.percentile("v", p).alias(n) for n, p in wanted.items()]).collect()
    assert got == {(r.g, r.h): [r[n] for n in wanted] for r in plain} and ("one", 1) in got and ("none", 1) not in got
    groups = rows.groupBy("g", "h").agg(F.count("*").alias("n"))
    both = {(r.g, r.h): (r.n, r.mid) for r in quantiles.with_quantiles(groups, rows, ["g", "h"], "v", {"mid": 0.5}).collect()}
    assert len(both) == groups.count() and both["none", 1] == (1, None)


def test_bins_never_fall(spark):
    values = sorted([0.0, -0.0, 5e-324, 1e-300, 1e-5, 0.5, 1 - 2**-53, 1.0, 1.0000001, 2.0, 1e18, 1.7e308, float("inf")] + [x / 7 for x in range(50)])
    df = spark.createDataFrame([(x,) for x in [*(-v for v in reversed(values)), *values]], "v double")
    found = [r.b for r in df.select("v", quantiles.bin_of(F.col("v")).alias("b")).collect()]
    assert found == sorted(found)
    assert spark.createDataFrame([(float("nan"),)], "v double").select(quantiles.bin_of(F.col("v")).alias("b")).first().b > found[-1]


def test_marts_have_no_buffer_of_values():
    from pathlib import Path

    text = (Path(models.__file__)).read_text() + Path(quantiles.__file__).read_text()
    assert not any(f"F.{x}(" in text for x in ("median", "percentile", "collect_list"))


def test_every_data_test_of_a_relation_is_one_pass(spark):
    from tollgate import queries
    from tollgate.operators import checks
    from tollgate.plans import data_tests

    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", None), (None, "z", 2), (None, "z", 2), ("b", None, 2)], "k string, s string, n int")
    tests = [checks.Test("k", "not_null"), checks.Test("k", "unique"), checks.Test("s", "accepted_values", ("x",)), checks.Test("n", "unique"), checks.Test("n", "not_null"), checks.Test("s", "accepted_values", ("x", "y", "z"))]
    out = {(r.column, r.kind, r.violations) for r in checks.run_all("t", rows, tests).collect()}
    assert out == {("k", "not_null", 2), ("k", "unique", 1), ("s", "accepted_values", 2), ("n", "unique", 1), ("n", "not_null", 1), ("s", "accepted_values", 0)}
    assert out == {(t.column, t.kind, t.run(rows).count()) for t in tests}
    assert sum(len(t) for t in data_tests.tests(queries.shipped_contract()).values()) + 2 == 30
    assert {r.violations for r in checks.run_all("t", rows.limit(0), tests).collect()} == {0}


def test_stored_history_grows_by_parts(spark, two, tmp_path):
    before, after = two
    stored = history.StoredHistory(spark, str(tmp_path), "key", ["status", "closed"], fanout=2)
    with pytest.raises(NoHistory):
        stored.table()
    want = None
    extracts = [before, after, before, after, after.limit(0), before]
    for i, extract in enumerate(extracts, 1):
        stored.run(extract, datetime(2025, 1, i))
        want = history.snapshot(want, extract, "key", ["status", "closed"], at(i))
        assert sorted(map(str, stored.table().collect())) == sorted(map(str, want.collect()))
        assert len(stored.commits.latest()[1]["closed"]) <= 2
    gone = stored.vacuum()
    assert sorted(map(str, stored.table().collect())) == sorted(map(str, want.collect())) and isinstance(gone, list)


def test_day_counts(spark):
    rows = spark.createDataFrame([("2025-01-01T10:00:00.000",), ("2025-01-01 23:59:59",), ("2025-01-02T00:00:00",), ("soon",), (None,)], "ts string")
    assert sorted(map(tuple, feed.day_counts(rows, "ts").collect())) == [("2025-01-01", 2, datetime(2025, 1, 1, 23, 59, 59)), ("2025-01-02", 1, datetime(2025, 1, 2))]


def test_history(spark, two):
    before, after = two
    first = history.snapshot(None, before, "key", ["status", "closed"], at(1))
    second = history.snapshot(first, after, "key", ["status"], at(2))
    assert history.version_summary(second, "key").first().asDict() == {"versions": 6, "keys": 5, "current": 5, "superseded": 1}
    many = history.keys_with_history(second, "key").collect()
    assert [(r.key, r.status, r.valid_to is None) for r in many] == [("1", "Open", False), ("1", "Shut", True)]
    assert many[0].valid_to == many[1].valid_from == datetime(2025, 1, 2)
    assert history.snapshot(second, after, "key", ["status"], at(3)).count() == 6
    assert history.wrong_current(second, "key").count() == 0
    closed = second.withColumn("valid_to", F.when(F.col("key") == "2", at(4)).otherwise(F.col("valid_to"))).union(second.where("key = '3'"))
    assert sorted((r.key, r.current) for r in history.wrong_current(closed, "key").collect()) == [("2", 0), ("3", 2)]
    with pytest.raises(NoHistory):
        history.version_summary(second.limit(0), "key")


def entries(spark, rows):
    return spark.createDataFrame(rows, "partition string, rows long, fetched_at string")


def test_freshness(spark):
    manifest = entries(spark, [("2025-01-01", 5, "2025-01-03T10:00:00"), ("2025-01-02", 5, "2025-01-04T10:00:01"), ("2025-01-03", 5, None), ("2025-01-04", 5, "2025-01-05T00:00:00")])
    newest = spark.createDataFrame([("2025-01-01", datetime(2025, 1, 1, 10)), ("2025-01-02", datetime(2025, 1, 2, 10)), ("2025-01-03", datetime(2025, 1, 3, 10))], "_partition string, newest timestamp_ntz")
    verdicts = lambda *a: {r.partition[-1]: r.verdict for r in feed.freshness(CONTRACT, manifest, newest, datetime(2025, 1, 5, 12), *a).collect()}
    assert verdicts("extract", "all") == {"1": "ok", "2": "stale", "3": "no_extract_time", "4": "no_events"}
    assert verdicts("extract", "tail") == {"1": "not_applicable", "2": "not_applicable", "3": "not_applicable", "4": "no_events"}
    assert verdicts("partition_end", "all") == {"1": "ok", "2": "ok", "3": "ok", "4": "no_events"}
    assert verdicts("wall_clock", "all")["3"] == "stale"
    odd = entries(spark, [("2025-01-01", 5, "yesterday")])
    assert feed.freshness(CONTRACT, odd, newest, datetime(2025, 1, 5), "extract", "all").first().verdict == "no_extract_time"


def test_volume_and_floor(spark):
    manifest = entries(spark, [(f"2025-01-{i:02d}", n, None) for i, n in enumerate([10, 12, 11, 13, 9, 2, 12], 1)])
    assert [r.partition for r in feed.volume(CONTRACT, manifest, 9).where("verdict = 'below_floor'").collect()] == ["2025-01-06"]
    head = feed.headroom(manifest, 3).first()
    assert (head.gap, head.can_bind, head.partitions) == (-1, True, 7)
    fit = feed.fit_floor(manifest, 2, 3.0).first()
    assert (fit.median, fit.mad, fit.floor, fit.train, fit.test, fit.fires, fit.rate, fit.degenerate) == (11.0, 1.0, 8.0, 5, 2, 1, 0.5, False)
    for refused in (lambda: feed.fit_floor(manifest, 7), lambda: feed.headroom(manifest.limit(0), 3)):
        with pytest.raises(NothingChecked):
            refused()


def test_layers():
    assert models.layers() == [["raw"], ["stg_requests"], ["slv_requests"], ["dim_complaint_type", "gold_agency_daily"], ["gold_complaint_resolution"]]
    with pytest.raises(Refusal):
        models.layers({"a": (("nobody",), None)})
    with pytest.raises(Refusal):
        models.layers({"a": (("b",), None), "b": (("a",), None)})


def test_marts_are_written_and_digested(spark, tmp_path):
    from tollgate import queries

    raw = queries.raw(spark, "/root/testdata/sf0.001")
    built = models.materialize(raw, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["dim_complaint_type", "gold_agency_daily", "gold_complaint_resolution", "slv_requests"]
    assert [r.table for r in models.gold_digest(built).collect()] == ["gold_agency_daily", "gold_complaint_resolution"]
    assert built["gold_agency_daily"].agg(F.sum("request_count")).first()[0] == raw.count()
    with pytest.raises(Refusal):
        models.gold_digest({"slv_requests": built["slv_requests"]})


def test_stream_gives_what_a_batch_gives(spark, tmp_path):
    schema = "_partition string, k string, n string, state string, memo string"
    for day in ("a", "b"):
        rows = [(day, k, n, "open", None) for k, n in (("1", "1"), ("2", "99"), ("3", "5"), ("3", "6"))]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / day))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        judge_stream(stream, CONTRACT, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination(120)
        held = spark.read.parquet(str(tmp_path / "out" / "quarantined"))
        assert sorted((r._partition, r.k) for r in held.collect()) == [(d, k) for d in "ab" for k in "233"]
        assert spark.read.parquet(str(tmp_path / "out" / "accepted")).count() == 2
