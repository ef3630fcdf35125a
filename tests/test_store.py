"""The raw layer, sources and splits on disk, and what they refuse."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.test_judge import BASE, frame, sample
from tollgate import contract as contracts
from tollgate.operators import judge, split
from tollgate.refusals import BackfillStopped, CommitConflict, HeaderMismatch, IncompletePartition, LoadCountMismatch, MetadataColumnClash, MissingPartitions, NoQuarantine, NothingChecked, UnjudgedPartition, UnknownDialect, WrongPartition
from tollgate.sinks import commits, store
from tollgate.sources import api, files, paged

CONTRACT = contracts.parse(BASE)
NOW = datetime(2025, 1, 15, 12)
SCHEMA = "k string, n string, state string, memo string"


def rows(spark, *keys):
    return spark.createDataFrame([(k, "1", "open", None) for k in keys], SCHEMA)


@pytest.fixture
def raw(spark, tmp_path):
    return store.RawStore(spark, str(tmp_path), CONTRACT)


def put(raw, partition, *keys, held=0):
    return raw.load(rows(raw.spark, *keys), partition, {"accepted": len(keys), "held": held}, "0" * 64, NOW)


def test_load_twice_leaves_one_copy_and_others_alone(raw):
    put(raw, "2025-01-01", "00083", "b", "b", held=2)
    put(raw, "2025-01-02", "c")
    before = store.stamp(raw.table())
    put(raw, "2025-01-01", "00083", "b", "b", held=2)
    assert store.stamp(raw.table()) == before
    assert raw.reconcile().count() == 0
    assert {r._partition: (r.rows_loaded, r.rows_held) for r in raw.ledger().collect()} == {"2025-01-01": (3, 2), "2025-01-02": (1, 0)}
    put(raw, "2025-01-01", "00083")
    assert store.stamp(raw.table()) != before
    assert sorted(r.k for r in raw.table().collect()) == ["00083", "c"]


def test_a_refused_load_leaves_what_was_there(raw):
    put(raw, "2025-01-01", "a", "b")
    before = store.stamp(raw.table())
    with pytest.raises(LoadCountMismatch):
        raw.load(rows(raw.spark, "x"), "2025-01-01", {"accepted": 2, "held": 0}, "1" * 64, NOW)
    with pytest.raises(HeaderMismatch):
        raw.load(rows(raw.spark, "x").select("n", "k", "state", "memo"), "2025-01-01", {"accepted": 1, "held": 0}, "1" * 64, NOW)
    assert store.stamp(raw.table()) == before


def test_an_empty_reload_leaves_no_old_rows(raw):
    put(raw, "2025-01-01", "a", "b", "c")
    put(raw, "2025-01-02", "d")
    put(raw, "2025-01-01", held=3)
    assert [r.k for r in raw.table().collect()] == ["d"]
    assert {r._partition: (r.rows_loaded, r.rows_held) for r in raw.ledger().collect()} == {"2025-01-01": (0, 3), "2025-01-02": (1, 0)}
    assert raw.reconcile().count() == 0
    put(raw, "2025-01-01", "e")
    assert sorted(r.k for r in raw.table().collect()) == ["d", "e"]
    put(raw, "odd: 50%/a=b", "x")
    put(raw, "odd: 50%/a=b")
    assert sorted(r.k for r in raw.table().collect()) == ["d", "e"]
    assert not [t for t in raw.spark.catalog.listTables() if t.name.startswith("staging_")]


@pytest.mark.parametrize("where", ["written", "counted", "drafted", "moved", "cleared"])
def test_a_load_that_dies_leaves_old_or_new(raw, monkeypatch, where):
    """Killed between any two writes, table and ledger together are what they were, or what the load makes them."""
    put(raw, "2025-01-01", "a", "b", held=1)
    put(raw, "2025-01-02", "c")
    state = lambda: (sorted((r._partition, r.k) for r in raw.table().collect()), {r._partition: (r.rows_loaded, r.rows_held) for r in raw.ledger().collect()})
    old = state()

    def dies(*args, **kwargs):
        raise KeyboardInterrupt

    target = {"written": (store, "mismatches"), "counted": (store, "_sum_of_digests"), "drafted": (commits.folders, "create_text"), "moved": (commits.Commits, "commit"), "cleared": (commits.folders, "remove")}[where]
    if where == "cleared":
        monkeypatch.setattr(commits, "KEEP", 1)
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(*target, dies)
        put(raw, "2025-01-01", "x", "y", "z", held=0)
    new = ([("2025-01-01", k) for k in "xyz"] + [("2025-01-02", "c")], {"2025-01-01": (3, 0), "2025-01-02": (1, 0)})
    assert state() == (new if where == "cleared" else old)
    assert raw.reconcile().count() == 0
    put(raw, "2025-01-01", "x", "y", "z", held=0)
    assert state() == new
    raw.vacuum()
    assert state() == new


def test_a_second_writer_is_refused(raw, monkeypatch):
    put(raw, "2025-01-01", "a")
    latest = commits.Commits.latest

    def late(self):
        seen = latest(self)
        with monkeypatch.context() as m:
            m.setattr(commits.Commits, "latest", latest)
            put(raw, "2025-01-02", "b")
        return seen

    with monkeypatch.context() as m, pytest.raises(CommitConflict):
        m.setattr(commits.Commits, "latest", late)
        put(raw, "2025-01-03", "c")
    assert sorted(r.k for r in raw.table().collect()) == ["a", "b"]
    assert sorted(r.k for r in raw.table(["2025-01-02", "2025-01-09"]).collect()) == ["b"]


def test_null_cells_and_empty_ones_are_unlike(spark):
    a, b = (spark.createDataFrame([(x, "y")], "k string, v string") for x in (None, ""))
    assert store.mismatches(a, b)[1] == 2


def test_mismatches_are_counted_beyond_the_examples(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "k string") for v in ("aaabcdefgh", "aabx"))
    wrong, total = store.mismatches(a, b)
    assert total == 8 and len(wrong) == 5 and wrong[0] == ("second", "x")
    assert store.mismatches(a, a) == ([], 0)


def test_empty_fields_become_null_and_na_stays_text(raw):
    data = raw.spark.createDataFrame([("a", "", "NA", None)], SCHEMA)
    raw.load(data, "2025-01-01", {"accepted": 1, "held": 0}, "0" * 64, NOW)
    r = raw.table().first()
    assert (r.k, r.n, r.state, r.memo, r._partition) == ("a", None, "NA", None, "2025-01-01")


def test_drift_orphans_and_gaps(raw):
    put(raw, "2025-01-01", "a")
    put(raw, "2025-01-03", "b")
    judged = raw.spark.createDataFrame([("2025-01-01",), ("2025-01-02",)], "partition string")
    assert [r._partition for r in raw.orphans(judged).collect()] == ["2025-01-03"]
    assert [r.partition for r in store.plan_gaps(raw.spark, "2025-01-01", "2025-01-03", judged).collect()] == ["2025-01-03"]
    with pytest.raises(ValueError):
        store.plan_gaps(raw.spark, "2025-01-03", "2025-01-01", judged)
    less = raw.ledger().where("_partition <> '2025-01-03'")
    assert [tuple(r) for r in store.reconcile(raw.table(), less).collect()] == [("2025-01-03", 1, 0)]


def test_backfill(raw):
    judged = raw.spark.createDataFrame([("2025-01-01",), ("2025-01-02",), ("2025-01-03",)], "partition string")
    assert store.backfill(raw, "2025-01-01", "2025-01-02", judged, lambda p: put(raw, p, p)) == ["2025-01-01", "2025-01-02"]
    with pytest.raises(MissingPartitions):
        store.backfill(raw, "2025-01-01", "2025-01-04", judged, lambda p: put(raw, p, p))

    def fails(p):
        if p == "2025-01-02":
            raise LoadCountMismatch(p)
        put(raw, p, p)

    with pytest.raises(BackfillStopped) as stop:
        store.backfill(raw, "2025-01-01", "2025-01-03", judged, fails)
    assert stop.value.completed == ["2025-01-01"] and stop.value.partition == "2025-01-02"


def test_statements():
    assert len(store.statements(CONTRACT, "duckdb")) == 3
    assert "NUMBER(38,0)" in store.statements(CONTRACT, "snowflake")[2]
    with pytest.raises(UnknownDialect):
        store.statements(CONTRACT, "other")
    clash = contracts.parse(BASE | {"columns": [*BASE["columns"], {"name": "_loaded_at", "type": "string", "required": True, "provenance": "asserted"}]})
    with pytest.raises(MetadataColumnClash):
        store.raw_schema(clash)


def test_split_is_written_and_read_back(spark, tmp_path):
    judged = judge.judged(frame(spark, sample(7)).drop("i"), CONTRACT)
    report = split.write(judged, CONTRACT, "a", str(tmp_path / "a"))
    accepted, held = files.read_split(spark, str(tmp_path / "a"), CONTRACT, "a")
    assert (accepted.count(), held.count()) == (report["accepted"], report["held"]) and report["accepted"] and report["held"]
    assert files.read_verdict(spark, str(tmp_path / "a"), "a")["rows"] == report["rows"]
    with pytest.raises(WrongPartition):
        files.read_verdict(spark, str(tmp_path / "a"), "b")
    with pytest.raises(UnjudgedPartition):
        files.read_verdict(spark, str(tmp_path / "none"), "a")
    with pytest.raises(NoQuarantine):
        files.read_split(spark, str(tmp_path / "none"), CONTRACT, "a")


def test_folder_names_never_beat_columns(spark, tmp_path):
    at = tmp_path / "k=2025-01-01"
    at.mkdir()
    (at / "part.csv").write_text('k,n\n2025-01-01T10:00:00,00083\n"2,5","say ""so"""\n')
    got = files.read_csv(spark, str(tmp_path), ["k", "n"]).collect()
    assert sorted((r.k, r.n) for r in got) == [("2,5", 'say "so"'), ("2025-01-01T10:00:00", "00083")]


def test_long_rows_and_other_headers_fail_the_read(spark, tmp_path):
    (tmp_path / "long.csv").write_text("k,n\n1,2,3\n")
    (tmp_path / "turned.csv").write_text("n,k\n1,2\n")
    for name in ("long", "turned"):
        with pytest.raises(Exception, match="(?i)malformed|header"):
            files.read_csv(spark, str(tmp_path / f"{name}.csv"), ["k", "n"]).collect()
    assert files.header(spark, str(tmp_path / "turned.csv")) == ["n", "k"]


def test_inference_disagrees_and_damages(spark, tmp_path):
    (tmp_path / "a.csv").write_text("zip\n10001\n10002\n")
    (tmp_path / "b.csv").write_text("zip\n00083\nn/a\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    assert list(files.type_disagreements(spark, paths)) == ["zip"]
    assert {r.column: r.changed for r in files.inference_damage(spark, paths).collect()}["zip"] > 0
    with pytest.raises(NoQuarantine):
        files.inference_damage(spark, paths[:1])


def test_manifest(spark, tmp_path):
    assert files.manifest(spark, str(tmp_path / "none.json")).count() == 0
    entry = lambda p, n: (p, n, n, 10, "0", None, "x")
    old = spark.createDataFrame([entry("2025-01-02", 1), entry("2025-01-01", 2)], files.MANIFEST)
    new = spark.createDataFrame([entry("2025-01-02", 5)], files.MANIFEST)
    assert [(r.partition, r.rows) for r in files.upsert(old, new).collect()] == [("2025-01-01", 2), ("2025-01-02", 5)]


def test_written_partition_has_fixed_columns(spark, tmp_path):
    files.write_partition(spark.createDataFrame([("a", None)], "k string, n string").coalesce(1), ["n", "k", "absent"], str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_bytes() == b"n,k,absent\n,a,\n"
    assert files.digests(spark, str(part)).first().bytes == 15


def getter(total, claimed=None):
    """A source of ``total`` rows a day."""
    from urllib.parse import parse_qs, urlsplit

    def get(url):
        q = {k: v[0] for k, v in parse_qs(urlsplit(url).query).items()}
        if q["$select"].startswith("count"):
            return [{"n": str(total if claimed is None else claimed)}]
        lo = int(q["$offset"])
        return [{"k": str(i), "ts": q["$where"][6:25]} for i in range(lo, min(total, lo + int(q["$limit"])))]

    return get


def test_pages_and_counts(spark):
    days = [date(2025, 1, 1), date(2025, 1, 2)]
    pull = lambda get: api.fetch(spark, get, "http://source", ["k", "ts"], "ts", "k", days, size=5, now=lambda: NOW)
    got = pull(getter(10)).collect()
    assert len(got) == 20 and {r._partition for r in got} == {"2025-01-01", "2025-01-02"} and {r._fetched_at for r in got} == {NOW.isoformat()}
    with pytest.raises(Exception, match=IncompletePartition.__name__):
        pull(getter(10, 11)).collect()
    asked = []
    base = getter(10)
    assert len(list(api.pages(lambda u: asked.append(u) or base(u), "http://source", ["k"], "ts", "k", days[0], 5))) == 10
    assert len(asked) == 3 and "offset=0" in asked[0]
    assert api.window("ts", days[0]) == "ts >= '2025-01-01T00:00:00' AND ts < '2025-01-02T00:00:00'"


def test_paged_days_as_a_data_source(spark):
    base, failed = getter(10), []

    def flaky(url):
        if "offset=5" in url and not failed:
            failed.append(url)
            raise OSError("once")
        return base(url)

    options = {"base": "http://source", "columns": "k,ts", "timestamp": "ts", "key": "k", "start": "2025-01-01", "end": "2025-01-03", "pageSize": "5"}
    paged.register(spark, flaky)
    read = spark.read.format("paged_days").options(**options).load()
    assert read.columns == ["_partition", "_fetched_at", "k", "ts"] and read.rdd.getNumPartitions() == 3
    assert sorted((r._partition, int(r.k)) for r in read.collect()) == [(f"2025-01-0{d}", i) for d in (1, 2, 3) for i in range(10)]
    assert [d.day.isoformat() for d in paged.DaysReader(base, {k.lower(): v for k, v in options.items()}).partitions()] == ["2025-01-01", "2025-01-02", "2025-01-03"]
    for total, claimed in ((10, 11), (10, 9), (7, 10)):  # a full last page, too many, a short day
        paged.register(spark, getter(total, claimed), "short_days")
        with pytest.raises(Exception, match=IncompletePartition.__name__):
            spark.read.format("short_days").options(**options).load().collect()
    reader = paged.DaysReader(lambda url: (_ for _ in ()).throw(OSError("down")), {k.lower(): v for k, v in options.items()})
    with pytest.raises(OSError, match="down"):
        list(reader.read(reader.partitions()[0]))
    with pytest.raises(NothingChecked):
        paged.DaysReader(base, {"base": "x"})


@pytest.mark.parametrize("splits", [1, 4, 16])
def test_places_follow_the_files_however_they_are_split(spark, tmp_path, splits):
    for name, n in (("b", 300), ("a", 500), ("c", 1)):
        (tmp_path / f"{name}.csv").write_text("k,n\n" + "".join(f"{name}{i},{i}\n" for i in range(n)))
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // splits + 1))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = files.numbered(files.read_csv(spark, str(tmp_path), ["k", "n"], one_line=True))
        assert got.rdd.getNumPartitions() >= splits
        assert [r.k for r in got.orderBy("_ordinal").collect()] == [f"{name}{i}" for name, n in (("a", 500), ("b", 300), ("c", 1)) for i in range(n)]
        assert [r._ordinal for r in got.select("_ordinal").orderBy("_ordinal").collect()] == list(range(801))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_fingerprint_ignores_order(spark):
    df = spark.createDataFrame([(i, str(i % 7)) for i in range(50)], "a int, b string")
    one, two = (store.fingerprint(x).first() for x in (df, df.orderBy(F.desc("a")).repartition(3)))
    assert one == two and store.fingerprint(df.limit(49)).first() != one
    assert store.fingerprint(df.limit(0)).first().rows == 0
