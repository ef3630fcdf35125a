"""Queries over the shared tables, one for each operator, and the SQL that must give the same rows.

Orders, customers and line items are seen as service requests, all text: ``requests`` as they
are, and ``damaged`` with texts broken by rules on the order key, so that every rule finds
something.  Both views are written once in Spark and once in SQL.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate import contract as contracts
from tollgate.contract import Contract
from tollgate.operators import checks, diff, feed, history, judge, profile, rejudge, split
from tollgate.plans import data_tests, models
from tollgate.sinks import folders, store

Query = Callable[[SparkSession, str], DataFrame]
NOW = datetime(2024, 2, 1, 12, 0, 0)


def shipped_contract() -> Contract:
    return contracts.load(os.path.join(os.path.dirname(__file__), "plans", "service_requests.yml"))


def table_contract() -> Contract:
    """The shipped contract with the tables' own boroughs, and a count column."""
    c = shipped_contract()
    columns = [replace(x, rules=x.rules | {"allowed": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]}) if x.name == "borough" else x for x in c.columns]
    columns.append(contracts.Column("n", "integer", {"min": 0, "max": 400}, "asserted"))
    return replace(c, columns=columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k (the order's key), the text columns, _partition (the day)."""
    t = lambda n: table(spark, sf_dir, n)
    shape = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    shipped = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("shipped"))
    where = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    who = t("customer").join(where, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "r_name")
    rows = t("orders").join(who, "o_custkey").join(shipped, "o_orderkey", "left")
    k, text = F.col("o_orderkey"), lambda c: c.cast("string")
    return rows.select(
        k.alias("k"),
        text(k).alias("unique_key"),
        F.date_format("o_orderdate", shape).alias("created_date"),
        F.when(~((F.col("o_orderstatus") == "O") & (k % 3 != 0)), F.date_format("shipped", shape)).alias("closed_date"),
        F.expr("substring(o_orderpriority, 3)").alias("agency"),
        F.col("c_mktsegment").alias("complaint_type"),
        F.lit(None).cast("string").alias("descriptor"),
        F.lpad(text(F.col("o_custkey")), 5, "0").alias("incident_zip"),
        F.col("r_name").alias("borough"),
        F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Open").otherwise("Pending").alias("status"),
        F.lit("40.7").alias("latitude"),
        F.lit("-73.9").alias("longitude"),
        text(k % 500).alias("n"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("_partition"),
    )


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """requests with broken texts; _partition is the month."""
    k, keep = F.col("k"), F.col
    at = lambda m, r: k % m == r
    return requests(spark, sf_dir).withColumns(
        {
            "_partition": F.substring("_partition", 1, 7),
            "unique_key": F.when(at(50, 0), F.concat(F.lit("dup"), (F.floor(k / 50) % 3).cast("string"))).when(at(97, 3), " ").otherwise(keep("unique_key")),
            "created_date": F.when(at(97, 1), "N/A").when(at(89, 4), F.substring("created_date", 1, 10)).otherwise(keep("created_date")),
            "agency": F.when(at(89, 2), "").otherwise(keep("agency")),
            "complaint_type": F.when(at(101, 5), "NULL").otherwise(keep("complaint_type")),
            "incident_zip": F.when(at(83, 3), F.expr("substring(incident_zip, 2)")).otherwise(keep("incident_zip")),
            "borough": F.when(at(61, 9), "ATLANTIS").otherwise(keep("borough")),
            "status": F.when(at(59, 8), "Lost").otherwise(keep("status")),
            "latitude": F.when(at(71, 4), "abc").when(at(71, 5), "99.5").when(at(71, 6), "nan").when(at(71, 7), "1_0e1").otherwise(keep("latitude")),
            "longitude": F.when(at(73, 6), "-80").when(at(73, 7), F.lit(None)).otherwise(keep("longitude")),
            "n": F.when(at(67, 7), "3.5").when(at(67, 8), "1_000").when(at(67, 9), " -5 ").otherwise(keep("n")),
        }
    )


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.judged(damaged(spark, sf_dir), table_contract())


def rejudged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All held rows, judged without the bound of agencies' length; the judgement before is written once, and both sides and their unique values are read from there."""
    rows = judged(spark, sf_dir)
    rows = folders.kept(rows.select(*[f"`{c}`" for c in rows.columns if not judge.own(c) or c in (judge.PARTITION, judge.FAILURES) or c.startswith(judge.BITS)]), "judged")
    return rejudge.rejudge(split.accepted(rows), split.held(rows), contracts.relax_column(table_contract(), "agency", "max_length"))


def judged_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.judged(requests(spark, sf_dir), table_contract())


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """partition, rows, fetched_at of the events' days; every fifth day has no fetch time."""
    days = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("partition")).agg(F.count("*").alias("rows"))
    fetched = F.when(F.dayofmonth(F.to_date("partition")) % 5 != 0, F.concat(F.date_format(F.date_add(F.to_date("partition"), F.dayofmonth(F.to_date("partition")) % 4), "yyyy-MM-dd"), F.lit("T06:00:00")))
    return days.withColumn("fetched_at", fetched)


def newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("hour(ts) < 20 or dayofmonth(ts) <> 7")
    return events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("_partition")).agg(F.max(F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("newest"))


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


_REQUESTS = """WITH ship AS (SELECT l_orderkey, min(l_shipdate) AS s FROM lineitem GROUP BY l_orderkey),
requests AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS unique_key, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS created_date,
  CASE WHEN NOT (o_orderstatus = 'O' AND o_orderkey % 3 <> 0) THEN strftime(s, '%Y-%m-%dT%H:%M:%S.000') END AS closed_date,
  substr(o_orderpriority, 3) AS agency, c_mktsegment AS complaint_type, CAST(NULL AS VARCHAR) AS descriptor,
  lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS incident_zip, r_name AS borough,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS status, '40.7' AS latitude, '-73.9' AS longitude,
  CAST(o_orderkey % 500 AS VARCHAR) AS n, strftime(o_orderdate, '%Y-%m-%d') AS _partition
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN ship ON l_orderkey = o_orderkey)"""
_DAMAGED = (
    _REQUESTS
    + """, damaged AS (SELECT k,
  CASE WHEN k % 50 = 0 THEN 'dup' || CAST((k // 50) % 3 AS VARCHAR) WHEN k % 97 = 3 THEN ' ' ELSE unique_key END AS unique_key,
  CASE WHEN k % 97 = 1 THEN 'N/A' WHEN k % 89 = 4 THEN substr(created_date, 1, 10) ELSE created_date END AS created_date, closed_date,
  CASE WHEN k % 89 = 2 THEN '' ELSE agency END AS agency, CASE WHEN k % 101 = 5 THEN 'NULL' ELSE complaint_type END AS complaint_type, descriptor,
  CASE WHEN k % 83 = 3 THEN substr(incident_zip, 2) ELSE incident_zip END AS incident_zip,
  CASE WHEN k % 61 = 9 THEN 'ATLANTIS' ELSE borough END AS borough, CASE WHEN k % 59 = 8 THEN 'Lost' ELSE status END AS status,
  CASE k % 71 WHEN 4 THEN 'abc' WHEN 5 THEN '99.5' WHEN 6 THEN 'nan' WHEN 7 THEN '1_0e1' ELSE latitude END AS latitude,
  CASE k % 73 WHEN 6 THEN '-80' WHEN 7 THEN NULL ELSE longitude END AS longitude,
  CASE k % 67 WHEN 7 THEN '3.5' WHEN 8 THEN '1_000' WHEN 9 THEN ' -5 ' ELSE n END AS n, substr(_partition, 1, 7) AS _partition FROM requests)"""
)


def _null(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) IN ('', 'NA', 'N/A', 'null', 'NULL', 'None'))"


def _num(c: str) -> str:
    return f"TRY_CAST(replace(trim({c}), '_', '') AS DOUBLE)"


def _ts(c: str) -> str:
    return f"try_strptime(trim({c}), ['%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S'])"


def _range(c: str, lo: str, hi: str) -> list[str]:
    return [f"CASE WHEN NOT {_null(c)} AND {_num(c)} IS NOT NULL AND (isnan({_num(c)}) OR {_num(c)} < {lo}) THEN '{c}:min' END", f"CASE WHEN NOT {_null(c)} AND {_num(c)} IS NOT NULL AND (isnan({_num(c)}) OR {_num(c)} > {hi}) THEN '{c}:max' END"]


def _judge_ctes(view: str, n: str = "") -> str:
    """judged<n>: the view with f (subject:rule texts in order), c1..c3 (the checks' verdicts) and evaluations."""
    required = lambda c: f"CASE WHEN {_null(c)} THEN '{c}:required' END"
    present = lambda c, n: f"CASE WHEN {_null(c)} THEN 0 ELSE {n} END"
    f = [
        required("unique_key"), "CASE WHEN times > 1 THEN 'unique_key:unique' END",
        required("created_date"), f"CASE WHEN NOT {_null('created_date')} AND {_ts('created_date')} IS NULL THEN 'created_date:type' END",
        f"CASE WHEN NOT {_null('closed_date')} AND {_ts('closed_date')} IS NULL THEN 'closed_date:type' END",
        required("agency"), f"CASE WHEN NOT {_null('agency')} AND length(trim(agency)) > 10 THEN 'agency:max_length' END", required("complaint_type"),
        f"CASE WHEN NOT {_null('incident_zip')} AND NOT regexp_matches(trim(incident_zip), '^[0-9]{{5}}$') THEN 'incident_zip:matches' END",
        required("borough"), f"CASE WHEN NOT {_null('borough')} AND trim(borough) NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') THEN 'borough:allowed' END",
        required("status"), f"CASE WHEN NOT {_null('status')} AND trim(status) NOT IN ('Open', 'Closed', 'Assigned', 'Pending', 'In Progress', 'Started', 'Draft', 'Unspecified') THEN 'status:allowed' END",
        f"CASE WHEN NOT {_null('latitude')} AND {_num('latitude')} IS NULL THEN 'latitude:type' END", *_range("latitude", "40.4", "40.95"),
        f"CASE WHEN NOT {_null('longitude')} AND {_num('longitude')} IS NULL THEN 'longitude:type' END", *_range("longitude", "-74.3", "-73.7"),
        f"CASE WHEN NOT {_null('n')} AND NOT regexp_matches(trim(n), '^[+-]?[0-9](_?[0-9])*$') THEN 'n:type' END", *_range("n", "0", "400"),
        "CASE WHEN NOT c1 THEN 'check:closed_after_created' END", "CASE WHEN NOT c2 THEN 'check:closed_request_has_a_closed_date' END", "CASE WHEN NOT c3 THEN 'check:open_request_has_no_closed_date' END",
    ]
    work = ["6", present("unique_key", 2), present("created_date", 1), present("closed_date", 1), present("agency", 2), present("complaint_type", 1), present("descriptor", 1), present("incident_zip", 2), present("borough", 2), present("status", 2), present("latitude", 3), present("longitude", 3), present("n", 3)]
    work += [f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in ("c1", "c2", "c3")]
    return f""", counted{n} AS (SELECT *, {_ts('closed_date')} >= {_ts('created_date')} AS c1, CASE WHEN trim(status) = 'Closed' THEN NOT {_null('closed_date')} END AS c2,
  CASE WHEN trim(status) IN ('Open', 'Assigned', 'Pending', 'In Progress', 'Started') THEN {_null('closed_date')} END AS c3,
  CASE WHEN {_null('unique_key')} THEN 1 ELSE count(*) OVER (PARTITION BY _partition, unique_key) END AS times FROM {view}),
judged{n} AS (SELECT *, list_filter([{', '.join(f)}], lambda x: x IS NOT NULL) AS f, CAST({' + '.join(work)} AS BIGINT) AS evaluations FROM counted{n})"""


def _judged_sql(view: str) -> str:
    return (_DAMAGED if view == "damaged" else _REQUESTS) + _judge_ctes(view)


_JUDGED = _judged_sql("damaged")
_FLAT = _JUDGED + ", flat AS (SELECT split_part(x, ':', 1) AS subject, split_part(x, ':', 2) AS rule FROM (SELECT unnest(f) AS x FROM judged) t)"
_COLUMNS = "unique_key, created_date, closed_date, agency, complaint_type, descriptor, incident_zip, borough, status, latitude, longitude, n"

for _rule in ("required", "type", "allowed", "max_length", "matches", "min", "max", "unique"):
    query(f"rule_{_rule}", f"{_FLAT} SELECT subject, count(*) AS failed FROM flat WHERE rule = '{_rule}' GROUP BY subject")(
        lambda spark, d, r=_rule: judge.rule_counts(judged(spark, d)).where(F.col("rule") == r).select("subject", "failed")
    )
for _name, _column in (("rule_type_integer", "n"), ("rule_type_number", "latitude"), ("rule_type_timestamp", "created_date")):
    query(_name, f"{_FLAT} SELECT count(*) AS failed FROM flat WHERE rule = 'type' AND subject = '{_column}'")(
        lambda spark, d, c=_column: judge.rule_counts(judged(spark, d)).where((F.col("rule") == "type") & (F.col("subject") == c)).select("failed")
    )
for _name, _check in (("check_ordering", "closed_after_created"), ("check_requires_when", "closed_request_has_a_closed_date"), ("check_forbids_when", "open_request_has_no_closed_date")):
    query(_name, f"{_judged_sql('requests')} SELECT k FROM judged WHERE list_contains(f, 'check:{_check}')")(
        lambda spark, d, c=_check: judged_plain(spark, d).where(~F.col(f"_check_{c}")).select("k")
    )

query("judge_rows", f"{_JUDGED} SELECT k, array_to_string(f, ' and ') AS reasons FROM judged WHERE len(f) > 0")(lambda s, d: judged(s, d).where(F.size(judge.FAILURES) > 0).select("k", split.reason().alias("reasons")))
query("rule_counts", f"{_FLAT} SELECT subject, rule, count(*) AS failed FROM flat GROUP BY subject, rule")(lambda s, d: judge.rule_counts(judged(s, d)))
query(
    "validation_summary",
    f"""{_JUDGED} SELECT _partition, count(*) AS rows, count(*) FILTER (WHERE len(f) = 0) AS accepted, count(*) FILTER (WHERE len(f) > 0) AS held, CAST(sum(evaluations) AS BIGINT) AS evaluations,
  count(*) FILTER (WHERE len(f) > 1) AS multi_rule, count(*) FILTER (WHERE len(f) > 0 AND len(list_filter(f, lambda x: NOT ends_with(x, ':unique'))) = 0) AS held_only_by_unique,
  count(c1) AS considered_closed_after_created, count(c2) AS considered_closed_request_has_a_closed_date, count(c3) AS considered_open_request_has_no_closed_date FROM judged GROUP BY _partition""",
)(lambda s, d: judge.summary(judged(s, d), table_contract()))
query("held_only_by_unique", f"{_JUDGED} SELECT count(*) FILTER (WHERE len(f) > 0 AND len(list_filter(f, lambda x: NOT ends_with(x, ':unique'))) = 0) AS held FROM judged")(lambda s, d: judged(s, d).agg(judge.held_only_by("unique").alias("held")))
_COLLIDE = f"{_DAMAGED} SELECT _partition, unique_key AS value, count(*) AS times FROM damaged WHERE NOT {_null('unique_key')} GROUP BY _partition, unique_key HAVING count(*) > 1"
query("collisions", _COLLIDE)(lambda s, d: judge.collisions(damaged(s, d), "unique_key"))
query("largest_collision", f"SELECT 'unique_key' AS \"column\", greatest(1, coalesce(max(times), 1)) AS largest FROM ({_COLLIDE}) t")(lambda s, d: judge.largest_collision(damaged(s, d), table_contract()))
query("evaluations", f"{_JUDGED} SELECT _partition, CAST(sum(evaluations) AS BIGINT) AS evaluations FROM judged GROUP BY _partition")(lambda s, d: judged(s, d).groupBy("_partition").agg(F.sum(judge.EVALUATIONS).alias("evaluations")))
query("check_considered", f"{_JUDGED} SELECT count(c1) AS ordering, count(c2) AS requires, count(c3) AS forbids FROM judged")(
    lambda s, d: judged(s, d).agg(F.count("_check_closed_after_created").alias("ordering"), F.count("_check_closed_request_has_a_closed_date").alias("requires"), F.count("_check_open_request_has_no_closed_date").alias("forbids"))
)
query("split_accepted", f"{_JUDGED} SELECT _partition, k, {_COLUMNS} FROM judged WHERE len(f) = 0")(lambda s, d: split.accepted(judged(s, d)))
query("split_held", f"{_JUDGED} SELECT _partition, k, {_COLUMNS}, array_to_string(f, ' and ') AS _contract_failures FROM judged WHERE len(f) > 0")(lambda s, d: split.held(judged(s, d)))
_CHECKS = {"c1": "closed_after_created", "c2": "closed_request_has_a_closed_date", "c3": "open_request_has_no_closed_date"}
query(
    "quarantine_report",
    f"""{_JUDGED}, flat AS (SELECT _partition, x, count(*) AS n FROM (SELECT _partition, unnest(f) AS x FROM judged) t GROUP BY _partition, x),
  rules AS (SELECT _partition, CAST(sum(n) AS BIGINT) AS total, max(n) AS largest, string_agg(x || '=' || n, '; ' ORDER BY n DESC, split_part(x, ':', 1), split_part(x, ':', 2)) AS by_rule FROM flat GROUP BY _partition),
  whole AS (SELECT _partition, count(*) AS rows, count(*) FILTER (WHERE len(f) = 0) AS accepted, count(*) FILTER (WHERE len(f) > 0) AS held, count(*) FILTER (WHERE len(f) > 1) AS multi_rule,
  count(*) FILTER (WHERE len(f) > 0 AND len(list_filter(f, lambda x: NOT ends_with(x, ':unique'))) = 0) AS held_only_by_unique, max(times) AS largest_collision, CAST(sum(evaluations) AS BIGINT) AS evaluations,
  {', '.join(f'count({c}) AS considered_{name}' for c, name in _CHECKS.items())} FROM judged GROUP BY _partition)
  SELECT w.*, round(held / rows, 6) AS held_share, coalesce(total, 0) AS sum_of_rule_counts, coalesce(largest, 0) AS largest_rule_count, coalesce(by_rule, '') AS by_rule FROM whole w LEFT JOIN rules r ON r._partition = w._partition""",
)(lambda s, d: split.reports(judged(s, d), table_contract()).withColumn("by_rule", F.array_join(F.transform("by_rule", lambda x: F.concat(x["subject"], F.lit(":"), x["rule"], F.lit("="), x["rows"].cast("string"))), "; ")))
_PROFILE = [(r, c.name) for c in table_contract().columns for r in [*(["required"] if c.rules.get("required") else []), "type", *[x for x in ("allowed", "max_length", "matches", "min", "max") if x in c.rules], *(["unique"] if c.rules.get("unique") else [])]]
_LISTED = ", ".join([f"('{c}', '{r}')" for r, c in _PROFILE] + [f"('check', '{c.name}')" for c in table_contract().checks])
query("profile_columns", f"{_FLAT} SELECT p.subject, p.rule, count(flat.rule) AS failed FROM (VALUES {_LISTED}) p(subject, rule) LEFT JOIN flat ON flat.subject = p.subject AND flat.rule = p.rule GROUP BY p.subject, p.rule")(
    lambda s, d: profile.columns(judged(s, d), table_contract()).select("subject", "rule", "failed")
)
_VALUE = " ".join(f"WHEN '{c}' THEN {c}" for c in _COLUMNS.split(", "))
query(
    "profile_examples",
    f"""{_JUDGED}, one AS (SELECT k, split_part(x, ':', 1) AS subject, split_part(x, ':', 2) AS rule, {_COLUMNS} FROM (SELECT *, unnest(f) AS x FROM judged) t),
  placed AS (SELECT subject, rule, CAST(row_number() OVER (PARTITION BY subject, rule ORDER BY k) AS INTEGER) AS place, CASE subject {_VALUE} END AS value FROM one WHERE subject <> 'check')
  SELECT * FROM placed WHERE place <= 3""",
)(lambda s, d: profile.examples(judged(s, d), "k"))
_CONSTRAINTS = ", ".join(f"('{c.subject}', '{c.rule}', {str(c.removable).lower()})" for c in contracts.constraints(table_contract()))
query(
    "marginal",
    f"""{_JUDGED} SELECT c.subject, c.rule, c.removable, CASE WHEN c.removable THEN count(a.x) END AS recovered FROM (VALUES {_CONSTRAINTS}) c(subject, rule, removable)
  LEFT JOIN (SELECT f[1] AS x FROM judged WHERE len(f) = 1) a ON a.x = c.subject || ':' || c.rule GROUP BY c.subject, c.rule, c.removable""",
)(lambda s, d: rejudge.marginal(judged(s, d), table_contract()))


@query("rejudge_relaxed", f"{_JUDGED}, r AS (SELECT f, list_filter(f, lambda x: x <> 'agency:max_length') AS g FROM judged WHERE len(f) > 0) SELECT count(*) AS held, count(*) FILTER (WHERE len(g) = 0) AS recovered, count(*) FILTER (WHERE len(g) > 0) AS still_held, count(*) FILTER (WHERE len(g) > 0 AND len(g) <> len(f)) AS changed FROM r")
def rejudge_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejudge.rejudge_summary(rejudged(spark, sf_dir))


query("rejudge_stopped", f"{_JUDGED} SELECT 'agency:max_length' AS reason, count(*) AS rows FROM judged WHERE f = ['agency:max_length']")(
    lambda s, d: rejudge.stopped(rejudged(s, d))
)
query(
    "rejudge_reworded",
    f"{_JUDGED} SELECT k, array_to_string(list_sort(f), ' and ') AS was, array_to_string(list_sort(list_filter(f, lambda x: x <> 'agency:max_length')), ' and ') AS now FROM judged WHERE list_contains(f, 'agency:max_length') AND len(f) > 1",
)(
    lambda s, d: rejudge.reworded(rejudged(s, d), "k").select("k", F.array_join("was", " and ").alias("was"), F.array_join("now", " and ").alias("now"))
)

_DONE = {  # what each break writes, in SQL
    "blank_key": {"unique_key": "''"},
    "unknown_borough": {"borough": "'ATLANTIS'"},
    "long_agency": {"agency": "'A very long agency'"},
    "short_zip": {"incident_zip": "'0083'"},
    "far_north": {"latitude": "'60.17'"},
    "longitude_in_words": {"longitude": "'seventy-four'"},
    "duplicate_key": {"unique_key": "(SELECT CAST(max(k) AS VARCHAR) FROM clean)"},
    "closed_before_created": {"closed_date": "'1900-01-01T00:00:00.000'", "status": "'Closed'"},
    "closed_without_a_date": {"status": "'Closed'", "closed_date": "''"},
    "open_with_a_date": {"status": "'Open'", "closed_date": "'2999-01-01T00:00:00.000'"},
    "wrong_agency": {"agency": "'OTHER'"},
}


def _break_sql(b: rejudge.Break, count: int) -> str:
    named = f"{b.subject}:{b.rule}"
    less = "f" if b.subject is None else f"list_filter(f, lambda x: NOT starts_with(x, '{b.subject}:'))" if b.rule == "type" else f"list_filter(f, lambda x: x <> '{named}')"
    changes = ", ".join(f"CASE WHEN k IN (SELECT k FROM chosen) THEN {v} ELSE {c} END AS {c}" for c, v in _DONE[b.name].items())
    hurt = "SELECT k FROM chosen" + (" UNION SELECT max(k) FROM clean" if b.copied else "")
    return f"""{_REQUESTS}, whole AS (SELECT * REPLACE ('all' AS _partition) FROM requests){_judge_ctes('whole', '0')},
  clean AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS place, count(*) OVER () AS n FROM judged0 WHERE len(f) = 0),
  chosen AS (SELECT k FROM clean WHERE place > 0 AND place % (n // {count + 1}) = 0 AND place // (n // {count + 1}) <= {count}), hurt AS ({hurt}),
  broken AS (SELECT * REPLACE ({changes}) FROM whole){_judge_ctes('broken', '1')},
  met AS (SELECT b.f AS new, b.less AS new_less, a.f AS old, a.less AS old_less, b.k IN (SELECT k FROM hurt) AS hit FROM (SELECT k, f, {less} AS less FROM judged1) b JOIN (SELECT k, f, {less} AS less FROM judged0) a ON a.k = b.k),
  fresh AS (SELECT * FROM met WHERE len(new) > 0 AND len(old) = 0)
  SELECT '{b.name}' AS name, CAST({count} AS BIGINT) AS targets, (SELECT count(*) FROM hurt) AS damaged, count(*) AS new_holds, count(*) FILTER (WHERE hit) AS caught, count(*) FILTER (WHERE hit AND list_contains(new, '{named}')) AS named,
  count(*) FILTER (WHERE NOT hit) AS collateral, (SELECT count(*) FROM met WHERE hit AND len(new_less) > 0 AND len(old_less) = 0) AS control_holds, count(*) / {float(count)} AS amplification FROM fresh"""


_ALL_BREAKS = " UNION ALL ".join(f"SELECT * FROM ({_break_sql(b, 8)}) x" for b in rejudge.CATALOGUE)
query("breaks", _ALL_BREAKS)(lambda s, d: rejudge.outcomes(requests(s, d).withColumn("_partition", F.lit("all")), table_contract(), "k", rejudge.CATALOGUE, 8))
for _break in rejudge.CATALOGUE:
    query(f"break_{_break.name}", _break_sql(_break, 8))(lambda s, d, b=_break: rejudge.outcome(requests(s, d).withColumn("_partition", F.lit("all")), table_contract(), "k", b, 8))

query("replay_twice", f"{_DAMAGED} SELECT count(*) AS held FROM (SELECT * FROM damaged WHERE NOT {_null('unique_key')}) t, (VALUES (1), (2)) v(i)")(
    lambda s, d: judge.judged(rejudge.repeated(damaged(s, d), 2), table_contract()).where(F.exists(judge.FAILURES, lambda f: f["rule"] == "unique")).agg(F.count("*").alias("held"))
)

_MANIFEST = """WITH manifest AS (SELECT strftime(ts, '%Y-%m-%d') AS partition, count(*) AS rows,
  CASE WHEN any_value(day(ts)) % 5 <> 0 THEN CAST(any_value(CAST(ts AS DATE)) + CAST(any_value(day(ts)) % 4 AS INTEGER) AS TIMESTAMP) + INTERVAL 6 HOUR END AS fetched FROM events GROUP BY 1),
newest AS (SELECT strftime(ts, '%Y-%m-%d') AS partition, max(date_trunc('second', ts)) AS newest FROM events WHERE hour(ts) < 20 OR day(ts) <> 7 GROUP BY 1)"""


def _fresh_sql(clock: str, scope: str, name: str) -> str:
    lag = f"(epoch_us({clock}) - epoch_us(newest)) / 3600000000.0"
    tail = "WHEN m.partition <> (SELECT max(partition) FROM manifest) THEN 'not_applicable'" if scope == "tail" else ""
    return f"""{_MANIFEST}, v AS (SELECT m.partition, CASE {tail} WHEN newest IS NULL THEN 'no_events' WHEN {clock} IS NULL THEN 'no_extract_time' WHEN {lag} > 48 THEN 'stale' ELSE 'ok' END AS verdict, CAST({lag} AS DOUBLE) AS lag
  FROM manifest m LEFT JOIN newest n ON m.partition = n.partition)
  SELECT partition, 'freshness' AS clause, verdict, CASE WHEN verdict IN ('ok', 'stale') THEN CAST(48 AS DOUBLE) END AS "limit", CASE WHEN verdict IN ('ok', 'stale') THEN lag END AS lag_hours, '{name}' AS reference FROM v"""


for _name, _clock, _scope, _sql in (
    ("freshness_wall_clock", "wall_clock", "all", "TIMESTAMP '2024-02-01 12:00:00'"),
    ("freshness_extract", "extract", "all", "fetched"),
    ("freshness_partition_end", "partition_end", "all", "(CAST(m.partition AS TIMESTAMP) + INTERVAL 1 DAY)"),
    ("freshness_tail", "extract", "tail", "fetched"),
):
    query(_name, _fresh_sql(_sql, _scope, _clock))(lambda s, d, c=_clock, t=_scope: feed.freshness(table_contract(), manifest(s, d), newest(s, d), NOW, c, t))
query("day_counts", "SELECT strftime(ts, '%Y-%m-%d') AS partition, count(*) AS rows, max(ts) AS newest FROM events GROUP BY 1")(lambda s, d: feed.day_counts(table(s, d, "events"), "ts"))
query("volume_floor", f"{_MANIFEST} SELECT partition, 'volume' AS clause, CASE WHEN rows < 330 THEN 'below_floor' ELSE 'ok' END AS verdict, CAST(330 AS DOUBLE) AS \"limit\", rows FROM manifest")(lambda s, d: feed.volume(table_contract(), manifest(s, d), 330))
query("verdict_tally", f"{_MANIFEST} SELECT CASE WHEN rows < 330 THEN 'below_floor' ELSE 'ok' END AS verdict, count(*) AS partitions FROM manifest GROUP BY 1")(lambda s, d: feed.tally(feed.volume(table_contract(), manifest(s, d), 330)))
query("headroom", f"{_MANIFEST} SELECT count(*) AS partitions, min(rows) AS smallest, max(rows) AS largest, CAST(250 AS BIGINT) AS floor, min(rows) - 250 AS gap, min(rows) / CAST(250 AS DOUBLE) AS ratio, 250 > min(rows) AS can_bind FROM manifest")(lambda s, d: feed.headroom(manifest(s, d), 250))
query("mad", f"{_MANIFEST}, m AS (SELECT median(rows) AS med FROM manifest) SELECT any_value(med) AS median, median(abs(rows - med)) AS mad FROM manifest, m")(lambda s, d: feed.mad(manifest(s, d), "rows"))
query(
    "fit_floor",
    f"""{_MANIFEST}, p AS (SELECT rows, row_number() OVER (ORDER BY partition DESC) AS i FROM manifest), m AS (SELECT median(rows) AS med FROM p WHERE i > 5),
  f AS (SELECT any_value(med) AS median, median(abs(rows - med)) AS mad, count(*) AS train FROM p, m WHERE i > 5)
  SELECT median, mad, median - 3.0 * mad AS floor, train, count(*) AS test, count(*) FILTER (WHERE rows < median - 3.0 * mad) AS fires, CAST(count(*) FILTER (WHERE rows < median - 3.0 * mad) AS DOUBLE) / count(*) AS rate, CAST(1 AS DOUBLE) / count(*) AS resolution, mad = 0 AS degenerate
  FROM p, f WHERE i <= 5 GROUP BY median, mad, train""",
)(lambda s, d: feed.fit_floor(manifest(s, d)))
query("window_half_open", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-04'")(
    lambda s, d: table(s, d, "events").where(feed.half_open(F.col("ts"), F.lit("2024-01-03").cast("timestamp_ntz"))).select("event_id", "event_type")
)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged(spark, sf_dir).drop("k", "n").withColumns({"_source_sha256": F.lit("0" * 64), "_loaded_at": F.lit(NOW).cast("timestamp_ntz")})


_STG = (
    _DAMAGED
    + """, stg AS (SELECT unique_key, try_strptime(created_date, '%Y-%m-%dT%H:%M:%S.%f') AS created_at, try_strptime(closed_date, '%Y-%m-%dT%H:%M:%S.%f') AS closed_at,
  agency, complaint_type, descriptor, incident_zip, borough, status, TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude, _partition AS partition_day FROM damaged)"""
)
_SLV = (
    _STG
    + """, slv AS (SELECT *, CAST(created_at AS DATE) AS created_date, status = 'Closed' AS is_closed,
  CASE WHEN closed_at IS NULL OR closed_at < created_at THEN NULL ELSE date_diff('minute', created_at, closed_at) / 60.0 END AS resolution_hours,
  latitude IS NOT NULL AND longitude IS NOT NULL AS has_location FROM stg)"""
)
_TYPED = "unique_key, created_at, closed_at, agency, complaint_type, descriptor, incident_zip, borough, status, latitude, longitude, partition_day"
query("stg_requests", f"{_STG} SELECT {_TYPED} FROM stg")(lambda s, d: models.build(raw(s, d))["stg_requests"].drop("_source_sha256", "_loaded_at"))
query("slv_requests", f"{_SLV} SELECT {_TYPED}, created_date, is_closed, CAST(resolution_hours AS DOUBLE) AS resolution_hours, has_location FROM slv")(lambda s, d: models.build(raw(s, d))["slv_requests"].drop("_source_sha256", "_loaded_at"))
_DIM = ", dim AS (SELECT complaint_type, list_sort(list(DISTINCT agency)) AS agencies, count(DISTINCT agency) AS agency_count, count(*) AS request_count FROM slv GROUP BY complaint_type)"
query("dim_complaint_type", f"{_SLV}{_DIM} SELECT complaint_type, array_to_string(agencies, '|') AS agencies, agency_count, request_count FROM dim")(lambda s, d: models.build(raw(s, d))["dim_complaint_type"].withColumn("agencies", F.array_join("agencies", "|")))
query(
    "gold_agency_daily",
    f"""{_SLV} SELECT created_date, agency, count(*) AS request_count, count(*) FILTER (WHERE is_closed) AS closed_count, count(*) FILTER (WHERE status = 'Open') AS open_count,
  count(*) FILTER (WHERE NOT is_closed AND status <> 'Open') AS in_flight_count, floor(median(resolution_hours) * 100 + 0.5) / 100 AS median_resolution_hours,
  floor(quantile_cont(resolution_hours, 0.9) * 100 + 0.5) / 100 AS p90_resolution_hours, count(*) FILTER (WHERE has_location) AS located_count FROM slv GROUP BY created_date, agency""",
)(lambda s, d: models.build(raw(s, d), once=True)["gold_agency_daily"])
query(
    "gold_complaint_resolution",
    f"""{_SLV}{_DIM} SELECT slv.complaint_type, array_to_string(agencies, '|') AS agencies, agency_count, count(*) AS request_count, count(*) FILTER (WHERE is_closed) AS closed_count, count(*) FILTER (WHERE resolution_hours IS NULL) AS unresolved_count,
  floor(median(resolution_hours) * 100 + 0.5) / 100 AS median_resolution_hours, floor(quantile_cont(resolution_hours, 0.9) * 100 + 0.5) / 100 AS p90_resolution_hours,
  floor(max(resolution_hours) * 100 + 0.5) / 100 AS slowest_resolution_hours FROM slv JOIN dim ON slv.complaint_type = dim.complaint_type GROUP BY slv.complaint_type, agencies, agency_count""",
)(lambda s, d: models.build(raw(s, d), once=True)["gold_complaint_resolution"].withColumn("agencies", F.array_join("agencies", "|")))


_LOST = " UNION ALL ".join(f"SELECT unique_key, '{c}' AS \"column\", count({c}) - count({typed}) AS lost FROM damaged GROUP BY unique_key HAVING count({c}) > count({typed})" for c, typed in (("created_date", "try_strptime(created_date, '%Y-%m-%dT%H:%M:%S.%f')"), ("closed_date", "try_strptime(closed_date, '%Y-%m-%dT%H:%M:%S.%f')"), ("latitude", "TRY_CAST(latitude AS DOUBLE)"), ("longitude", "TRY_CAST(longitude AS DOUBLE)")))


def _data_tests_sql() -> str:
    out = []
    for relation, tests in data_tests.tests(table_contract()).items():
        view = {"raw": "damaged", "ledger": "(SELECT _partition FROM damaged GROUP BY _partition)", "stg_requests": "stg", "slv_requests": "slv", "dim_complaint_type": "dim", "gold_agency_daily": "(SELECT created_date, agency, count(*) AS request_count FROM slv GROUP BY ALL)"}.get(relation, "(SELECT complaint_type, count(*) AS request_count FROM slv WHERE complaint_type IS NOT NULL GROUP BY ALL)")
        for t in tests:
            if t.kind == "not_null":
                n = f"SELECT count(*) FROM {view} x WHERE {t.column} IS NULL"
            elif t.kind == "unique":
                n = f"SELECT count(*) FROM (SELECT {t.column} FROM {view} x WHERE {t.column} IS NOT NULL GROUP BY {t.column} HAVING count(*) > 1) y"
            else:
                n = f"SELECT count(DISTINCT {t.column}) FROM {view} x WHERE {t.column} NOT IN ({', '.join(repr(v) for v in t.values)})"
            out.append(f"SELECT '{relation}' AS relation, '{t.column}' AS \"column\", '{t.kind}' AS kind, ({n}) AS violations")
    out.append(f"SELECT 'stg_requests', '*', 'lossless_cast', (SELECT count(*) FROM ({_LOST}) x)")
    out.append("SELECT 'gold', '*', 'totals_agree', CAST((SELECT count(*) FROM slv) <> (SELECT count(complaint_type) FROM slv) AS BIGINT)")
    return f"{_SLV}{_DIM} {' UNION ALL '.join(out)}"


@query("data_tests", _data_tests_sql())
def all_data_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir)
    return data_tests.run(models.build(rows, once=True) | {"ledger": rows.select("_partition").distinct()}, table_contract())


@query("cast_lossless", f"{_DAMAGED} {_LOST}")
def cast_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir)
    return checks.lossless_cast(rows, models.staging(rows), {"created_date": "created_at", "closed_date": "closed_at", "latitude": "latitude", "longitude": "longitude"})


@query("totals_agree", f"{_SLV} SELECT 'complaint_resolution' AS mart, (SELECT count(*) FROM slv) AS expected, (SELECT count(*) FROM slv WHERE complaint_type <> 'NULL') AS found WHERE (SELECT count(*) FROM slv) <> (SELECT count(*) FROM slv WHERE complaint_type <> 'NULL')")
def totals_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = models.build(raw(spark, sf_dir), once=True)
    return checks.totals_agree(built["slv_requests"], built["gold_agency_daily"], built["gold_complaint_resolution"].where("complaint_type <> 'NULL'"))


query("not_null", f"{_STG} SELECT unique_key FROM stg WHERE created_at IS NULL")(lambda s, d: checks.not_null(models.staging(raw(s, d)), "created_at").select("unique_key"))
query("unique_test", f"{_DAMAGED} SELECT unique_key AS value, count(*) AS times FROM damaged WHERE unique_key IS NOT NULL GROUP BY unique_key HAVING count(*) > 1")(lambda s, d: checks.unique(raw(s, d), "unique_key"))
query("accepted_values", f"{_DAMAGED} SELECT status AS value, count(*) AS times FROM damaged WHERE status NOT IN ('Open', 'Closed', 'Pending') GROUP BY status")(lambda s, d: checks.accepted_values(raw(s, d), "status", ["Open", "Closed", "Pending"]))


def _held_tests_sql() -> str:
    out = []
    for t in checks.from_contract(table_contract()):
        c = t.column
        if t.kind == "not_null":
            n = f"SELECT count(*) FROM held WHERE {c} IS NULL"
        elif t.kind == "unique":
            n = f"SELECT count(*) FROM (SELECT {c} FROM held WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) t"
        else:
            n = f"SELECT count(DISTINCT {c}) FROM held WHERE {c} NOT IN ({', '.join(repr(v) for v in t.values)})"
        out.append(f"SELECT '{c}' AS \"column\", '{t.kind}' AS kind, ({n}) AS violations, true AS control")
    return f"{_JUDGED}, held AS (SELECT * FROM judged WHERE len(f) > 0) {' UNION ALL '.join(out)}"


query("tests_on_held", _held_tests_sql())(lambda s, d: checks.run_on_held(split.held(judged(s, d)), table_contract(), "unique_key"))
_PROVENANCE = ", ".join(f"('{c.name}', '{c.provenance}')" for c in table_contract().columns)
_HITS = f"{_FLAT}, known(subject, provenance) AS (VALUES {_PROVENANCE}), hits AS (SELECT flat.subject, rule, provenance, count(*) AS failed FROM flat JOIN known ON known.subject = flat.subject GROUP BY flat.subject, rule, provenance)"
query("profile_provenance", f"{_HITS} SELECT provenance, count(*) AS rules, CAST(sum(failed) AS BIGINT) AS failed FROM hits GROUP BY provenance")(lambda s, d: profile.by_provenance(judged(s, d), table_contract()))
query(
    "profile_corpus",
    f"""{_HITS}, vals AS (SELECT split_part(x, ':', 1) AS subject, split_part(x, ':', 2) AS rule, CASE split_part(x, ':', 1) {_VALUE} END AS value, min(k) AS place_k FROM (SELECT *, unnest(f) AS x FROM judged) t GROUP BY 1, 2, 3),
  firsts AS (SELECT *, row_number() OVER (PARTITION BY subject, rule ORDER BY place_k) AS place FROM vals),
  few AS (SELECT subject, rule, string_agg(coalesce(value, '(null)'), '|' ORDER BY place) AS examples FROM firsts WHERE place <= 3 GROUP BY subject, rule)
  SELECT h.subject, h.rule, provenance, failed, failed / (SELECT CAST(count(*) AS DOUBLE) FROM judged) AS rate, examples FROM hits h JOIN few ON few.subject = h.subject AND few.rule = h.rule""",
)(lambda s, d: profile.corpus(judged(s, d), table_contract(), "k").withColumn("examples", F.array_join("examples", "|", "(null)")))
query(
    "profile_checks",
    f"""{_JUDGED} {' UNION ALL '.join(f"SELECT '{name}' AS \"check\", '{kind}' AS kind, count({c}) AS considered, count(*) FILTER (WHERE NOT {c}) AS failed, CAST(count(*) FILTER (WHERE NOT {c}) AS DOUBLE) / count({c}) AS rate FROM judged" for (c, name), kind in zip(_CHECKS.items(), ("ordering", "requires_when", "forbids_when")))}""",
)(lambda s, d: profile.checks(judged(s, d), table_contract()))


@query("reconcile", "WITH t AS (SELECT strftime(ts, '%Y-%m-%d') AS _partition, count(*) AS n FROM events GROUP BY 1), l AS (SELECT _partition, CASE WHEN substr(_partition, 9) = '05' THEN n - 1 ELSE n END AS m FROM t WHERE substr(_partition, 9) <> '09') SELECT coalesce(t._partition, l._partition) AS _partition, coalesce(n, 0) AS in_table, coalesce(m, 0) AS in_ledger FROM t FULL JOIN l ON t._partition = l._partition WHERE coalesce(n, 0) <> coalesce(m, 0)")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("_partition"))
    ledger = events.where("substring(_partition, 9) <> '09'").groupBy("_partition").agg((F.count("*") - F.when(F.expr("substring(_partition, 9) = '05'"), 1).otherwise(0)).alias("rows_loaded"))
    return store.reconcile(events, ledger)


def _two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two extracts of customers: some moved, some gone, some new."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"), "c_custkey")
    before = c.where("c_custkey % 41 <> 1").drop("c_custkey")
    after = c.where("c_custkey % 43 <> 2").withColumns({"segment": F.when(F.col("c_custkey") % 17 == 0, "MOVED").otherwise(F.col("segment")), "nation": F.when(F.col("c_custkey") % 19 == 0, F.lit(None)).otherwise(F.col("nation"))}).drop("c_custkey")
    return before, after


_TWO = """WITH before AS (SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer WHERE c_custkey % 41 <> 1),
after AS (SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 17 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS nation FROM customer WHERE c_custkey % 43 <> 2)"""
_CELLS = _TWO + """, moved AS (SELECT b.key, 'segment' AS "column", b.segment AS before, a.segment AS after FROM before b JOIN after a ON a.key = b.key WHERE b.segment <> a.segment
  UNION ALL SELECT b.key, 'nation', b.nation, coalesce(a.nation, '') FROM before b JOIN after a ON a.key = b.key WHERE b.nation <> coalesce(a.nation, ''))"""
query("diff_cells", f"{_CELLS} SELECT * FROM moved")(lambda s, d: diff.cells(*_two(s, d), "key"))
query("diff_counters", f"{_CELLS} SELECT \"column\", count(*) AS cells, count(DISTINCT key) AS rows FROM moved GROUP BY \"column\"")(lambda s, d: diff.counters(diff.cells(*_two(s, d), "key"), "key"))
query("diff_added_removed", f"{_TWO} SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'added' ELSE 'removed' END AS state FROM before b FULL JOIN after a ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL")(lambda s, d: diff.added_removed(*_two(s, d), "key"))


@query("apply_diff", f"{_TWO} SELECT b.key, a.segment, coalesce(a.nation, '') AS nation FROM before b JOIN after a ON a.key = b.key")
def apply_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _two(spark, sf_dir)
    return diff.applied(before, diff.cells(before, after, "key"), diff.added_removed(before, after, "key").where("state = 'removed'"), "key")


query("verify_multiset", f"{_TWO} SELECT 'first' AS side, * FROM (SELECT segment, nation FROM before EXCEPT ALL SELECT segment, nation FROM after) x UNION ALL SELECT 'second' AS side, * FROM (SELECT segment, nation FROM after EXCEPT ALL SELECT segment, nation FROM before) y")(
    lambda s, d: diff.multiset_difference(*[x.select("segment", "nation") for x in _two(s, d)])
)
query("null_safe_compare", f"{_TWO}, a AS (SELECT nation, count(*) AS n FROM before GROUP BY nation), b AS (SELECT nation, count(*) AS n FROM after GROUP BY nation) SELECT CAST(coalesce(sum(abs(coalesce(a.n, 0) - coalesce(b.n, 0))), 0) // 2 AS BIGINT) AS differing FROM a FULL JOIN b ON a.nation IS NOT DISTINCT FROM b.nation")(
    lambda s, d: diff.null_safe_counts(*_two(s, d), "nation")
)
query(
    "fingerprint",
    r"""SELECT count(*) AS rows, substr(sha256(CAST(coalesce(sum(CAST('0x' || substr(sha256(concat_ws(chr(31), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))), 1, 15) AS BIGINT)), 0) AS VARCHAR)), 1, 12) AS digest FROM lineitem""",
)(lambda s, d: store.fingerprint(table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"))))
query("orphans", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS _partition FROM events WHERE day(ts) % 7 = 0")(
    lambda s, d: store.orphans(table(s, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("_partition")), manifest(s, d).where("dayofmonth(to_date(partition)) % 7 <> 0"))
)
query("plan_gaps", "SELECT strftime(d, '%Y-%m-%d') AS partition FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-28', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS d) t WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT strftime(ts, '%Y-%m-%d') FROM events)")(
    lambda s, d: store.plan_gaps(s, "2023-12-28", "2024-02-03", manifest(s, d))
)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _two(spark, sf_dir)
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    first = history.snapshot(None, before, "key", ["segment", "nation"], at("2024-01-01 00:00:00"))
    return history.snapshot(first, after, "key", ["segment", "nation"], at("2024-01-02 00:00:00"))


_HISTORY = _TWO + """, j AS (SELECT b.key AS bk, b.segment AS bs, b.nation AS bn, a.key AS ak, a.segment AS s, a.nation AS n,
  b.key IS NOT NULL AND a.key IS NOT NULL AND (b.segment IS DISTINCT FROM a.segment OR b.nation IS DISTINCT FROM a.nation) AS moved FROM before b FULL JOIN after a ON a.key = b.key),
h AS (SELECT bk AS key, bs AS segment, bn AS nation, TIMESTAMP '2024-01-01' AS valid_from, CASE WHEN moved THEN TIMESTAMP '2024-01-02' END AS valid_to FROM j WHERE bk IS NOT NULL
  UNION ALL SELECT ak, s, n, TIMESTAMP '2024-01-02', NULL FROM j WHERE bk IS NULL OR moved)"""
query("scd2_snapshot", f"{_HISTORY} SELECT * FROM h")(_history)
@query("stored_history", f"{_HISTORY} SELECT * FROM h")
def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of a stored history, the last over an extract that is in already."""
    stored = history.StoredHistory(spark, f"{folders.shared(spark)}/history-{uuid.uuid4().hex}", "key", ["segment", "nation"])
    before, after = _two(spark, sf_dir)
    for extract, at in ((before, datetime(2024, 1, 1)), (after, datetime(2024, 1, 2)), (after, datetime(2024, 1, 3))):
        stored.run(extract, at)
    return stored.table()


query("version_summary", f"{_HISTORY} SELECT count(*) AS versions, count(DISTINCT key) AS keys, count(*) FILTER (WHERE valid_to IS NULL) AS current, count(valid_to) AS superseded FROM h")(lambda s, d: history.version_summary(_history(s, d), "key"))
query("keys_with_history", f"{_HISTORY} SELECT * FROM h WHERE key IN (SELECT key FROM h GROUP BY key HAVING count(*) > 1)")(lambda s, d: history.keys_with_history(_history(s, d), "key"))
query("current_version_audit", f"{_HISTORY}, x AS (SELECT * FROM h UNION ALL SELECT key, segment, nation, valid_from, NULL FROM h WHERE CAST(key AS BIGINT) % 97 = 0 AND valid_to IS NULL) SELECT key, count(*) FILTER (WHERE valid_to IS NULL) AS current FROM x GROUP BY key HAVING count(*) FILTER (WHERE valid_to IS NULL) <> 1")(
    lambda s, d: history.wrong_current((h := _history(s, d)).union(h.where("cast(key as bigint) % 97 = 0 and valid_to is null")), "key")
)
