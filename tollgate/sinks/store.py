"""The raw layer: all text, a partition replaced as a whole, verified before it is seen, and a ledger.

A load writes a partition's rows to a folder of its own, counts them there and compares them
with their source as a multiset.  One commit then names the folder as the partition's and
holds its ledger row, so table and ledger change together: a load that dies anywhere leaves
both as they were, and what it wrote is in nobody's way until ``vacuum``.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.contract import Contract
from tollgate.operators.diff import multiset_difference, uneven_rows
from tollgate.refusals import BackfillStopped, ContentMismatch, LoadCountMismatch, MetadataColumnClash, MissingPartitions, UnknownDialect
from tollgate.sinks import folders
from tollgate.sinks.commits import Commits
from tollgate.sources import files

META = ("_partition", "_source_sha256", "_loaded_at")
LEDGER = "_partition string, dataset string, rows_loaded long, rows_held long, _source_sha256 string, _loaded_at timestamp_ntz"


def raw_schema(contract: Contract) -> T.StructType:
    """The contract's columns as text and three of the layer's own."""
    if set(META) & set(contract.names):
        raise MetadataColumnClash(", ".join(set(META) & set(contract.names)))
    return T.StructType([*[T.StructField(n, T.StringType()) for n in contract.names], T.StructField("_source_sha256", T.StringType()), T.StructField("_loaded_at", T.TimestampNTZType()), T.StructField("_partition", T.StringType())])


def statements(contract: Contract, dialect: str) -> list[str]:
    """DDL of the raw table and the ledger for a dialect: spark, duckdb or snowflake."""
    types = {"spark": ("STRING", "TIMESTAMP_NTZ", "BIGINT"), "duckdb": ("VARCHAR", "TIMESTAMP", "BIGINT"), "snowflake": ("VARCHAR", "TIMESTAMP_NTZ", "NUMBER(38,0)")}
    if dialect not in types:
        raise UnknownDialect(dialect)
    text, time, count = types[dialect]
    raw_schema(contract)
    quote = "`" if dialect == "spark" else '"'
    columns = [f"{quote}{n}{quote} {text}" for n in contract.names] + [f"{quote}{m}{quote} {time if m == '_loaded_at' else text}" for m in META]
    ledger = [f"{quote}_partition{quote} {text}", f"dataset {text}", f"rows_loaded {count}", f"rows_held {count}", f"{quote}_source_sha256{quote} {text}", f"{quote}_loaded_at{quote} {time}"]
    return ["CREATE SCHEMA IF NOT EXISTS raw", f"CREATE TABLE IF NOT EXISTS raw.{contract.dataset} ({', '.join(columns)})", f"CREATE TABLE IF NOT EXISTS raw._ledger ({', '.join(ledger)})"]


class RawStore:
    """raw/, the rows by load and _partition, and commits/, which say what counts, under one path."""

    def __init__(self, spark: SparkSession, path: str, contract: Contract):
        self.spark, self.path, self.contract = spark, path.rstrip("/"), contract
        self.schema = raw_schema(contract)
        self.commits = Commits(spark, f"{self.path}/commits")

    def _folder(self, load: str) -> str:
        return f"{self.path}/raw/_load={load}"

    def _rows(self, loads: list[str]) -> DataFrame:
        if not loads:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField("_load", T.StringType())])
        read = self.spark.read.schema(stored).option("basePath", f"{self.path}/raw")
        return read.parquet(*[self._folder(x) for x in loads]).select(*[f"`{c}`" for c in self.schema.names])

    def table(self, partitions: list[str] | None = None, version: int | None = None) -> DataFrame:
        """All rows, or those of some partitions, whose folders alone are read; of an earlier version, while it is kept."""
        state = self.commits.latest()[1] if version is None else self.commits.read(version)
        return self._rows([e["load"] for p, e in sorted(state.items()) if e["load"] and (partitions is None or p in partitions)])

    def ledger(self) -> DataFrame:
        state = self.commits.latest()[1]
        entries = [(p, e["dataset"], e["rows_loaded"], e["rows_held"], e["_source_sha256"], datetime.fromisoformat(e["_loaded_at"])) for p, e in sorted(state.items())]  # a row a partition
        return self.spark.createDataFrame(entries, LEDGER).orderBy("_partition")

    def load(self, rows: DataFrame, partition: str, verdict: dict, sha256: str, now: datetime) -> int:
        """Put a partition's accepted rows (text columns in the contract's order) in place of what is there; the number of rows."""
        files.check_header(rows.columns, self.contract)
        filled = rows.select(*[F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")).alias(c) for c in rows.columns])
        seen, state = self.commits.latest()
        load = uuid.uuid4().hex
        try:
            meta = {"_source_sha256": F.lit(sha256), "_loaded_at": F.lit(now).cast("timestamp_ntz"), "_partition": F.lit(partition)}
            filled.withColumns(meta).write.partitionBy("_partition").parquet(self._folder(load))
            staged = self._rows([load]).select(*[f"`{c}`" for c in rows.columns])
            count = staged.count()
            if count != verdict["accepted"]:
                raise LoadCountMismatch(f"{partition}: {count} rows of {verdict['accepted']}")
            wrong, total = mismatches(filled, staged)
            if total:
                raise ContentMismatch(f"{partition}: {total} rows differ, among them {wrong}")
            entry = {"load": load if count else None, "dataset": self.contract.dataset, "rows_loaded": count, "rows_held": int(verdict["held"]), "_source_sha256": sha256, "_loaded_at": now.isoformat()}
            self.commits.commit(seen, state | {partition: entry})
        except Exception:
            folders.remove(self.spark, self._folder(load))
            raise
        return count

    def vacuum(self) -> list[str]:
        """Removes the folders of loads that no kept version names, such as those of loads that died; for when nothing is being loaded."""
        return self.commits.forget(lambda state: {f"_load={e['load']}" for e in state.values()}, f"{self.path}/raw")

    def reconcile(self) -> DataFrame:
        return reconcile(self.table(), self.ledger())

    def orphans(self, source: DataFrame) -> DataFrame:
        return orphans(self.table(), source)


def reconcile(table: DataFrame, ledger: DataFrame) -> DataFrame:
    """_partition, in_table, in_ledger where they differ."""
    counted = table.groupBy("_partition").agg(F.count("*").alias("n"))
    kept = ledger.groupBy("_partition").agg(F.sum("rows_loaded").alias("m"))
    both = counted.join(kept, "_partition", "full_outer").select("_partition", F.coalesce("n", F.lit(0)).alias("in_table"), F.coalesce("m", F.lit(0)).alias("in_ledger"))
    return both.where("in_table <> in_ledger")


def orphans(table: DataFrame, source: DataFrame) -> DataFrame:
    """Partitions of the table that the source (partition) doesn't have."""
    return table.select("_partition").distinct().join(source.select(F.col("partition").alias("_partition")), "_partition", "left_anti")


def plan_gaps(spark: SparkSession, start: str, end: str, judged: DataFrame) -> DataFrame:
    """Days of the range, both ends included, that aren't judged (partition)."""
    if start > end:
        raise ValueError("the range ends before it begins")
    days = spark.sql(f"select explode(sequence(date'{start}', date'{end}')) as d").select(F.date_format("d", "yyyy-MM-dd").alias("partition"))
    return days.join(judged.select("partition"), "partition", "left_anti")


def backfill(store: RawStore, start: str, end: str, judged: DataFrame, load) -> list[str]:
    """load(partition) for every day of the range in order; refuses gaps before it begins, and says how far it came if it stops."""
    gaps = [r["partition"] for r in plan_gaps(store.spark, start, end, judged).orderBy("partition").limit(20).collect()]
    if gaps:
        raise MissingPartitions(", ".join(gaps))
    wanted = [r["partition"] for r in judged.where(F.col("partition").between(start, end)).select("partition").distinct().orderBy("partition").collect()]  # a name a day
    done: list[str] = []
    for partition in wanted:
        try:
            load(partition)
        except Exception as e:
            raise BackfillStopped(partition, done, e) from e
        done.append(partition)
    return done


def mismatches(source: DataFrame, stored: DataFrame, limit: int = 5) -> tuple[list, int]:
    """At most ``limit`` rows that one side has more often, the stored side's first, and how many there are."""
    if _sum_of_digests(source) == _sum_of_digests(stored):  # equal multisets, without a shuffle of rows
        return [], 0
    total = uneven_rows(source, stored)
    wrong = multiset_difference(source, stored)
    return [tuple(r) for r in wrong.orderBy(F.desc("side")).limit(limit).collect()] if total else [], total


def _sum_of_digests(rows: DataFrame) -> tuple:
    """A number of rows and a sum that tell multisets apart, null cells from empty ones too."""
    part = F.conv(F.substring(F.sha2(F.to_json(F.struct(*[f"`{c}`" for c in rows.columns])), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return tuple(rows.agg(F.count("*"), F.sum(part)).first())


def lines(rows: DataFrame, leave_out: tuple[str, ...] = ("_loaded_at",)) -> Column:
    """A row's cells as one text; null cells are empty, as they are in a file."""
    return F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in rows.columns if c not in leave_out])


def fingerprint(rows: DataFrame, leave_out: tuple[str, ...] = ("_loaded_at",)) -> DataFrame:
    """rows, digest (12 hex digits): of the multiset of rows, in any order, for tables of any size.

    Every row's digest is made where the row is and sums are added up, so nothing is sorted or
    gathered; equal tables have equal digests however they are stored.
    """
    part = F.conv(F.substring(F.sha2(lines(rows, leave_out), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("rows"), F.substring(F.sha2(F.coalesce(F.sum(part), F.lit(0)).cast("string"), 256), 1, 12).alias("digest"))


def stamp(rows: DataFrame) -> str:
    """``rows:digest`` of a table."""
    r = fingerprint(rows).first()
    return f"{r['rows']}:{r['digest']}"
