"""Type 2 history by the check strategy: a row's versions, closed when a watched column moves; rows that go stay open."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.refusals import NoHistory
from tollgate.sinks import folders
from tollgate.sinks.commits import Commits

FROM, TO = "valid_from", "valid_to"


def begun(source: DataFrame, now: Column) -> DataFrame:
    return source.withColumns({FROM: now, TO: F.lit(None).cast("timestamp_ntz")})


def snapshot(history: DataFrame | None, source: DataFrame, key: str, watched: list[str], now: Column) -> DataFrame:
    """The next state of the history: one full join of open versions and the source."""
    if history is None:
        return begun(source, now)
    columns = source.columns
    closed = history.where(F.col(TO).isNotNull())
    old = history.where(F.col(TO).isNull()).select(F.col(key).alias("_k"), F.struct(*columns, FROM).alias("_old"))
    new = source.select(F.col(key).alias("_k2"), F.struct(*columns).alias("_new"))
    both = old.join(new, F.col("_k") == F.col("_k2"), "full_outer")
    moved = F.lit(False)
    for c in watched:
        moved = moved | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    moved = F.col("_old").isNotNull() & F.col("_new").isNotNull() & moved
    version = lambda side, start, end: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], start.alias(FROM), end.cast("timestamp_ntz").alias(TO))
    kept = F.when(F.col("_old").isNotNull(), version("_old", F.col(f"_old.{FROM}"), F.when(moved, now)))
    opened = F.when(F.col("_old").isNull() | moved, version("_new", now, F.lit(None)))
    return closed.select(*columns, FROM, TO).union(both.select(F.explode(F.array_compact(F.array(kept, opened))).alias("v")).select("v.*"))


class StoredHistory:
    """A history under one path, in two parts: closed versions, to which runs only add, and open ones, which a run reads and writes again.

    Both parts of a run are one write, and a commit names them, so a run that dies leaves the
    history as it was; a run over an extract that is in already changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, watched: list[str], fanout: int = 16):
        self.spark, self.path, self.key, self.watched, self.fanout = spark, path.rstrip("/"), key, watched, fanout
        self.commits = Commits(spark, f"{self.path}/commits")

    def _part(self, run: str, open_: bool) -> str:
        return f"{self.path}/versions/_run={run}/_open={str(open_).lower()}"

    def _read(self, schema: str, paths: list[str]) -> DataFrame | None:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths) if paths else None

    def _write(self, versions: DataFrame) -> str:
        run = uuid.uuid4().hex
        versions.withColumn("_open", F.when(F.col(TO).isNull(), "true").otherwise("false")).write.partitionBy("_open").parquet(f"{self.path}/versions/_run={run}")
        return run

    def table(self) -> DataFrame:
        """All versions; refuses a history that no run has begun."""
        state = self.commits.latest()[1]
        if not state:
            raise NoHistory(self.path)
        paths = [self._part(r, False) for r in state["closed"]] + [self._part(r, True) for r in state["open"]]
        found = self._read(state["schema"], paths)
        return found if found is not None else self.spark.createDataFrame([], T.StructType.fromJson(json.loads(state["schema"])))

    def run(self, source: DataFrame, now: datetime) -> None:
        """Takes in an extract: versions whose watched columns moved are closed and followed by new ones, and new keys begin."""
        seen, state = self.commits.latest()
        old = self._read(state["schema"], [self._part(r, True) for r in state["open"]]) if state else None
        after = snapshot(old, source, self.key, self.watched, F.lit(now).cast("timestamp_ntz"))
        run = self._write(after)
        there = {o: [run] if folders.exists(self.spark, self._part(run, o)) else [] for o in (True, False)}
        self.commits.commit(seen, {"open": there[True], "closed": [*(state["closed"] if state else []), *there[False]], "schema": after.schema.json()})
        if len(self.commits.latest()[1]["closed"]) > self.fanout:
            self.compact()

    def compact(self) -> None:
        """The closed versions of many runs as one part."""
        seen, state = self.commits.latest()
        closed = self._read(state["schema"], [self._part(r, False) for r in state["closed"]])
        if closed is not None:
            self.commits.commit(seen, state | {"closed": [self._write(closed)]})

    def vacuum(self) -> list[str]:
        """Removes what no kept version names; for when no run is at work."""
        return self.commits.forget(lambda state: {f"_run={r}" for r in (*state["open"], *state["closed"])}, f"{self.path}/versions")


def version_summary(history: DataFrame, key: str) -> DataFrame:
    """versions, keys, current, superseded; refuses a history without versions."""
    if history.isEmpty():
        raise NoHistory("no versions")
    return history.agg(F.count("*").alias("versions"), F.countDistinct(key).alias("keys"), F.count_if(F.col(TO).isNull()).alias("current"), F.count_if(F.col(TO).isNotNull()).alias("superseded"))


def keys_with_history(history: DataFrame, key: str) -> DataFrame:
    """All versions of keys that have more than one, by key and beginning."""
    many = history.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
    return history.join(many, key, "left_semi").orderBy(key, FROM)


def wrong_current(history: DataFrame, key: str) -> DataFrame:
    """key, current: keys with no open version, or with more than one."""
    return history.groupBy(key).agg(F.count_if(F.col(TO).isNull()).alias("current")).where("current <> 1")
