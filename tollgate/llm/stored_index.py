"""Incremental substring dedup on a stored index that new batches of documents meet.

The index is log-structured, and outlives the process that made it: two kinds of sorted,
bucketed, immutable runs, of the fingerprints of all documents so far (see ``substrings``)
and of 96-bit hashes of their windows.  A new batch's fingerprints are merge-joined with the
stored ones; those that are shared go back to the partitions that have them, and the windows
under them are verified against the stored window hashes and among each other.  No text of an
earlier batch is read again, and no earlier result changes: a window is removed wherever it
starts in a document with a smaller doc_id, and batches ascend.

A batch's windows are stored once each, without those that are stored already, so runs of
windows have no window in common.  A level with more than ``fanout`` runs is merged into one
run of the next level: a stored row is written again once a level, not once a batch.  Runs are
found by their folders, and versions (``sinks.commits``) name the folders: until ``commit``
the index is what it was, so a batch whose writer died is simply added again.

Cases: as in ``substrings.dedup``, over all batches together; a batch that doesn't begin after
the largest doc_id of all before is refused, so a row repeated in a later batch is too; rows
with a null doc_id keep all words and aren't indexed; a batch without rows changes nothing; a
commit after another writer's is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import parts
from tollgate.llm.substrings import FANOUT, candidates, numbered, prints, whole_copies, window_keys, windows_of, without
from tollgate.llm.tables import arrow_map, kept, rows, steady
from tollgate.sinks.commits import Commits

KINDS = {"prints": {"fp": "long"}, "windows": {"h1": "long", "h2": "int"}}


@dataclass
class Added:
    """A batch that was judged: its kept texts, as ``substrings.dedup`` gives them, and what the index will be."""

    kept: DataFrame
    seen: int
    state: dict


def windows(docs: DataFrame, copies: str, seen: str) -> DataFrame:
    """h1, h2 of the windows of documents that aren't copies, once for each block of texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row in numbered(batches):
            _, _, _, h, at, _, _ = windows_of(block, row, copies)
            h1, h2 = window_keys(h, at)
            order = np.lexsort((h2, h1))
            h1, h2 = h1[order], h2[order]
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            yield rows(h1=pa.array(h1[new]), h2=pa.array(h2[new]))

    return arrow_map(docs.select("doc_id", "text"), parts.guarded(each, seen, whole=True), "h1 long, h2 int", whole=True)


class StoredIndex:
    """The index under a path of the shared file system, made by the first commit."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 0, fanout: int = FANOUT):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.commits = Commits(spark, f"{self.path}/versions")
        self.seen, state = self.commits.latest()
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.state = state or {"buckets": buckets, "last": None, "prints": [], "windows": []}

    def table(self, kind: str, name: str) -> DataFrame:
        """A run, known to this session as a bucketed table over its folder."""
        if not self.spark.catalog.tableExists(name):
            keys = ", ".join(KINDS[kind])
            columns = ", ".join(f"{c} {t}" for c, t in KINDS[kind].items())
            self.spark.sql(f"create table {name} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) into {self.state['buckets']} buckets location '{self.path}/runs/{name}'")
        return self.spark.table(name)

    def _dealt(self, df: DataFrame, kind: str) -> DataFrame:
        return df.select(*KINDS[kind]).repartition(self.state["buckets"], *KINDS[kind])

    def _write(self, dealt: DataFrame, kind: str) -> str:
        name, keys = f"{kind}_{uuid.uuid4().hex}", list(KINDS[kind])
        out = dealt.sortWithinPartitions(*keys).write.bucketBy(self.state["buckets"], *keys).sortBy(*keys)
        out.option("path", f"{self.path}/runs/{name}").saveAsTable(name)
        return name

    def _stored(self, dealt: DataFrame, kind: str) -> DataFrame:
        """Those of the distinct keys, dealt into buckets, that a run has; every run is joined where it lies."""
        out = dealt.where("false")
        for run in self.state[kind]:
            out = out.union(dealt.join(self.table(kind, run["name"]), list(KINDS[kind]), "left_semi"))
        return out.distinct()

    def add(self, docs: DataFrame, columns: tuple[str, ...] = (), spacing: bool = False) -> Added:
        """Judges a batch (doc_id long, text, columns) against all before it, and writes its runs; nothing is in the index until ``commit``."""
        docs = steady(docs.select("doc_id", "text", *columns))
        seen = parts.witnessed(docs)
        lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
        last = self.state["last"]
        if lo is not None and last is not None and lo <= last:
            raise ValueError(f"a batch begins at {lo}, the index ends at {last}")
        copies = parts.write(whole_copies(docs, seen), "copies")

        new = kept(prints(docs, copies, seen=seen), "prints")
        by_print = kept(new.groupBy("fp").agg((F.min("least") < F.max(F.coalesce("most", "least"))).alias("shared")), "by-print")
        run = self._write(self._dealt(by_print, "prints"), "prints")
        asked = by_print.where("shared").select("fp").union(self._stored(self.table("prints", run), "prints")).distinct()
        asked = parts.write(new.join(asked, "fp", "left_semi").select("part", "fp").distinct(), "asked")

        found = kept(candidates(docs, asked, copies, seen), "candidates")
        first = kept(found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "first")
        known = kept(self._stored(self._dealt(first, "windows"), "windows"), "known")
        gone = first.join(known.withColumn("known", F.lit(True)), ["h1", "h2"], "left").where("known or first < last")
        gone = kept(gone.select("h1", "h2", "first", "known"), "gone")
        marks = found.join(gone, ["h1", "h2"]).where("known or doc_id > first").select("part", "row", "pos")
        marks = parts.write(marks, "repeats", ("row",))

        own = self._dealt(windows(docs, copies, seen), "windows").distinct()
        own = self._write(own.join(self._dealt(known, "windows"), ["h1", "h2"], "left_anti"), "windows")
        state = self.state
        if hi is not None:
            state = state | {"last": hi} | {kind: self._levelled(kind, [*state[kind], {"name": name, "level": 0}]) for kind, name in (("prints", run), ("windows", own))}
        return Added(without(docs, marks, copies, seen, columns, spacing), self.seen, state)

    def _levelled(self, kind: str, runs: list[dict]) -> list[dict]:
        """The runs, with those of a level that has too many merged into one of the next."""
        level = 0
        while any(r["level"] >= level for r in runs):
            own = [r for r in runs if r["level"] == level]
            if len(own) > self.fanout:
                merged = self.table(kind, own[0]["name"])
                for r in own[1:]:
                    merged = merged.union(self.table(kind, r["name"]))
                name = self._write(self._dealt(merged, kind).distinct(), kind)
                runs = [r for r in runs if r["level"] != level] + [{"name": name, "level": level + 1}]
            level += 1
        return runs

    def commit(self, added: Added) -> None:
        """Makes a batch part of the index, for when its kept texts are written."""
        self.seen = self.commits.commit(added.seen, added.state)
        self.state = added.state

    def vacuum(self) -> list[str]:
        """Removes the runs that no kept version names, those of batches never committed among them, for when no writer is at work."""
        gone = self.commits.forget(lambda state: {r["name"] for kind in KINDS for r in state[kind]}, f"{self.path}/runs")
        for name in gone:
            self.spark.sql(f"drop table if exists {name}")
        return gone
