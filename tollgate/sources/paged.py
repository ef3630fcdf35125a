"""The paged query API as a Spark data source: ``spark.read.format("paged_days")``, a partition a day.

The getter is a Python function from a URL to a page of rows, given when the source is
registered.  A day is one task: it asks the source how many rows it has, streams the pages,
and fails if another number came, so that Spark tries that day again and no other.  A page
whose request fails is asked for again before that.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tollgate.refusals import IncompletePartition, NothingChecked
from tollgate.sources import api

OPTIONS = ("base", "columns", "timestamp", "key", "start", "end")


@dataclass
class Day(InputPartition):
    day: date


class DaysReader(DataSourceReader):
    def __init__(self, get: api.Getter, options: dict[str, str]):
        missing = [o for o in OPTIONS if not options.get(o)]
        if missing:
            raise NothingChecked(f"options that are missing: {', '.join(missing)}")
        self.get, self.base, self.columns = get, options["base"], options["columns"].split(",")
        self.ts, self.key, self.size, self.tries = options["timestamp"], options["key"], int(options.get("pagesize", api.PAGE)), int(options.get("tries", 3))
        self.start, self.end = date.fromisoformat(options["start"]), date.fromisoformat(options["end"])

    def partitions(self) -> list[Day]:
        return [Day(self.start + timedelta(days=i)) for i in range((self.end - self.start).days + 1)]

    def _get(self, url: str) -> list[dict]:
        for left in reversed(range(self.tries)):
            try:
                return self.get(url)
            except OSError:
                if not left:
                    raise
        raise NothingChecked("no tries")

    def read(self, partition: Day) -> Iterator[pa.RecordBatch]:
        at, count = datetime.now().strftime("%Y-%m-%dT%H:%M:%S"), 0  # before the request, so that a lag is never too short
        want = api.expected(self._get, self.base, self.ts, partition.day)
        found = api.pages(self._get, self.base, self.columns, self.ts, self.key, partition.day, self.size)
        while rows := list(itertools.islice(found, self.size)):
            count += len(rows)
            cells = [pa.array([None if r.get(c) is None else str(r[c]) for r in rows], pa.string()) for c in self.columns]
            yield pa.RecordBatch.from_arrays([pa.array([str(partition.day)] * len(rows)), pa.array([at] * len(rows)), *cells], names=["_partition", "_fetched_at", *self.columns])
        if count != want:
            raise IncompletePartition(f"{partition.day}: {count} rows of {want}")


def register(spark: SparkSession, get: api.Getter, name: str = "paged_days") -> None:
    """Makes ``get`` readable as format ``name``; options: base, columns (by commas), timestamp, key, start, end (days, both in), and pageSize, tries."""

    class Days(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ", ".join(["_partition string", "_fetched_at string", *[f"`{c}` string" for c in self.options.get("columns", "").split(",")]])

        def reader(self, schema) -> DaysReader:
            return DaysReader(get, dict(self.options))

    spark.dataSource.register(Days)
