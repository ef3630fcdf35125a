"""Daily partitions from a paged query API; the getter is injected, and Spark fetches one day a task."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession

from tollgate.refusals import IncompletePartition
from tollgate.sources import files

PAGE = 50_000
Getter = Callable[[str], list[dict]]


def window(column: str, day: date) -> str:
    """From the day's midnight to, and without, the next: a closed range would count midnight twice."""
    return f"{column} >= '{day}T00:00:00' AND {column} < '{day + timedelta(days=1)}T00:00:00'"


def url(base: str, columns: list[str], where: str, order: str, limit: int = PAGE, offset: int = 0) -> str:
    return base + "?" + urlencode({"$select": ",".join(columns), "$where": where, "$order": order, "$limit": limit, "$offset": offset})


def pages(get: Getter, base: str, columns: list[str], ts: str, key: str, day: date, size: int = PAGE) -> Iterator[dict]:
    """All rows of a day by pages in key order; a full last page needs an empty one after it."""
    offset = 0
    while True:
        page = get(url(base, columns, window(ts, day), key, size, offset))
        yield from page
        if len(page) < size:
            return
        offset += size


def expected(get: Getter, base: str, ts: str, day: date) -> int:
    return int(next(iter(get(base + "?" + urlencode({"$select": "count(1) AS n", "$where": window(ts, day)})))) ["n"])


def fetch(spark: SparkSession, get: Getter, base: str, columns: list[str], ts: str, key: str, days: list[date], size: int = PAGE, now: Callable[[], datetime] = datetime.now) -> DataFrame:
    """_partition, _fetched_at and the columns as text, a day a task and a page at a time; refuses a day with another count than the source's."""
    schema = ", ".join(["_partition string", "_fetched_at string", *[f"`{c}` string" for c in columns]])

    def pull(batches):
        import pyarrow as pa

        for batch in batches:
            for text in batch.column("day").to_pylist():
                day, count = date.fromisoformat(text), 0
                at = now().strftime("%Y-%m-%dT%H:%M:%S")  # before the request, so that a lag is never too short
                want = expected(get, base, ts, day)
                found = pages(get, base, columns, ts, key, day, size)
                while rows := list(itertools.islice(found, size)):
                    count += len(rows)
                    yield pa.RecordBatch.from_pydict({"_partition": pa.array([text] * len(rows), pa.string()), "_fetched_at": pa.array([at] * len(rows), pa.string()), **{c: pa.array([None if r.get(c) is None else str(r[c]) for r in rows], pa.string()) for c in columns}})
                if count != want:
                    raise IncompletePartition(f"{day}: {count} rows of {want}")

    wanted = spark.createDataFrame([(str(d),) for d in days], "day string").repartition(max(1, len(days)))
    return wanted.mapInArrow(pull, schema)


def fetch_day(spark: SparkSession, get: Getter, base: str, columns: list[str], ts: str, key: str, day: date, folder: str, size: int = PAGE, now: Callable[[], datetime] = datetime.now) -> DataFrame:
    """Stores a day as CSV under folder and returns its row of the manifest; a day that isn't whole fails before there is one."""
    at = now().strftime("%Y-%m-%dT%H:%M:%S")
    path = f"{folder}/{day}"
    files.write_partition(fetch(spark, get, base, columns, ts, key, [day], size, now), columns, path)
    rows = files.read_csv(spark, path, columns).count()
    return files.entry(spark, path, str(day), rows, expected(get, base, ts, day), at)
