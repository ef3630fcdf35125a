"""Reading the input tables, and intermediate results in the folder that all executors share."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH = 16 << 20
CUT = "spark.sql.files.minPartitionNum"
SPARKS = f"{64 << 20}b"  # what the bound is if nobody has set it


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and whole text of every document; a null text is empty."""
    return texts_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where that is unset (a local session) a folder of this process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="tollgate-")
        spark.sparkContext.setCheckpointDir(root)
        atexit.register(shutil.rmtree, root.removeprefix("file://"), True)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; removed when this process ends, if it can be."""
    path = f"{shared_dir(spark)}/tollgate-{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith(("file:", "/")):
        atexit.register(shutil.rmtree, path.removeprefix("file://").removeprefix("file:"), True)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: later steps survive the loss of any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def steady(docs: DataFrame) -> DataFrame:
    """docs as a table that all passes read through the same partitions.

    A table read from files, with whatever columns and filters, is one as long as files are cut
    alike: Spark cuts them by the cores that it has when it plans a read, so that number is
    fixed here for the session (``spark.sql.files.minPartitionNum``, unless it is set).  What
    comes out of anything else, a shuffle or a join among them, is written first.
    """
    spark = docs.sparkSession
    if spark.conf.get(CUT, None) is None:
        spark.conf.set(CUT, str(max(1, spark.sparkContext.defaultParallelism)))
    plan = docs._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.children().head()
    return docs if plan.nodeName() == "LogicalRelation" and docs.inputFiles() else kept(docs, "steady")


def give_back() -> None:
    """Freed memory goes back to the system: workers live on from stage to stage, and what one stage needed isn't kept through the next."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def arrow_map(df: DataFrame, f: Callable, schema: str, whole: bool = False) -> DataFrame:
    """mapInArrow with a function of one batch, or with ``whole`` of all batches of a partition."""
    bound_batches(df.sparkSession)

    def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            give_back()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if whole:
            yield from f(given_back(batches))
        else:
            for batch in given_back(batches):
                yield from f(batch)

    return df.mapInArrow(each, schema)


def bound_batches(spark: SparkSession) -> None:
    """A batch of long texts is cut at ``BATCH`` bytes, unless the session has another bound than Spark's own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == SPARKS:
        spark.conf.set(key, str(BATCH))


def rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)
