"""CSV partitions as text, verdicts and manifests."""

from __future__ import annotations

import csv
import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.contract import Contract
from tollgate.operators.split import REASONS
from tollgate.refusals import ContentMismatch, HeaderMismatch, NoQuarantine, UnjudgedPartition, WrongPartition
from tollgate.sinks import folders

MANIFEST = "partition string, rows long, expected_rows long, bytes long, sha256 string, fetched_at string, path string"


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names in the first line of the first file by name, read as CSV, so that a quoted comma is part of a name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))
    first = files.agg(F.min("path").alias("path")).first()["path"]
    if first is None:
        return []
    return next(csv.reader([folders.first_line(spark, unquote(first)).removeprefix("\ufeff")]), [])


def check_header(found: list[str], contract: Contract) -> None:
    if found != contract.names:
        raise HeaderMismatch(f"{found} isn't {contract.names}")


def read_csv(spark: SparkSession, paths: str | list[str], names: list[str], strict: bool = True, one_line: bool = False) -> DataFrame:
    """All columns as text and never from folder names; strict: a row with too many or too few fields fails the read.

    one_line: no field holds a line end, so that a large file is split among tasks; else a file is one task.
    """
    read = spark.read.schema(text_schema(names) if strict else text_schema([*names, "_corrupt_record"]))
    options = {"header": "true", "multiLine": str(not one_line).lower(), "quote": '"', "escape": '"', "enforceSchema": "false", "recursiveFileLookup": "true", "mode": "FAILFAST" if strict else "PERMISSIVE"}
    if not strict:
        options |= {"columnNameOfCorruptRecord": "_corrupt_record", "enforceSchema": "true"}
    return read.options(**options).csv(paths)


def read_partition(spark: SparkSession, path: str, names: list[str], partition: str) -> DataFrame:
    return read_csv(spark, path, names).withColumn("_partition", F.lit(partition))


def read_days(spark: SparkSession, paths: str | list[str], names: list[str], strict: bool = True, one_line: bool = False) -> DataFrame:
    """Partitions of many days in one read; _partition is the last day named in a file's path."""
    rows = read_csv(spark, paths, names, strict, one_line)
    return rows.withColumn("_partition", F.element_at(F.regexp_extract_all(F.col("_metadata.file_path"), F.lit(r"(\d{4}-\d{2}-\d{2})"), F.lit(1)), -1))


def numbered(rows: DataFrame, name: str = "_ordinal") -> DataFrame:
    """rows of a read with their places, from 0, in the order of files' names and of lines in a file, however the read is split into tasks.

    Rows are counted by the pieces of files that tasks read, and a row's place is what lies in
    the pieces before it and its place in its own; a row a piece is all that is put in order.
    """
    at, start, i = "__file", "__start", "__i"
    placed = rows.select("*", F.col("_metadata.file_path").alias(at), F.col("_metadata.file_block_start").alias(start), F.monotonically_increasing_id().alias(i))
    pieces = placed.groupBy(at, start).agg(F.count("*").alias("__n"), F.min(i).alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy(at, start).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = pieces.select(F.col(at).alias("__at"), F.col(start).alias("__from"), "__first", before.alias("__before"))
    met = (F.col(at) == F.col("__at")) & (F.col(start) == F.col("__from"))
    return placed.join(starts, met).select(*[f"`{c}`" for c in rows.columns], (F.col("__before") + F.col(i) - F.col("__first")).cast("long").alias(name))


def read_held(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """All quarantined rows under root (``<root>/<partition>/quarantined``), with the partition taken from the path."""
    return read_days(spark, f"{root}/*/quarantined", [*contract.names, REASONS])


def refuse_long_rows(rows: DataFrame) -> DataFrame:
    """rows of a read that isn't strict, without the corrupt column; refuses rows with more fields than columns (a short row's missing fields are null)."""
    names = [c for c in rows.columns if c not in ("_corrupt_record", "_partition")]
    bare = F.regexp_replace("_corrupt_record", '"(?:[^"]|"")*"', "")  # without quoted fields, whose commas and line ends don't count
    commas = F.length(F.regexp_replace(bare, "[^,]", ""))
    # the corrupt column alone can't be asked for
    found = rows.agg(F.count_if(commas >= len(names)).alias("long"), *[F.count(f"`{c}`") for c in names]).first()
    if found["long"]:
        raise ContentMismatch(f"{found['long']} rows have more fields than columns")
    return rows.drop("_corrupt_record")


def read_verdict(spark: SparkSession, directory: str, partition: str) -> dict:
    """report.json beside the accepted rows, of that partition."""
    try:
        rows = spark.read.option("wholetext", "true").text(f"{directory}/report.json").collect()  # one small report
        spark.read.option("recursiveFileLookup", "true").text(f"{directory}/accepted").schema  # noqa: B018
    except Exception as e:
        raise UnjudgedPartition(directory) from e
    verdict = json.loads("".join(r["value"] for r in rows))
    if verdict.get("partition") != partition:
        raise WrongPartition(f"{verdict.get('partition')} isn't {partition}")
    return verdict


def read_split(spark: SparkSession, directory: str, contract: Contract, partition: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, held) with _partition; held has its reasons."""
    try:
        held = read_csv(spark, f"{directory}/quarantined", [*contract.names, REASONS])
        accepted = read_csv(spark, f"{directory}/accepted", contract.names)
    except Exception as e:
        raise NoQuarantine(directory) from e
    return tuple(x.withColumn("_partition", F.lit(partition)) for x in (accepted, held))


def inferred_types(spark: SparkSession, path: str) -> dict[str, str]:
    return dict(spark.read.options(header="true", inferSchema="true", recursiveFileLookup="true").csv(path).dtypes)


def type_disagreements(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Columns whose inferred types differ between files, with the types; refuses no files."""
    if not paths:
        raise NoQuarantine("no files")
    found: dict[str, set[str]] = {}
    for p in paths:
        for c, t in inferred_types(spark, p).items():
            found.setdefault(c, set()).add(t)
    return {c: sorted(t) for c, t in sorted(found.items()) if len(t) > 1}


def refuse_mixed(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The types that all files agree on; refuses a set of files of which one would be read otherwise."""
    unlike = type_disagreements(spark, paths)
    if unlike:
        raise ContentMismatch("; ".join(f"{c}: {', '.join(t)}" for c, t in unlike.items()))
    return inferred_types(spark, paths[0])


def inference_damage(spark: SparkSession, paths: list[str], names: list[str] | None = None) -> DataFrame:
    """column, type, changed: for every column, how many cells change if all files are read with the first one's inferred types."""
    if len(paths) < 2:
        raise NoQuarantine("two files at least")
    types = inferred_types(spark, paths[0])
    plain = read_csv(spark, paths, names or list(types))
    cast = plain.select(*[F.col(f"`{c}`").try_cast(types.get(c, "string")).cast("string").alias(c) for c in plain.columns])
    # one aggregation for all columns: how often each column has each value, before and after
    long = lambda df, n: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in df.columns])).alias("v")).select("v.column", "v.value", F.lit(n).alias("n"))
    cells = long(plain, 1).union(long(cast, -1)).groupBy("column", "value").agg(F.sum("n").alias("n"))
    changed = cells.groupBy("column").agg((F.sum(F.abs("n")) / 2).cast("long").alias("changed"))
    known = spark.createDataFrame([(c, types.get(c)) for c in plain.columns], "column string, type string")
    return known.join(changed, "column", "left").select("column", "type", F.coalesce("changed", F.lit(0)).alias("changed"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row a partition; empty where there is no file."""
    try:
        read = spark.read.schema(f"partitions array<struct<{MANIFEST.replace(' string', ':string').replace(' long', ':long')}>>").option("multiLine", "true").json(path)
        return read.select(F.explode("partitions").alias("p")).select("p.*")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], MANIFEST)


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with the partitions of new replaced, in order."""
    return old.join(new.select("partition"), "partition", "left_anti").unionByName(new).orderBy("partition")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_partition(rows: DataFrame, names: list[str], path: str) -> None:
    """Fixed columns, absent ones empty, line feeds."""
    there = set(rows.columns)
    rows.select(*[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) if n in there else F.lit("").alias(n) for n in names]).write.mode("overwrite").options(header="true", lineSep="\n", emptyValue="", quote='"', escape='"').csv(path)


def entry(spark: SparkSession, path: str, partition: str, rows: int, expected: int, fetched_at: str | None) -> DataFrame:
    """A manifest's row for what is stored under path: sizes are added up, and the digest is of the files' digests in order of their names."""
    found = digests(spark, path).where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))
    # a file's name and digest, not its content, for each file of one partition
    whole = found.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda x: x["sha256"]), ""), 256).alias("sha256"))
    return whole.select(F.lit(partition).alias("partition"), F.lit(rows).cast("long").alias("rows"), F.lit(expected).cast("long").alias("expected_rows"), "bytes", "sha256", F.lit(fetched_at).cast("string").alias("fetched_at"), F.lit(path).alias("path"))


def save_manifest(entries: DataFrame, path: str) -> None:
    """One JSON document with the partitions in order: a row a day of a feed."""
    names = [c.split(" ")[0] for c in MANIFEST.split(", ")]
    whole = entries.agg(F.array_sort(F.collect_list(F.struct(*names))).alias("partitions"))
    whole.coalesce(1).write.mode("overwrite").json(path)


def digest_of(manifest_: DataFrame, partitions: DataFrame) -> DataFrame:
    """partition, sha256 (null where the manifest doesn't know it) of the partitions asked for."""
    return partitions.select("partition").join(manifest_.select("partition", "sha256"), "partition", "left")
