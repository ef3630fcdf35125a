"""Folders in whatever store Spark writes to: what a run needs beside Spark's own readers and writers."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def escaped(value: str) -> str:
    """A partition's value as it stands in a folder's name."""
    # Spark writes these characters as their codes, a fixed value of the format
    return re.sub(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, in order; nothing where there is none."""
    fs, at = _at(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def put_in_place(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder to where another may be, which goes; a source that isn't there leaves an empty folder, as a table without rows does."""
    fs, at = _at(spark, target)
    remove(spark, target)
    fs.mkdirs(at.getParent())
    if not exists(spark, source):
        fs.mkdirs(at)
    elif not fs.rename(_at(spark, source)[1], at):
        raise OSError(f"{source} couldn't be moved to {target}")


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, read by the driver alone."""
    fs, at = _at(spark, path)
    jvm = spark._jvm.java.io
    reader = jvm.BufferedReader(jvm.InputStreamReader(fs.open(at), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file whole or not at all; False, and nothing done, where there is one already."""
    fs, at = _at(spark, path)
    fs.mkdirs(at.getParent())
    draft = _at(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")[1]
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, at, options)  # refuses a target that is there
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    return True


def shared(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, and only where that is unset (a local session) one of this process."""
    import atexit
    import shutil
    import tempfile

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="tollgate-")
        spark.sparkContext.setCheckpointDir(root)
        atexit.register(shutil.rmtree, root.removeprefix("file://"), True)
    return root.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, so that what follows computes it once and survives lost executors."""
    path = f"{shared(df.sparkSession)}/tollgate-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
