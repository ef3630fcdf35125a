"""Differences between two extracts, cell by cell on text, and replaying them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.refusals import ContentMismatch, LoadCountMismatch, NothingChecked


def keyed(rows: DataFrame, key: str, ordinal: str | None = None) -> DataFrame:
    """One row a key: the last by ``ordinal``, if there is one."""
    if key not in rows.columns:
        raise NothingChecked(f"no column {key}")
    if ordinal is None:
        return rows.dropDuplicates([key])
    last = rows.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), ordinal).alias("_r"))
    return last.select("_r.*")


def compared(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key, state (same, changed, added, removed), before and after as structs: one full join answers all."""
    columns = [c for c in before.columns if c != key]
    pack = lambda df, name: df.select(key, F.struct(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in columns]).alias(name))
    joined = pack(before, "before").join(pack(after, "after"), key, "full_outer")
    state = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(F.col("before") != F.col("after"), "changed").otherwise("same")
    return joined.withColumn("state", state)


def cells(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key, column, before, after of the cells that moved; refuses two empty extracts."""
    if before.isEmpty() and after.isEmpty():
        raise NothingChecked("both extracts are empty")
    columns = [c for c in before.columns if c != key]
    changed = compared(before, after, key).where("state = 'changed'")
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"before.{c}").alias("before"), F.col(f"after.{c}").alias("after")) for c in columns])
    return changed.select(key, F.explode(F.filter(each, lambda x: x["before"] != x["after"])).alias("c")).select(key, "c.column", "c.before", "c.after")


def counters(moved: DataFrame, key: str) -> DataFrame:
    """column, cells, rows: what moved in each column."""
    return moved.groupBy("column").agg(F.count("*").alias("cells"), F.countDistinct(key).alias("rows"))


def added_removed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    return compared(before, after, key).where("state in ('added', 'removed')").select(key, "state")


def applied(before: DataFrame, moved: DataFrame, removed: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """before with the moved cells and without the removed keys; refuses another row count, a missing key or a cell that isn't what it was."""
    if rows is not None and before.count() != rows:
        raise LoadCountMismatch(f"not {rows} rows")
    columns = [c for c in before.columns if c != key]
    if not moved.join(before.select(key), key, "left_anti").isEmpty():
        raise ContentMismatch("a changed key is missing")
    change = moved.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("before", "after")))).alias("_m"))
    out = before.join(change, key, "left").join(removed.select(key), key, "left_anti")
    wrong = F.lit(False)
    for c in columns:
        was = F.col("_m")[c]["before"]
        wrong = wrong | (was.isNotNull() & (was != F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))))
    if not out.where(wrong).isEmpty():
        raise ContentMismatch("a cell isn't what it was")
    return out.select(key, *[F.coalesce(F.col("_m")[c]["after"], F.col(f"`{c}`")).alias(c) for c in columns])


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """side, and the rows that one has more often than the other, as often as it does.

    Rows of one side count up and of the other down, so that both are read and shuffled once, after equal rows of a task are one.
    """
    columns = [f"`{c}`" for c in a.columns]
    both = a.withColumn("__n", F.lit(1)).union(b.withColumn("__n", F.lit(-1)))
    uneven = both.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    side = F.when(F.col("__n") > 0, "first").otherwise("second")
    return uneven.select(side.alias("side"), *columns, F.explode(F.sequence(F.lit(1).cast("long"), F.abs("__n"))).alias("__i")).drop("__i")


def uneven_rows(a: DataFrame, b: DataFrame) -> int:
    """How many rows ``multiset_difference`` would give, without giving them."""
    both = a.withColumn("__n", F.lit(1)).union(b.withColumn("__n", F.lit(-1)))
    return both.groupBy(*[f"`{c}`" for c in a.columns]).agg(F.sum("__n").alias("__n")).agg(F.coalesce(F.sum(F.abs("__n")), F.lit(0)).alias("n")).first()["n"]


def null_safe_counts(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """differing: half the sum of differences between how often each value, null too, occurs in a column of either."""
    count = lambda df, n: df.groupBy(F.col(column).alias(f"k{n}")).agg(F.count("*").alias(f"n{n}"))
    x, y = count(a, 1), count(b, 2)
    both = x.join(y, x["k1"].eqNullSafe(y["k2"]), "full_outer")
    total = F.sum(F.abs(F.coalesce("n1", F.lit(0)) - F.coalesce("n2", F.lit(0))))
    return both.agg(F.floor(F.coalesce(total, F.lit(0)) / 2).cast("long").alias("differing"))


def recorded(before: DataFrame, after: DataFrame, key: str, partition: str) -> DataFrame:
    """kind (rows_before, rows_after, changed, added, removed), key, column, before, after: everything that a replay of a partition's second extract needs, a row a fact."""
    if before.isEmpty() and after.isEmpty():
        raise NothingChecked("both extracts are empty")
    none = F.lit(None).cast("string")
    shape = lambda kind, key_, column, x, y: [F.lit(partition).alias("partition"), F.lit(kind).alias("kind"), key_.cast("string").alias("key"), column.alias("column"), x.alias("before"), y.alias("after")]
    moved = cells(before, after, key).select(*shape("changed", F.col(key), F.col("column"), F.col("before"), F.col("after")))
    gone = added_removed(before, after, key)
    sides = [gone.where(F.col("state") == s).select(*shape(s, F.col(key), none, none, none)) for s in ("added", "removed")]
    counts = [df.agg(F.countDistinct(key).alias("n")).select(*shape(kind, none, none, F.col("n").cast("string"), none)) for kind, df in (("rows_before", before), ("rows_after", after))]
    out = moved
    for x in (*sides, *counts):
        out = out.union(x)
    return out


def save(diff: DataFrame, path: str) -> None:
    """JSON lines in one order, so that equal diffs are equal files in equal numbers of parts."""
    diff.repartitionByRange("partition", "kind", "key", "column").sortWithinPartitions("partition", "kind", "key", "column").write.mode("overwrite").json(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("partition string, kind string, key string, `column` string, before string, after string").json(path)


def replayed(before: DataFrame, diff: DataFrame, key: str) -> DataFrame:
    """before with a recorded diff done to it; refuses another number of keys than was recorded."""
    rows = diff.where("kind = 'rows_before'").first()
    if rows is None or before.select(key).distinct().count() != int(rows["before"]):
        raise LoadCountMismatch("not the extract that the diff was recorded on")
    named = lambda kind: diff.where(F.col("kind") == kind).withColumnRenamed("key", key)
    return applied(before, named("changed").select(key, "column", "before", "after"), named("removed").select(key), key)
