"""Clauses about partitions: how fresh they are and how many rows they have."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.contract import Contract
from tollgate.functions import text
from tollgate.refusals import NothingChecked


def half_open(ts: Column, day: Column) -> Column:
    """Of that day: from its midnight to, and without, the next."""
    return (ts >= day) & (ts < F.date_add(day.cast("date"), 1))


def newest_events(rows: DataFrame, column: str) -> DataFrame:
    """_partition, newest: the latest timestamp that can be read in a partition."""
    return rows.groupBy("_partition").agg(F.max(text.timestamp(F.col(column))).alias("newest"))


def day_counts(rows: DataFrame, column: str) -> DataFrame:
    """partition (the day), rows, newest: what a source has for each day of a timestamp column, texts or timestamps; rows without a time aside.

    A settled day ends just before midnight; one that is still being published stops earlier, which a count alone can't tell.
    """
    kind = dict(rows.dtypes)[column]
    at = text.timestamp(F.col(column)) if kind == "string" else F.col(column).cast("timestamp_ntz")
    timed = rows.select(at.alias("at")).where("at is not null")
    return timed.groupBy(F.date_format("at", "yyyy-MM-dd").alias("partition")).agg(F.count("*").alias("rows"), F.max("at").alias("newest"))


def freshness(contract: Contract, manifest: DataFrame, newest: DataFrame, now: datetime, reference: str | None = None, applies_to: str | None = None) -> DataFrame:
    """partition, clause, verdict, limit, lag_hours, reference for each entry (partition, rows, fetched_at) of a manifest."""
    clock = reference or contract.freshness["reference"]
    scope = applies_to or contract.freshness["applies_to"]
    limit = float(contract.freshness["max_lag_hours"])
    against = {"wall_clock": F.lit(now).cast("timestamp_ntz"), "partition_end": F.date_add(F.to_date("partition"), 1).cast("timestamp_ntz"), "extract": text.timestamp(F.regexp_replace(F.col("fetched_at"), "Z$", ""))}[clock]
    tail = manifest.agg(F.max("partition").alias("_tail"))
    named = newest.select(F.col("_partition").alias("partition"), "newest")
    out = manifest.join(named, "partition", "left").crossJoin(F.broadcast(tail)).withColumn("_clock", against)  # one row
    lag = text.exact_hours(F.col("newest"), F.col("_clock"))
    verdict = (
        F.when(F.lit(scope == "tail") & (F.col("partition") != F.col("_tail")), "not_applicable")
        .when(F.col("newest").isNull(), "no_events")
        .when(F.col("_clock").isNull(), "no_extract_time")
        .when(lag > limit, "stale")
        .otherwise("ok")
    )
    out = out.withColumns({"verdict": verdict, "_lag": lag})
    measured = F.col("verdict").isin("stale", "ok")
    return out.select("partition", F.lit("freshness").alias("clause"), "verdict", F.when(measured, F.lit(limit)).alias("limit"), F.when(measured, F.col("_lag")).alias("lag_hours"), F.lit(clock).alias("reference"))


def volume(contract: Contract, manifest: DataFrame, floor: int | None = None) -> DataFrame:
    """partition, clause, verdict, limit, rows."""
    least = contract.volume["min_rows_per_partition"] if floor is None else floor
    return manifest.select("partition", F.lit("volume").alias("clause"), F.when(F.col("rows") < least, "below_floor").otherwise("ok").alias("verdict"), F.lit(float(least)).alias("limit"), "rows")


def headroom(manifest: DataFrame, floor: int) -> DataFrame:
    """partitions, smallest, largest, floor, gap, ratio, can_bind; refuses no partitions."""
    if manifest.isEmpty():
        raise NothingChecked("no partitions")
    out = manifest.agg(F.count("*").alias("partitions"), F.min("rows").alias("smallest"), F.max("rows").alias("largest"))
    return out.withColumns({"floor": F.lit(floor).cast("long"), "gap": F.col("smallest") - floor, "ratio": F.col("smallest") / F.lit(float(floor)), "can_bind": F.lit(floor) > F.col("smallest")})


def mad(rows: DataFrame, column: str) -> DataFrame:
    """median, mad of a numeric column."""
    middle = rows.agg(F.median(column).alias("median"))
    return rows.crossJoin(F.broadcast(middle)).agg(F.first("median").alias("median"), F.median(F.abs(F.col(column) - F.col("median"))).alias("mad"))  # one row


def fit_floor(manifest: DataFrame, holdout: int = 5, k: float = 3.0) -> DataFrame:
    """median, mad, floor, train, test, fires, rate, resolution (the step that a rate of so few can have), degenerate: a floor of k deviations, fitted before the last ``holdout`` partitions and tried on them."""
    # a row for each day of a feed: small by nature
    placed = manifest.withColumn("_place", F.row_number().over(Window.orderBy(F.desc("partition"))))
    train, test = placed.where(F.col("_place") > holdout), placed.where(F.col("_place") <= holdout)
    if train.isEmpty():
        raise NothingChecked("no partitions to fit on")
    fitted = mad(train, "rows").withColumn("floor", F.col("median") - F.lit(k) * F.col("mad"))
    counts = train.agg(F.count("*").alias("train"))
    tried = test.crossJoin(F.broadcast(fitted)).agg(F.count("*").alias("test"), F.count_if(F.col("rows") < F.col("floor")).alias("fires"))
    out = fitted.crossJoin(counts).crossJoin(tried)
    return out.withColumns({"rate": F.when(F.col("test") > 0, F.col("fires") / F.col("test")), "resolution": F.when(F.col("test") > 0, F.lit(1.0) / F.col("test")), "degenerate": F.col("mad") == 0})


def tally(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count("*").alias("partitions"))
