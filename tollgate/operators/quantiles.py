"""Exact quantiles by group, without a buffer that grows with a group.

Values are counted by group and value, in each task first, so a group of any size is spread
over all tasks.  Counts are added up in two levels: over bins of a group, which are bounded
in number, and within the few bins that hold a quantile's neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins between a number and its double.
FINE = 64
_ZERO = 1100 * FINE  # below every bin of a positive number, so that bins and numbers have one order


def bin_of(value: Column) -> Column:
    """A whole number that never falls as a double grows: about 2 ** 17 different ones a sign."""
    size = F.floor(F.log2(F.abs(value)) * FINE).cast("long") + _ZERO
    most = F.lit(1 << 30).cast("long")
    return F.when(F.isnan(value), most + 1).when(value == math.inf, most).when(value == -math.inf, -most).when(value == 0, F.lit(0).cast("long")).when(value > 0, size).otherwise(-size)


def quantiles(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """keys and, by name, the interpolated quantile at each fraction of a group's values, nulls aside; no row for a group without values."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n")).withColumn("_bin", bin_of(F.col("_v")))
    by_bin = counted.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = by_bin.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(Window.partitionBy(*keys))}).withColumn("_before", F.col("_upto") - F.col("_n"))
    at = {name: F.lit(p) * (F.col("_all") - 1) for name, p in wanted.items()}
    among = lambda place, start, end: (place >= start) & (place < end)
    needed = F.lit(False)
    for place in at.values():
        for side in (F.floor(place), F.ceil(place)):
            needed = needed | among(side, F.col("_before"), F.col("_upto"))
    some = placed.where(needed).select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_bin").alias("_some"), "_before", "_all")
    met = F.col("_bin") == F.col("_some")
    for i, k in enumerate(keys):
        met = met & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    inside = counted.join(some, met)
    running = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_end", F.col("_before") + F.sum("_n").over(running)).withColumn("_start", F.col("_end") - F.col("_n"))
    sides = {}
    for name, place in at.items():
        for side, of in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            sides[f"_{side}_{name}"] = F.max(F.when(among(of, F.col("_start"), F.col("_end")), F.col("_v")))
    found = inside.groupBy(*keys).agg(F.max("_all").alias("_all"), *[c.alias(n) for n, c in sides.items()])
    part = {name: place - F.floor(place) for name, place in at.items()}
    value_of = lambda name: F.when((part[name] == 0) | (F.col(f"_lo_{name}") == F.col(f"_hi_{name}")), F.col(f"_lo_{name}")).otherwise((F.lit(1.0) - part[name]) * F.col(f"_lo_{name}") + part[name] * F.col(f"_hi_{name}"))
    return found.select(*keys, *[value_of(name).alias(name) for name in wanted])


def with_quantiles(groups: DataFrame, rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """groups (a row for each of the keys, null ones too) with the quantiles of rows as more columns."""
    found = quantiles(rows, keys, value, wanted)
    rest = [c for c in groups.columns if c not in keys]
    both = groups.unionByName(found, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in (*rest, *wanted)])
