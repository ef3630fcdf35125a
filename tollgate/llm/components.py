"""Connected components of a table of links by alternating stars, without collecting any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.tables import kept


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable, itself included) of every id in links (a, b)."""
    edges = kept(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every larger neighbour is tied to the least one
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every neighbour that isn't larger, and the id itself, too
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(floor.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = kept(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
