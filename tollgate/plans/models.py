"""Typed staging, silver and gold tables of service requests, as a registry of models with their parents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions import text
from tollgate.operators.quantiles import with_quantiles
from tollgate.refusals import Refusal
from tollgate.sinks import folders


QUANTILES = {"median_resolution_hours": 0.5, "p90_resolution_hours": 0.9}


def staging(raw: DataFrame) -> DataFrame:
    """Cast and renamed; what can't be cast is null and shows in the lossless test."""
    return raw.select(
        "unique_key",
        text.fractional_timestamp(F.col("created_date")).alias("created_at"),
        text.fractional_timestamp(F.col("closed_date")).alias("closed_at"),
        "agency", "complaint_type", "descriptor", "incident_zip", "borough", "status",
        text.plain_double(F.col("latitude")).alias("latitude"),
        text.plain_double(F.col("longitude")).alias("longitude"),
        F.col("_partition").alias("partition_day"), "_source_sha256", "_loaded_at",
    )


def silver(stg: DataFrame) -> DataFrame:
    """With created_date, is_closed, resolution_hours (null unless closed after it was created) and has_location; nothing is dropped."""
    hours = F.when(F.col("closed_at").isNull() | (F.col("closed_at") < F.col("created_at")), F.lit(None)).otherwise(text.hours_between(F.col("created_at"), F.col("closed_at")))
    return stg.withColumns({"created_date": F.to_date("created_at"), "is_closed": F.col("status") == "Closed", "resolution_hours": hours, "has_location": F.col("latitude").isNotNull() & F.col("longitude").isNotNull()})


def dim_complaint_type(slv: DataFrame) -> DataFrame:
    """complaint_type, agencies (sorted), agency_count, request_count."""
    return slv.groupBy("complaint_type").agg(F.sort_array(F.collect_set("agency")).alias("agencies"), F.countDistinct("agency").alias("agency_count"), F.count("*").alias("request_count"))


def gold_agency_daily(slv: DataFrame) -> DataFrame:
    """A row for each created_date and agency."""
    counts = slv.groupBy("created_date", "agency").agg(
        F.count("*").alias("request_count"),
        F.count_if("is_closed").alias("closed_count"),
        F.count_if(F.col("status") == "Open").alias("open_count"),
        F.count_if(~F.col("is_closed") & (F.col("status") != "Open")).alias("in_flight_count"),
        F.count_if("has_location").alias("located_count"),
    )
    out = with_quantiles(counts, slv, ["created_date", "agency"], "resolution_hours", QUANTILES)
    return out.select("created_date", "agency", "request_count", "closed_count", "open_count", "in_flight_count", *[text.rounded(F.col(q)).alias(q) for q in QUANTILES], "located_count")


def gold_complaint_resolution(slv: DataFrame, dim: DataFrame) -> DataFrame:
    """A row for each complaint_type, with the agencies that the dimension has for it.

    Requests are aggregated before the join, so the dimension meets a row a type, not a row a request.
    """
    typed = slv.where(F.col("complaint_type").isNotNull())
    counts = typed.groupBy("complaint_type").agg(
        F.count("*").alias("request_count"),
        F.count_if("is_closed").alias("closed_count"),
        F.count_if(F.col("resolution_hours").isNull()).alias("unresolved_count"),
        text.rounded(F.max("resolution_hours")).alias("slowest_resolution_hours"),
    )
    by_type = with_quantiles(counts, typed, ["complaint_type"], "resolution_hours", QUANTILES)
    columns = ["complaint_type", "request_count", "closed_count", "unresolved_count", *[text.rounded(F.col(q)).alias(q) for q in QUANTILES], "slowest_resolution_hours"]
    return by_type.select(*columns).join(dim.select("complaint_type", "agencies", "agency_count"), "complaint_type")


def history_source(stg: DataFrame) -> DataFrame:
    """What the history keeps of a request."""
    return stg.select("unique_key", "created_at", "closed_at", "status", "agency", "complaint_type", "partition_day", "_source_sha256")


#: name: (parents, function of the parents)
MODELS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "stg_requests": (("raw",), staging),
    "slv_requests": (("stg_requests",), silver),
    "dim_complaint_type": (("slv_requests",), dim_complaint_type),
    "gold_agency_daily": (("slv_requests",), gold_agency_daily),
    "gold_complaint_resolution": (("slv_requests", "dim_complaint_type"), gold_complaint_resolution),
}


def layers(models: dict[str, tuple[tuple[str, ...], Callable]] = MODELS, sources: tuple[str, ...] = ("raw",)) -> list[list[str]]:
    """Names by depth, sources first; refuses a parent that is neither, and a cycle."""
    for name, (parents, _) in models.items():
        for p in parents:
            if p not in models and p not in sources:
                raise Refusal(f"{name}: no model or source is called {p}")
    out, done = [sorted(sources)], set(sources)
    while len(done) < len(models) + len(sources):
        ready = sorted(n for n, (parents, _) in models.items() if n not in done and set(parents) <= done)
        if not ready:
            raise Refusal("the models depend on each other in a circle")
        out.append(ready)
        done |= set(ready)
    return out


def build(raw: DataFrame, once: bool = False) -> dict[str, DataFrame]:
    """All models over a raw table, lazily; staging and silver stay views, or with ``once`` silver is written to the shared folder, for marts that read it several times."""
    built = {"raw": raw}
    for layer in layers()[1:]:
        for name in layer:
            parents, f = MODELS[name]
            built[name] = f(*[built[p] for p in parents])
            if once and name == "slv_requests":
                built[name] = folders.kept(built[name], name)
    return built


def materialize(raw: DataFrame, path: str) -> dict[str, DataFrame]:
    """Silver and gold written under path, one folder a model, and read again."""
    spark, built = raw.sparkSession, {"raw": raw}
    for layer in layers()[1:]:
        for name in layer:
            parents, f = MODELS[name]
            built[name] = f(*[built[p] for p in parents])
            if not name.startswith("stg"):
                built[name].write.mode("overwrite").parquet(f"{path}/{name}")
                built[name] = spark.read.schema(built[name].schema).parquet(f"{path}/{name}")
    return built


def table_name(model: str) -> str:
    """The layer is the database's name, whatever else is set: staging, silver or gold."""
    layer = {"stg": "staging", "slv": "silver", "dim": "silver", "gold": "gold"}[model.split("_")[0]]
    return f"{layer}.{model}"


def publish(raw: DataFrame) -> dict[str, DataFrame]:
    """All models as catalog objects of their layer: staging as a temporary view, the others as tables."""
    spark, built = raw.sparkSession, {"raw": raw}
    for layer in layers()[1:]:
        for name in layer:
            parents, f = MODELS[name]
            built[name] = f(*[built[p] for p in parents])
            if name.startswith("stg"):
                built[name].createOrReplaceTempView(name)
                continue
            spark.sql(f"create database if not exists {table_name(name).split('.')[0]}")
            built[name].write.mode("overwrite").saveAsTable(table_name(name))
            built[name] = spark.table(table_name(name))
    return built


def published_gold(spark) -> dict[str, DataFrame]:
    """The tables of every database whose name begins with gold, by database and table; refuses none."""
    names = [(d.name, t.name) for d in spark.catalog.listDatabases() if d.name.startswith("gold") for t in spark.catalog.listTables(d.name) if not t.isTemporary]
    if not names:
        raise Refusal("the catalog has no gold table")
    return {f"{d}.{t}": spark.table(f"`{d}`.`{t}`") for d, t in sorted(names)}


def gold_digest(built: dict[str, DataFrame]) -> DataFrame:
    """table, rows, digest of every gold table, and the requests that its rows are of; refuses none."""
    from tollgate.sinks.store import fingerprint

    total = lambda df: df.agg(F.coalesce(F.sum("request_count"), F.lit(0)).alias("requests"))
    found = [fingerprint(df).crossJoin(total(df)).select(F.lit(n).alias("table"), "*") for n, df in sorted(built.items()) if n.startswith("gold")]  # one row each
    if not found:
        raise Refusal("no gold table")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out
