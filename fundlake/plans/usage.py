"""Usage and spend analytics over metering, query and storage logs.

``now`` is a Column (a literal timestamp or a scalar subquery) so time
windows become plain pushed-down filters on ``start_time``; logs stored
partitioned by day are pruned to the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions.text import preview
from fundlake.operators.topk import top_k


def credits_by_warehouse(metering: DataFrame, now: Column, days: int = 7,
                         usd_per_credit: float = 1.0) -> DataFrame:
    recent = metering.where(F.col("start_time") >= now - F.make_dt_interval(F.lit(days)))
    out = recent.groupBy("warehouse_name").agg(F.sum("credits_used").alias("_c"))
    return (out.select("warehouse_name",
                       F.round("_c", 3).alias("credits_used"),
                       F.round(F.col("_c") * F.lit(usd_per_credit), 2).alias("approx_usd"))
            .orderBy(F.col("credits_used").desc_nulls_first()))


def daily_credits(metering: DataFrame, now: Column, days: int = 14) -> DataFrame:
    recent = metering.where(F.col("start_time") >= now - F.make_dt_interval(F.lit(days)))
    # date_trunc yields a session-time-zone timestamp; keep the log's own
    # type (a wall-clock timestamp stays wall-clock).
    day = F.date_trunc("day", "start_time").cast(metering.schema["start_time"].dataType)
    return (recent.groupBy(day.alias("day"))
            .agg(F.round(F.sum("credits_used"), 3).alias("credits"))
            .orderBy("day"))


def slowest_queries(history: DataFrame, now: Column, hours: int = 24, k: int = 10) -> DataFrame:
    window = history_between(history, now - F.make_dt_interval(F.lit(0), F.lit(hours)), now)
    shown = window.select(
        "query_id", preview("query_text", 60).alias("query_preview"), "warehouse_name",
        F.round(F.col("total_elapsed_time") / 1000, 1).alias("seconds"),
        "execution_status", "total_elapsed_time")
    return top_k(shown, "total_elapsed_time", k, descending=True, nulls_last=False,
                 tie_break=("query_id",)).drop("total_elapsed_time")


def storage_by_schema(storage: DataFrame) -> DataFrame:
    return (storage.groupBy("table_schema")
            .agg(F.round(F.sum("active_bytes") / 1024 / 1024, 2).alias("mb_used"))
            .orderBy(F.col("mb_used").desc_nulls_first(), "table_schema"))


def history_between(history: DataFrame, start: Column | None = None,
                    end: Column | None = None) -> DataFrame:
    """Query-history rows whose start_time lies in [start, end] (either
    bound optional) - a pushed-down range filter."""
    out = history
    if start is not None:
        out = out.where(F.col("start_time") >= start)
    if end is not None:
        out = out.where(F.col("start_time") <= end)
    return out


def storage_from_files(spark, roots: dict) -> DataFrame:
    """Storage per schema measured from the files themselves: a
    ``binaryFile`` listing of each root (content never read) gives
    (table_schema, active_bytes) rows for ``storage_by_schema``."""
    parts = [spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path)
             .select(F.lit(schema).alias("table_schema"), F.col("length").alias("active_bytes"))
             for schema, path in roots.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
