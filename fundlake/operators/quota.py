"""Credit quotas: month-to-date usage against trigger levels.

Exact crossing times without one giant window.  Usage is summed per
(warehouse, minute) before anything else; only those totals are doubled for
the account-wide monitor.  A running total over a monitor's minutes (at most
44,640 a month) tells in which minutes a level can be crossed: the total
before the minute is below it, and the minute's positive credits could lift it
that far.  Those minutes are opened up in two steps - pieces of one time and
one range of ids first, then rows - so neither an account-wide monitor nor a
bulk load with a single timestamp lands in one task.

Credits may be negative (corrections): a level reached and undone again is
still found, at the row that first reached it.  The plan of ``quota_status`` is
lazy and leaves every join to the planner; ``quota_walk`` gives the same rows
from one written, ordered copy of the log, which is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.operators.slices import SLICE, carried, sliced

# Monitors and their triggers (percent of quota -> action).
# warehouse None = account-wide monitor covering every warehouse.
MONITORS = (
    # (monitor, warehouse, monthly credit quota)
    ("ACCOUNT_MONITOR", None, 50.0),
    ("RM_LOAD_WH", "LOAD_WH", 10.0),
    ("RM_TRANSFORM_WH", "TRANSFORM_WH", 20.0),
    ("RM_REPORTING_WH", "REPORTING_WH", 10.0),
)
TRIGGERS = (
    ("ACCOUNT_MONITOR", 60, "NOTIFY"),
    ("ACCOUNT_MONITOR", 80, "NOTIFY"),
    ("ACCOUNT_MONITOR", 95, "SUSPEND"),
    ("ACCOUNT_MONITOR", 100, "SUSPEND_IMMEDIATE"),
    ("RM_LOAD_WH", 75, "NOTIFY"),
    ("RM_LOAD_WH", 100, "SUSPEND"),
    ("RM_TRANSFORM_WH", 75, "NOTIFY"),
    ("RM_TRANSFORM_WH", 90, "NOTIFY"),
    ("RM_TRANSFORM_WH", 100, "SUSPEND"),
    ("RM_REPORTING_WH", 75, "NOTIFY"),
    ("RM_REPORTING_WH", 100, "SUSPEND"),
)

MONITOR_SCHEMA = "monitor string, warehouse_name string, quota double"
TRIGGER_SCHEMA = "monitor string, level int, action string"


def _config(spark, rows, schema: str) -> DataFrame:
    """A few literal rows as a local relation, whose size the planner knows."""
    import pyarrow as pa
    types = {"string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    columns = [c.split() for c in schema.split(", ")]
    values = list(zip(*rows)) or [()] * len(columns)
    return spark.createDataFrame(pa.table({c: pa.array(v, types[t]) for (c, t), v in zip(columns, values)}), schema)


def monitors_frame(spark, monitors=MONITORS) -> DataFrame:
    return _config(spark, monitors, MONITOR_SCHEMA)


def triggers_frame(spark, triggers=TRIGGERS) -> DataFrame:
    return _config(spark, triggers, TRIGGER_SCHEMA)


# Ids that share a piece of a large minute.
PIECE_IDS = 65_536
CELL = ["monitor", "month", "level"]


def _openings(totals: DataFrame, within: list[str], order: str) -> DataFrame:
    """Of cells with a ``total`` and a ``gain`` (their positive credits), those
    in which the running total can first reach ``need``.

    ``base`` is the running total before the group's first cell, ``fresh``
    whether nothing at all came before it; both are carried on for the cell.
    """
    w = Window.partitionBy(*within).orderBy(order)
    so_far = F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = totals.select("*", (F.col("base") + so_far - F.col("total")).alias("_base"),
                           (F.col("fresh") & (F.row_number().over(w) == 1)).alias("_fresh"))
    return (before.drop("base", "fresh").withColumnsRenamed({"_base": "base", "_fresh": "fresh"})
            .where((F.col("fresh") | (F.col("base").cast("double") < F.col("need")))
                   & ((F.col("base") + F.col("gain")).cast("double") >= F.col("need")))
            .drop("total", "gain"))


def quota_status(usage: DataFrame, monitors: DataFrame, triggers: DataFrame,
                 id_col: str = "meter_id", bucket: str = "minute") -> DataFrame:
    """One row per (monitor, month) with usage:

    used_credits, quota, pct_used (NULL for a quota of zero), highest trigger
    level reached, its action and the exact time the running total first
    reached it.

    ``usage``: (``id_col``, warehouse_name, start_time, credits_used).
    ``monitors``/``triggers``: configuration tables.
    """
    ts_type = usage.schema["start_time"].dataType   # truncations keep this type
    numbered = isinstance(usage.schema[id_col].dataType, T.IntegralType)
    id_range = F.floor(F.col(id_col) / PIECE_IDS) if numbered else F.lit(0)
    rows = usage.select(
        F.col(id_col).alias("_id"), "warehouse_name", "start_time", F.col("credits_used").alias("credits"),
        F.date_trunc(bucket, F.col("start_time")).cast(ts_type).alias("bucket"),
        F.struct(F.col("start_time").alias("t"), id_range.alias("r")).alias("piece"))
    gain = F.greatest(F.col("credits"), F.lit(0).cast(usage.schema["credits_used"].dataType))

    scope = monitors.select("monitor", "quota", F.coalesce(F.col("warehouse_name"), F.lit("*")).alias("scope"))
    cells = rows.groupBy("warehouse_name", "bucket").agg(F.sum("credits").alias("total"), F.sum(gain).alias("gain"))
    totals = (cells.withColumn("scope", F.explode(F.array("warehouse_name", F.lit("*")))).join(scope, "scope")
              .groupBy("monitor", "quota", "scope", "bucket")
              .agg(F.sum("total").alias("total"), F.sum("gain").alias("gain"))
              .withColumn("month", F.date_trunc("month", F.col("bucket")).cast(ts_type)))
    monthly = totals.groupBy("monitor", "quota", "month").agg(F.sum("total").alias("used_credits"))

    levels = triggers.select("monitor", "level", "action")
    need = F.col("quota") * F.col("level") / F.lit(100.0)
    minutes = _openings(
        totals.join(levels, "monitor").select(
            *CELL, "action", "scope", "bucket", "total", "gain", need.alias("need"),
            F.lit(0).cast("decimal(38,6)").alias("base"), F.lit(True).alias("fresh")), CELL, "bucket")

    def inside(opened: DataFrame, *on: str) -> DataFrame:
        return rows.join(opened, list(on)).where(
            (F.col("scope") == "*") | (F.col("scope") == F.col("warehouse_name")))

    keys = [*CELL, "action", "scope", "need", "base", "fresh", "bucket"]
    pieces = _openings(
        inside(minutes, "bucket").groupBy(*keys, "piece").agg(
            F.sum("credits").alias("total"), F.sum(gain).alias("gain")), [*CELL, "bucket"], "piece")
    walk = Window.partitionBy(*CELL, "bucket", "piece").orderBy("start_time", "_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hits = (inside(pieces, "bucket", "piece")
            .withColumn("run", F.col("base") + F.sum("credits").over(walk))
            .where(F.col("run").cast("double") >= F.col("need"))
            .groupBy(*CELL, "action")
            .agg(F.min_by("start_time", F.struct("start_time", "_id")).alias("crossed_at")))
    top = hits.groupBy("monitor", "month").agg(
        F.max_by(F.struct("level", "action", "crossed_at"), "level").alias("top"))

    return _status(monthly, top)


def quota_walk(usage: DataFrame, monitors: DataFrame, triggers: DataFrame,
               id_col: str = "meter_id", slices: int | None = None) -> DataFrame:
    """The same rows as ``quota_status``, by a distributed prefix sum.

    The log is put in (time, id) order once: range slices, written (so this
    runs a job when called).  Every slice is summed per month and warehouse;
    running totals over the slices are each slice's ``base``.  A level can only be
    reached first in a slice whose base is below it and whose positive credits
    lift it that far; only those slices are read again, and a running sum inside
    them finds the rows.  A task holds one slice at most, whatever a single
    monitor, minute or timestamp holds, and no join depends on broadcasting.
    """
    ts_type = usage.schema["start_time"].dataType
    rows = usage.select(
        F.col(id_col).alias("_id"), "warehouse_name", "start_time", F.col("credits_used").alias("credits"),
        F.date_trunc("month", F.col("start_time")).cast(ts_type).alias("month"))
    log = sliced(rows, [F.col("start_time"), F.col("_id")], slices, "quota-log").rows
    gain = F.greatest(F.col("credits"), F.lit(0).cast(usage.schema["credits_used"].dataType))

    scope = monitors.select("monitor", "quota", F.coalesce(F.col("warehouse_name"), F.lit("*")).alias("scope"))
    cells = log.groupBy(SLICE, "month", "warehouse_name").agg(
        F.sum("credits").alias("total"), F.sum(gain).alias("gain"))
    totals = (cells.withColumn("scope", F.explode(F.array("warehouse_name", F.lit("*")))).join(scope, "scope")
              .groupBy("monitor", "quota", "scope", "month", SLICE)
              .agg(F.sum("total").alias("total"), F.sum("gain").alias("gain")))
    run = Window.partitionBy("monitor", "month").orderBy(SLICE)
    totals = carried(totals, "total", "base", ["monitor", "month"]).withColumn("fresh", F.row_number().over(run) == 1)

    need = F.col("quota") * F.col("level") / F.lit(100.0)
    reach = (totals.join(triggers.select("monitor", "level", "action"), "monitor").withColumn("need", need)
             .where((F.col("fresh") | (F.col("base").cast("double") < F.col("need")))
                    & ((F.col("base") + F.col("gain")).cast("double") >= F.col("need")))
             .groupBy("monitor", "scope", "month", SLICE, "base")
             .agg(F.collect_list(F.struct("level", "action", "need")).alias("levels")))
    walk = Window.partitionBy("monitor", "month", SLICE).orderBy("start_time", "_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hits = (log.join(reach, ["month", SLICE])
            .where((F.col("scope") == "*") | (F.col("scope") == F.col("warehouse_name")))
            .withColumn("run", (F.col("base") + F.sum("credits").over(walk)).cast("double"))
            .withColumn("hit", F.explode(F.filter("levels", lambda x: F.col("run") >= x["need"])))
            .groupBy("monitor", "month", "hit.level", "hit.action")
            .agg(F.min_by("start_time", F.struct("start_time", "_id")).alias("crossed_at")))
    top = hits.groupBy("monitor", "month").agg(
        F.max_by(F.struct("level", "action", "crossed_at"), "level").alias("top"))
    monthly = totals.groupBy("monitor", "quota", "month").agg(F.sum("total").alias("used_credits"))
    return _status(monthly, top)


def _status(monthly: DataFrame, top: DataFrame) -> DataFrame:
    out = monthly.join(top, ["monitor", "month"], "left")
    return out.select(
        "monitor", "month", "used_credits", "quota",
        (F.try_divide(F.col("used_credits").cast("double"), F.col("quota")) * 100).alias("pct_used"),
        F.col("top.level").alias("level_reached"),
        F.col("top.action").alias("action"),
        F.col("top.crossed_at").alias("crossed_at"))


def budget_status(usage: DataFrame, limit: float, id_col: str = "meter_id",
                  name: str = "ACCOUNT_BUDGET") -> DataFrame:
    """Monthly spend against a spending limit; notify-only at 100 %."""
    spark = usage.sparkSession
    mons = monitors_frame(spark, [(name, None, float(limit))])
    trig = triggers_frame(spark, [(name, 100, "NOTIFY")])
    return quota_walk(usage, mons, trig, id_col=id_col)
