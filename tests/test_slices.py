"""Ordered slices: row numbers with ties, and the quota walk."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fundlake.operators import quota
from fundlake.operators.keys import surrogate_key
from fundlake.operators.slices import SLICE, sliced

USAGE = "meter_id long, warehouse_name string, start_time timestamp, credits_used decimal(18,6)"


def test_ties_spread_over_slices_and_stay_contiguous(spark):
    n = 9_000
    df = spark.range(n).select((F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id"))).alias("k"),
                               F.col("id").alias("payload"))
    parts = sliced(df, [F.col("k")], 9)
    sizes = [r["count"] for r in parts.rows.groupBy(SLICE).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / 9
    keyed = surrogate_key(df, "k", "key", ranged_partitions=9).collect()
    assert sorted(r.key for r in keyed) == list(range(1, n + 1))
    assert [r.k for r in sorted(keyed, key=lambda r: r.key)] == sorted(r.k for r in keyed)
    hot = sorted(r.key for r in keyed if r.k == 5)
    assert hot == list(range(hot[0], hot[0] + len(hot)))


def _rows(kind):
    rnd = random.Random(kind)
    t0 = dt.datetime(2024, 1, 20)
    whs = ["LOAD_WH", "TRANSFORM_WH", "REPORTING_WH", "ADHOC_WH", None]
    for i in range(600):
        at = {"spread": t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 40)),
              "one instant": t0,
              "corrections": t0 + dt.timedelta(seconds=rnd.choice([0, 0, 1, 59, 3600]) + 7200 * (i % 5))}[kind]
        low = -250 if kind == "corrections" else 0
        yield i * 7919 % 100_003, rnd.choice(whs), at, D(rnd.randint(low, 300)) / D(100)


def brute(rows, monitors, triggers):
    out = {}
    for mon, wh, q in monitors:
        by_month = {}
        for i, w, t, c in sorted(rows, key=lambda r: (r[2], r[0])):
            if wh is None or w == wh:
                by_month.setdefault(t.replace(day=1, hour=0, minute=0, second=0), []).append((t, c))
        for month, xs in by_month.items():
            run, first = D(0), {}
            for t, c in xs:
                run += c
                for m, level, action in triggers:
                    if m == mon and float(run) >= q * level / 100.0:
                        first.setdefault(level, (level, action, t))
            out[mon, month] = (first[max(first)] if first else (None, None, None)) + (float(sum(c for _, c in xs)),)
    return out


def answer(df):
    return {(r.monitor, r.month): (r.level_reached, r.action, r.crossed_at, float(r.used_credits)) for r in df.collect()}


@pytest.mark.parametrize("kind", ["spread", "one instant", "corrections"])
def test_quota_walk_equals_brute_force(spark, kind):
    rows = list(_rows(kind))
    usage = spark.createDataFrame(rows, USAGE).repartition(5)
    monitors = [*quota.MONITORS, ("ZERO", None, 0.0)]
    triggers = [*quota.TRIGGERS, ("ZERO", 100, "SUSPEND")]
    got = quota.quota_walk(usage, quota.monitors_frame(spark, monitors), quota.triggers_frame(spark, triggers), slices=7)
    assert answer(got) == brute(rows, monitors, triggers)


def test_quota_walk_of_no_usage(spark):
    got = quota.quota_walk(spark.createDataFrame([], USAGE), quota.monitors_frame(spark), quota.triggers_frame(spark))
    assert got.count() == 0


def test_a_bulk_load_on_one_instant_is_split_without_broadcasts(spark):
    usage = spark.range(40_000).select(
        F.col("id").alias("meter_id"), F.lit("LOAD_WH").alias("warehouse_name"),
        F.lit(dt.datetime(2024, 5, 1)).alias("start_time"), F.lit(D("0.001")).cast("decimal(18,6)").alias("credits_used"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = quota.quota_walk(usage, quota.monitors_frame(spark), quota.triggers_frame(spark), slices=8)
        got = {r.monitor: (r.level_reached, float(r.used_credits)) for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {"ACCOUNT_MONITOR": (80, 40.0), "RM_LOAD_WH": (100, 40.0)}
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # The log's rows are windowed by monitor, month and slice: no group is larger than a slice.
    sizes = [r["count"] for r in sliced(usage, [F.col("start_time"), F.col("meter_id")], 8).rows.groupBy(SLICE).count().collect()]
    assert max(sizes) <= 2 * 40_000 / 8
