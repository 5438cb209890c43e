"""Logs by day, the list of table names, and rows per fiscal year."""

import datetime as dt
import glob
import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from fundlake.operators import governance as gov
from fundlake.plans import dashboard, usage
from fundlake.sources.logstore import HistoryStore, MeteringStore, tables_in

METERING = "meter_id long, warehouse_name string, start_time timestamp, credits_used decimal(18,6)"
NOW = dt.datetime(2024, 3, 20, 13, 30)


def metering(spark):
    rnd = random.Random(2)
    return spark.createDataFrame(
        [(i, rnd.choice(["A", "B", None]), NOW - dt.timedelta(minutes=rnd.randrange(60 * 24 * 30)), D(rnd.randrange(-5, 999)) / 100)
         for i in range(1500)] + [(9000, "A", NOW, D(1)), (9001, "A", NOW - dt.timedelta(days=7), D(2))], METERING)


def rows(df):
    return sorted(map(str, df.collect()))


def spoil_other_days(root, kept):
    """Files of all other days become unreadable: a report that opens them fails."""
    n = 0
    for f in glob.glob(f"{root}/rows/day=*/*.parquet"):
        if f.split("day=")[1].split("/")[0] not in kept:
            open(f, "w").write("no parquet")
            n += 1
    for f in glob.glob(f"{root}/rows/day=*/.*.crc"):
        import os
        os.remove(f)
    return n


def test_window_reports_equal_the_log_and_open_one_day(spark, tmp_path):
    log = metering(spark)
    store = MeteringStore(spark, str(tmp_path)).write(log)
    now = F.lit(NOW)
    want = rows(usage.credits_by_warehouse(log, now, 7, 3.0)), rows(usage.daily_credits(log, now, 14))
    assert (rows(store.credits_by_warehouse(now, 7, 3.0)), rows(store.daily_credits(now, 14))) == want
    assert rows(store.credits_by_warehouse(store.newest(), 7, 3.0)) == want[0]
    store.write(log.where(F.col("start_time") >= F.lit(dt.datetime(2024, 3, 18))))       # whole days again
    assert rows(store.credits_by_warehouse(now, 7, 3.0)) == want[0] and store.rows().count() == log.count()
    assert spoil_other_days(tmp_path, {"2024-03-13"}) > 20
    assert rows(store.credits_by_warehouse(store.newest(), 7, 3.0)) == want[0]


HISTORY = ("query_id long, query_text string, user_name string, role_name string, warehouse_name string, "
           "start_time timestamp, total_elapsed_time long, execution_status string")


def history(spark):
    texts = ["select * from STAR.FACT_A", 'select 1 from `star`.`fact_a` a join "x".fact_b b', "update fact_b set c = 1",
             "select 'fact_a'", None, "insert into star.fact_ab select 1"]
    return spark.createDataFrame([(i, texts[i % 6], "u", "r", "W", NOW - dt.timedelta(minutes=37 * i), i * 7919 % 1000, "OK")
                                  for i in range(400)], HISTORY)


def test_table_names(spark):
    got = history(spark).where("query_id < 6").select("query_id", tables_in(F.col("query_text")).alias("t")).collect()
    assert {r.query_id: r.t for r in got} == {0: ["fact_a"], 1: ["fact_a", "fact_b"], 2: ["fact_b"], 3: [], 4: None, 5: ["fact_ab"]}


def test_audit_and_window_of_history(spark, tmp_path):
    log = history(spark)
    store = HistoryStore(spark, str(tmp_path)).write(log)
    got = [r.query_id for r in store.audit("Star.Fact_A", 25).collect()]
    assert got == [i for i in range(400) if i % 6 in (0, 1)][:25]
    like = gov.audit(log.where(F.col("query_id") % 6 != 3).where(F.col("query_id") % 6 != 5), "%fact_a%", 25)
    assert rows(store.audit("fact_a", 25)) == rows(like)
    plan = store.audit("fact_a")._jdf.queryExecution().executedPlan().toString().lower()
    assert "like" not in plan and "pushedfilters: [isnotnull(table_name), equalto(table_name,fact_a)]" in plan
    assert store.audit("nothing").count() == 0
    now = F.lit(NOW)
    want = rows(usage.slowest_queries(log, now))
    assert spoil_other_days(tmp_path, {"2024-03-19", "2024-03-20"}) > 5
    assert rows(usage.slowest_queries(store.between(now - F.make_dt_interval(F.lit(0), F.lit(24)), now), now)) == want


def test_year_rows_give_any_pick(spark, tmp_path):
    rnd = random.Random(5)
    years = ["2019", "2020", "2021", "2022", None]
    equity = spark.createDataFrame([(f"I{rnd.randrange(300)}" if i % 50 else None, rnd.choice(years)) for i in range(900)],
                                   "institution_name string, fiscal_year string")
    lag = spark.createDataFrame([(rnd.choice(years), rnd.randrange(0, 900) / 10 if i % 9 else None) for i in range(300)],
                                "fiscal_year string, avg_days_to_pay double")
    programs = spark.createDataFrame([("Review - x",), ("Stable",)], "flag string")
    rollup = dashboard.year_rollup(equity, lag, str(tmp_path))
    for pick in (None, ["2020"], ["2019", "2022"], ["1990"]):
        assert dashboard.headline_of_years(spark, rollup, programs, pick).collect() == \
            dashboard.headline(spark, equity, lag, programs, pick).collect()
