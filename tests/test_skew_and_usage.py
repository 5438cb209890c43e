"""Hot keys (a third of all rows or more on one key) keep results whole
and exact; usage analytics on literal logs."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from fundlake.operators.dedupe import dedupe_first
from fundlake.operators.lookup import flag_orphans
from fundlake.plans import reports, usage


def test_flag_orphans_with_null_and_hot_keys(spark):
    parent = spark.createDataFrame([("HOT",), ("A",)], "application_id string")
    rows = ([(f"n{i}", None) for i in range(600)] + [(f"h{i}", "HOT") for i in range(900)]
            + [("a", "A"), ("z", "Z")])
    child = spark.createDataFrame(rows, "id string, application_id string").repartition(6)
    out = flag_orphans(child, parent, "application_id", "orphan")
    got = dict(out.groupBy("orphan").count().collect())
    assert got == {True: 601, False: 901}
    assert out.count() == len(rows)


def test_a_hot_payment_key_is_split_in_the_final_plan(spark, tmp_path):
    """A third of the payments on one application, nothing broadcast: AQE
    splits the hot partition because no aggregate stands in its way."""
    n = 300_000
    spark.range(n).select(F.concat(F.lit("A"), F.col("id")).alias("application_id")).write.parquet(str(tmp_path / "p"))
    spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("A7")).otherwise(F.concat(F.lit("A"), F.col("id"))).alias(
            "application_id"), F.md5(F.col("id").cast("string")).alias("pad")).write.parquet(str(tmp_path / "c"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = flag_orphans(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p")),
                           "application_id", "orphan", parent_unique=True)
        rows = out.groupBy("orphan").count()
        assert {tuple(r) for r in rows.collect()} == {(False, n)}
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
        salted = flag_orphans(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p")),
                              "application_id", "orphan")
        assert {tuple(r) for r in salted.groupBy("orphan").count().collect()} == {(False, n)}
        assert "_csalt" in salted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_dedupe_hot_key(spark):
    rows = [("HOT", f"{i:05d}") for i in range(2000)] + [("B", "x")]
    df = spark.createDataFrame(rows, "id string, d string").repartition(5)
    assert {tuple(r) for r in dedupe_first(df, "id", ["d"]).collect()} == {
        ("HOT", "00000"), ("B", "x")}


def test_lag_report_with_hot_application(spark):
    rnd = random.Random(3)
    d0 = dt.date(2023, 1, 1)
    apps = [("HOT", 1, d0), ("A2", 2, d0 + dt.timedelta(days=5)), ("A3", 1, None)]
    fa = spark.createDataFrame(apps, "application_id string, institution_key long, "
                                     "submission_date date")
    pays = []
    for i in range(1500):
        app = "HOT" if i < 1200 else rnd.choice(["A2", "A3"])
        day = None if i % 97 == 0 else d0 + dt.timedelta(days=rnd.randint(-10, 60))
        amt = None if i % 89 == 0 else Decimal(rnd.randint(1, 500))
        pays.append((f"P{i}", app, rnd.choice([1, 2]), 1, amt, day, False))
    fd = spark.createDataFrame(pays, "disbursement_id string, application_id string, "
                                     "institution_key long, date_key long, "
                                     "disbursed_amount decimal(38,0), disbursement_date date, "
                                     "orphan_flag boolean").repartition(4)
    t = {"fact_disbursements": fd, "fact_applications": fa,
         "dim_institution": spark.createDataFrame([(1, "One"), (2, "Two")],
                                                  "institution_key long, institution_name string"),
         "dim_date": spark.createDataFrame([(1, "2023")], "date_key long, fiscal_year string")}
    sub = {a: d for a, _, d in apps}
    for valid in (False, True):
        got = {r.institution_name: (r.payments, r.avg_days_to_pay, r.total_disbursed)
               for r in reports.disbursement_lag(t, valid_only=valid).collect()}
        want = {}
        for _, app, inst, _, amt, day, _ in pays:
            lag = None if day is None or sub[app] is None else (day - sub[app]).days
            if valid and (lag is None or lag < 0):
                continue
            name = {1: "One", 2: "Two"}[inst]
            c, lags, total = want.get(name, (0, [], None))
            if amt is not None:
                total = amt if total is None else total + amt
            want[name] = (c + 1, lags + ([lag] if lag is not None else []), total)
        want = {k: (c, round(sum(ls) / len(ls), 1) if ls else None, tot)
                for k, (c, ls, tot) in want.items()}
        assert got == want


def _meter(spark):
    now = dt.datetime(2024, 1, 30, 12)
    rows = [(1, "LOAD_WH", now - dt.timedelta(days=1), Decimal("1.5")),
            (2, "LOAD_WH", now - dt.timedelta(days=8), Decimal("9")),
            (3, "REPORTING_WH", now - dt.timedelta(hours=1), Decimal("0.25")),
            (4, "REPORTING_WH", now - dt.timedelta(days=13, hours=23), Decimal("2"))]
    df = spark.createDataFrame(rows, "meter_id long, warehouse_name string, "
                                     "start_time timestamp, credits_used decimal(18,6)")
    return df, F.lit(now).cast("timestamp")


def test_credits_and_daily(spark):
    m, now = _meter(spark)
    got = [tuple(r) for r in usage.credits_by_warehouse(m, now, 7, 3.0).collect()]
    assert got == [("LOAD_WH", Decimal("1.500"), 4.5), ("REPORTING_WH", Decimal("0.250"), 0.75)]
    days = {r.day.date(): r.credits for r in usage.daily_credits(m, now, 14).collect()}
    assert days == {dt.date(2024, 1, 16): Decimal("2.000"), dt.date(2024, 1, 22): Decimal("9.000"),
                    dt.date(2024, 1, 29): Decimal("1.500"), dt.date(2024, 1, 30): Decimal("0.250")}


def test_slowest_and_storage(spark):
    now = dt.datetime(2024, 1, 30, 12)
    hist = spark.createDataFrame(
        [(i, "x" * 100, "WH", now - dt.timedelta(hours=i), i * 1550, "SUCCESS") for i in range(30)],
        "query_id long, query_text string, warehouse_name string, start_time timestamp, "
        "total_elapsed_time long, execution_status string")
    top = usage.slowest_queries(hist, F.lit(now).cast("timestamp"), 24, 3).collect()
    assert [r.query_id for r in top] == [24, 23, 22]
    assert top[0].seconds == 37.2 and len(top[0].query_preview) == 60
    st = spark.createDataFrame([("A", 3 * 262144), ("A", 262144), ("B", 1048576)],
                               "table_schema string, active_bytes long")
    assert [tuple(r) for r in usage.storage_by_schema(st).collect()] == [("A", 1.0), ("B", 1.0)]


def test_lag_plan_collapses_payments_before_shuffle(spark):
    d0 = dt.date(2023, 1, 1)
    fa = spark.createDataFrame([("A", 1, d0)], "application_id string, institution_key long, "
                                              "submission_date date")
    fd = spark.createDataFrame([("P", "A", 1, 1, Decimal(1), d0, False)],
                               "disbursement_id string, application_id string, "
                               "institution_key long, date_key long, "
                               "disbursed_amount decimal(38,0), disbursement_date date, "
                               "orphan_flag boolean")
    t = {"fact_disbursements": fd, "fact_applications": fa,
         "dim_institution": spark.createDataFrame([(1, "One")],
                                                  "institution_key long, institution_name string"),
         "dim_date": spark.createDataFrame([(1, "2023")], "date_key long, fiscal_year string")}
    plan = reports.disbursement_lag(t, valid_only=True)._jdf.queryExecution() \
        .executedPlan().toString()
    lines = plan.splitlines()
    partial = [i for i, l in enumerate(lines)
               if "HashAggregate(keys=[application_id" in l and "partial_count" in l]
    assert partial, plan
    # the partial aggregate sits below (after, in the printed tree) every
    # exchange on the payment side: nothing is shuffled before it
    first_exchange_above = [i for i, l in enumerate(lines[:partial[0]])
                            if "Exchange hashpartitioning(application_id" in l]
    assert first_exchange_above, plan
