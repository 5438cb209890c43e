"""DataFrame operators on tiny literal frames, with the invariants from
the test plan: dedupe idempotent, keys dense 1..n, no fan-out, restricted
view a subset of the privileged one, no visible masked value below 10."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from fundlake.operators import governance as gov
from fundlake.operators import quota
from fundlake.operators.counts import count_report, metric_counts
from fundlake.operators.dedupe import dedupe_first
from fundlake.operators.keys import surrogate_key
from fundlake.operators.lookup import conform, flag_orphans, lookup_keys
from fundlake.operators.topk import ordered, top_k


def test_dedupe_keeps_lowest_text_nulls_last(spark):
    df = spark.createDataFrame([
        ("A1", "2023-02-01", "x"), ("A1", "01/15/2023", "y"), ("A1", None, "z"),
        ("A2", None, "p"), ("A2", "Jan 1 2023", "q"),
        (None, "b", "n1"), (None, "a", "n2"),
    ], "id string, d string, v string")
    out = {r.id: (r.d, r.v) for r in dedupe_first(df, "id", ["d"]).collect()}
    assert out == {"A1": ("01/15/2023", "y"), "A2": ("Jan 1 2023", "q"), None: ("a", "n2")}
    once = dedupe_first(df, "id", ["d"])
    assert sorted(map(tuple, dedupe_first(once, "id", ["d"]).collect()),
                  key=str) == sorted(map(tuple, once.collect()), key=str)


def test_dedupe_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("d"))
    plan = dedupe_first(df, "k", ["d"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_surrogate_key_dense_both_ways(spark):
    vals = [(f"k{random.Random(i).randint(0, 10**6):07d}",) for i in range(500)]
    df = spark.createDataFrame(vals, "k string").distinct()
    a = {r.k: r.key for r in surrogate_key(df, "k", "key").collect()}
    b = {r.k: r.key for r in surrogate_key(df, "k", "key", ranged_partitions=7).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, len(a) + 1))
    assert [k for k, _ in sorted(a.items(), key=lambda kv: kv[1])] == sorted(a)


def test_ranged_keys_on_a_wide_frame_without_exchange_reuse(spark):
    n = 400_000
    wide = spark.range(n).select(
        F.format_string("k%08d", (F.col("id") * 7919) % n).alias("k"), F.md5(F.col("id").cast("string")).alias("a"),
        (F.col("id") % 13).alias("b"), F.col("id").alias("c")).repartition(6, "a")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = surrogate_key(wide, "k", "key", ranged_partitions=8)
        r = out.agg(F.count("*").alias("n"), F.count_distinct("key").alias("d"), F.min("key").alias("lo"),
                    F.max("key").alias("hi"),
                    F.sum((F.col("key") != F.substring("k", 2, 8).cast("long") + 1).cast("int")).alias("off")).first()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert tuple(r) == (n, n, 1, n, 0) and out.columns == ["key", "k", "a", "b", "c"]


def test_dimensions_of_unknown_size_are_numbered_in_slices(spark):
    from fundlake.plans import star
    inst = spark.createDataFrame([(f"INST-{i:03d}", f"n{i}") for i in range(50)], "institution_id string, institution_name string")
    few = star.dim_institution(inst, max_rows=50)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, star.dim_institution(inst).collect()))


def test_conform_keeps_unknown_rows(spark):
    master = spark.createDataFrame([("INST-001", "North College"), ("INST-002", "South U")],
                                   "institution_id string, institution_name string")
    apps = spark.createDataFrame([("A", "INST-001", "north coll."), ("B", "INST-999", "??"),
                                  ("C", None, "x")],
                                 "app string, institution_id string, institution_name string")
    out = {r.app: r.institution_name for r in
           conform(apps, master, "institution_id", {"institution_name": "institution_name"})
           .collect()}
    assert out == {"A": "North College", "B": None, "C": None}


def test_flag_orphans_never_drops_or_multiplies(spark):
    parent = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "application_id string")
    child = spark.createDataFrame([("p1", "A"), ("p2", "B"), ("p3", "Z"), ("p4", None)],
                                  "id string, application_id string")
    out = {r.id: r.orphan for r in flag_orphans(child, parent, "application_id", "orphan").collect()}
    assert out == {"p1": False, "p2": False, "p3": True, "p4": True}


def test_lookup_keys_left_semantics(spark):
    dim = spark.createDataFrame([(1, "2022"), (2, "2023")], "date_key long, fiscal_year string")
    fact = spark.createDataFrame([("e1", "2023"), ("e2", "2030"), ("e3", None)],
                                 "id string, fiscal_year string")
    out = {r.id: r.date_key for r in
           lookup_keys(fact, [(dim, "fiscal_year", "fiscal_year", "date_key", 10)]).collect()}
    assert out == {"e1": 2, "e2": None, "e3": None}


def test_count_report_one_scan_per_table(spark):
    a = spark.createDataFrame([(1, True), (2, False), (3, True)], "x int, f boolean")
    b = spark.createDataFrame([(1,)], "y int")
    rows = count_report([(a, {"all": None, "flagged": F.col("f")}), (b, {"b rows": None})]) \
        .orderBy("ordinal").collect()
    assert [(r.metric, r.value, r.ordinal) for r in rows] == [
        ("all", "3", 1), ("flagged", "2", 2), ("b rows", "1", 3)]
    assert metric_counts(a, {"n": None}).first().n == 3


def test_ordering_nulls(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "c"), (3.0, "a")], "v double, n string")
    assert [r.n for r in ordered(df, "v", descending=True).collect()][0] == "b"
    assert [r.n for r in top_k(df, "v", 2, tie_break=("n",)).collect()] == ["a", "c"]


# ------------------------------------------------------------ governance ----
def _star(spark):
    dim = spark.createDataFrame([(1, "INST-001"), (2, "INST-002"), (3, "INST-003")],
                                "institution_key long, institution_id string")
    fact = spark.createDataFrame(
        [("e1", 1, 5.0), ("e2", 2, 9.0), ("e3", 2, 10.0), ("e4", None, 50.0), ("e5", 3, 12.0)],
        "enrollment_id string, institution_key long, headcount double")
    ent = spark.createDataFrame([("INSTITUTION_USER", "INST-002")],
                                "role_name string, institution_id string")
    return dim, fact, ent


def test_row_policy_and_mask(spark):
    dim, fact, ent = _star(spark)
    reg = gov.standard_registry(ent, dim, dim_rows=3)
    priv = reg.secure("fact_enrollments", fact, "ANALYST")
    rest = reg.secure("fact_enrollments", fact, "INSTITUTION_USER")
    unknown = reg.secure("fact_enrollments", fact, "SOMEONE")
    assert priv.count() == 5 and unknown.count() == 0
    got = {r.enrollment_id: r.headcount for r in rest.collect()}
    assert got == {"e2": None, "e3": 10.0}
    assert {r.enrollment_id for r in rest.collect()} <= {r.enrollment_id for r in priv.collect()}
    assert rest.where(F.col("headcount") < 10).count() == 0
    reg.detach("fact_enrollments", gov.MaskPolicy)
    assert {r.headcount for r in reg.secure("fact_enrollments", fact, "INSTITUTION_USER")
            .collect()} == {9.0, 10.0}
    reg.detach("fact_enrollments")
    assert reg.secure("fact_enrollments", fact, "INSTITUTION_USER").count() == 5


def test_policy_name_capture_does_not_leak(spark):
    """The entitled-key lookup is joined on renamed columns, so a fact
    column named like the dimension key cannot make the test always true."""
    dim, fact, ent = _star(spark)
    rp = gov.RowPolicy("institution_key", ent, dim)
    assert rp.apply(fact, "INSTITUTION_USER").count() == 2


def test_rows_visible_and_audit(spark):
    dim, fact, ent = _star(spark)
    reg = gov.standard_registry(ent, dim)
    rows = {r.role_name: r.rows_visible for r in
            gov.rows_visible(reg, "fact_enrollments", fact, ["AUDITOR", "INSTITUTION_USER"])
            .collect()}
    assert rows == {"AUDITOR": 5, "INSTITUTION_USER": 2}
    t0 = dt.datetime(2024, 1, 1)
    hist = spark.createDataFrame(
        [(i, "select * from STAR.FACT_APPLICATIONS" if i % 2 else "select 1", "u", "r",
          t0 + dt.timedelta(minutes=i)) for i in range(50)],
        "query_id long, query_text string, user_name string, role_name string, "
        "start_time timestamp")
    out = gov.audit(hist, "%fact_applications%", 20).collect()
    assert len(out) == 20 and out[0].query_id == 49 and all(r.query_id % 2 for r in out)


# ----------------------------------------------------------------- quota ----
def _usage(spark, rows):
    return spark.createDataFrame(rows, "meter_id long, warehouse_name string, "
                                       "start_time timestamp, credits_used decimal(18,6)")


def test_quota_levels_and_crossing_times(spark):
    from decimal import Decimal as D
    t0 = dt.datetime(2024, 1, 1)
    # 30, 40, 47.5, 50 credits of 50 are reached at hours 1, 2, 3, 4.
    rows = [(1, "LOAD_WH", t0 + dt.timedelta(hours=1), D("30")),
            (2, "LOAD_WH", t0 + dt.timedelta(hours=2), D("10")),
            (3, "TRANSFORM_WH", t0 + dt.timedelta(hours=3), D("7.5")),
            (4, "TRANSFORM_WH", t0 + dt.timedelta(hours=4, minutes=5), D("2.5"))]
    mons = spark.createDataFrame([("ACC", None, 50.0)], quota.MONITOR_SCHEMA)
    trig = spark.createDataFrame([("ACC", 60, "NOTIFY"), ("ACC", 80, "NOTIFY"),
                                  ("ACC", 95, "SUSPEND"), ("ACC", 100, "SUSPEND_IMMEDIATE")],
                                 quota.TRIGGER_SCHEMA)
    for upto, level, action in [(1, 60, "NOTIFY"), (2, 80, "NOTIFY"), (3, 95, "SUSPEND"),
                                (4, 100, "SUSPEND_IMMEDIATE")]:
        r = quota.quota_status(_usage(spark, rows[:upto]), mons, trig).first()
        assert (r.level_reached, r.action) == (level, action)
        assert r.crossed_at == rows[upto - 1][2]


def test_quota_matches_brute_force(spark):
    from decimal import Decimal as D
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    whs = ["LOAD_WH", "TRANSFORM_WH", "REPORTING_WH", "ADHOC_WH"]
    rows = [(i, rnd.choice(whs), t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 45)),
             D(rnd.randint(0, 300)) / D(100)) for i in range(400)]
    got = {(r.monitor, r.month): (r.level_reached, r.action, r.crossed_at,
                                  float(r.used_credits))
           for r in quota.quota_status(_usage(spark, rows), quota.monitors_frame(spark),
                                       quota.triggers_frame(spark)).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "wh", "ts", "c"])
    want = {}
    for mon, wh, q in quota.MONITORS:
        sub = pdf if wh is None else pdf[pdf.wh == wh]
        sub = sub.assign(month=sub.ts.dt.to_period("M")).sort_values(["ts", "id"])
        for month, g in sub.groupby("month"):
            run = g.c.cumsum()
            best = None
            for m2, lvl, act in quota.TRIGGERS:
                if m2 != mon:
                    continue
                hit = g[[float(x) >= q * lvl / 100.0 for x in run]]
                if len(hit) and (best is None or lvl > best[0]):
                    best = (lvl, act, hit.ts.iloc[0].to_pydatetime())
            key = (mon, month.to_timestamp().to_pydatetime())
            want[key] = (best or (None, None, None)) + (float(sum(g.c)),)
    assert got == want


def test_quota_with_corrections_within_a_minute(spark):
    """A level reached and undone inside one minute is still reported, with a
    whole minute's rows on one timestamp."""
    from decimal import Decimal as D
    t = dt.datetime(2024, 1, 1, 0, 5)
    rows = [(1, "LOAD_WH", t, D("9")), (2, "LOAD_WH", t, D("2")), (3, "LOAD_WH", t, D("-2")),
            (4, "LOAD_WH", t + dt.timedelta(hours=1), D("0.5"))]
    mons = spark.createDataFrame([("M", "LOAD_WH", 10.0), ("Z", None, 0.0)], quota.MONITOR_SCHEMA)
    trig = spark.createDataFrame([("M", 75, "NOTIFY"), ("M", 100, "SUSPEND"), ("Z", 100, "SUSPEND")],
                                 quota.TRIGGER_SCHEMA)
    got = {r.monitor: r for r in quota.quota_status(_usage(spark, rows), mons, trig).collect()}
    assert (got["M"].level_reached, got["M"].action, got["M"].crossed_at) == (100, "SUSPEND", t)
    assert got["Z"].pct_used is None and got["Z"].crossed_at == t


def test_quota_random_corrections_match_brute_force(spark):
    from decimal import Decimal as D
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 3, 1)
    rows = [(i * 40_000, "LOAD_WH", t0 + dt.timedelta(seconds=rnd.choice([0, 0, 1, 59, 61, 3600]) + 7200 * (i % 5)),
             D(rnd.randint(-300, 320)) / D(100)) for i in range(300)]
    mons = spark.createDataFrame([("M", None, 5.0)], quota.MONITOR_SCHEMA)
    trig = spark.createDataFrame([("M", p, f"A{p}") for p in (10, 60, 120, 250)], quota.TRIGGER_SCHEMA)
    r = quota.quota_status(_usage(spark, rows), mons, trig).first()
    run, best = D(0), None
    first = {}
    for _, _, ts, c in sorted(rows, key=lambda x: (x[2], x[0])):
        run += c
        for p in (10, 60, 120, 250):
            if float(run) >= 5.0 * p / 100 and p not in first:
                first[p] = ts
    best = max(first)
    assert (r.level_reached, r.action, r.crossed_at) == (best, f"A{best}", first[best])


def test_quota_plan_is_lazy_and_doubles_totals_only(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    usage = _usage(spark, [])
    df = quota.quota_status(usage, quota.monitors_frame(spark), quota.triggers_frame(spark))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert df.count() == 0
