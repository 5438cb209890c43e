"""The driver's TPC-H-like tables, re-read as the funding domain.

The domain extracts (institutions, applications, enrollments, funding
decisions, disbursements, usage logs) are derived row-by-row from the
driver's tables, with the defects the cleansing layer exists for planted
deterministically: mixed date layouts, money text, id spellings, null
tokens, duplicate submissions, orphan payments.  Each extract is a
projection of one base table (plus the fixed-size ``nation``/``region``
tables), so its size and cost grow with the input and no extra shuffle is
introduced except applications' customer lookup.

    institutions       <- nation x region            (one per nation)
    applications       <- orders x customer x nation (one per order, some twice)
    enrollments        <- lineitem                   (one per line)
    funding_decisions  <- orders                     (one per order)
    disbursements      <- lineitem                   (one per line)
    metering / queries <- events                     (one per event)
    storage metrics    <- part                       (one per part)

All landed columns are text, exactly like a CSV landing.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.dates import date_text, fiscal_year_of
from fundlake.sources.landing import null_tokens, spread

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

# Fixed values used by the mapping.
FUNDING_TYPE_BY_PRIORITY = {"1": "FT-OPS", "2": "FT-CAP", "3": "FT-RES",
                            "4": "FT-ACC", "5": "FT-INN"}
PROGRAM_CODES = ("PRG-AUTO", "PRG-BUIL", "PRG-FURN", "PRG-HOUS", "PRG-MACH")
N_INSTITUTIONS = 25
# Proven row bounds: the master has 25 rows, programs are the segments above, and
# a fiscal year is the four-digit year of a date.
DIM_BOUNDS = {"dim_institution": N_INSTITUTIONS, "dim_program": len(PROGRAM_CODES), "dim_date": 10_000}
UNKNOWN_INSTITUTION_OFFSET = 900
WAREHOUSE_BY_EVENT = {"signup": "LOAD_WH", "purchase": "TRANSFORM_WH",
                      "view": "REPORTING_WH", "click": "REPORTING_WH"}
OTHER_WAREHOUSE = "ADHOC_WH"
ROLE_BY_USER_MOD4 = ("ANALYST", "ENGINEER", "AUDITOR", "INSTITUTION_USER")


# Inputs whose rows feed heavy per-row work (string building, date
# formatting, joins).  The event log feeds a pushed-down filter and a
# partial aggregate, where an extra shuffle would cost more than it saves; the
# customers are the build side of a join, which deals them out itself.
_SPREAD = ("orders", "lineitem", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if name in _SPREAD else df


def _inst_id(num: Column, prefix: str = "INST-") -> Column:
    return F.concat(F.lit(prefix), F.lpad(num.cast("string"), 3, "0"))


def _money(x: Column) -> Column:
    return x.cast("decimal(18,2)").cast("string")


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default)


def raw_institutions(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    # nation/region have a fixed size (25/5 rows): a broadcast is bounded.
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(
                _inst_id(key).alias("institution_id"),
                F.when(key % 2 == 0, F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")))
                 .otherwise(F.col("n_name")).alias("institution_name"),
                F.element_at(F.array(F.lit("University"), F.lit("College"),
                                     F.lit("Polytechnic")), (key % 3 + 1).cast("int"))
                 .alias("institution_type"),
                F.col("r_name").alias("region"),
                F.element_at(F.array(F.lit("Large"), F.lit("Medium"), F.lit("Small")),
                             (F.col("n_regionkey") % 3 + 1).cast("int")).alias("size_category"),
            ))


def raw_applications(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (o.join(c, o.o_custkey == c.c_custkey)
            .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")))
    # Every 7th order was submitted twice (copy = 1) with other text.
    base = base.withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.when(F.col("o_orderkey") % 7 == 0, 1)
                                     .otherwise(0))))
    k = F.col("o_orderkey") + F.col("copy")
    seg = F.col("c_mktsegment")
    status = (F.when(F.col("copy") == 1, F.lit("Pending"))
              .when(F.col("o_orderstatus") == "F",
                    F.element_at(F.array(F.lit("APPROVED"), F.lit("approved"),
                                         F.lit("Approved")), (k % 3 + 1).cast("int")))
              .when(F.col("o_orderstatus") == "O", F.lit("pending"))
              .otherwise(F.lit("under review")))
    return base.select(
        F.concat(F.lit("APP-"), F.col("o_orderkey").cast("string")).alias("application_id"),
        F.when(F.col("o_custkey") % 101 == 100,
               _inst_id(F.col("c_nationkey") + UNKNOWN_INSTITUTION_OFFSET))
         .otherwise(_inst_id(F.col("c_nationkey"))).alias("institution_id"),
        F.when(k % 3 == 0, F.col("n_name"))
         .when(k % 3 == 1, F.lower(F.col("n_name")))
         .otherwise(F.concat(F.col("n_name"), F.lit(" Institute"))).alias("institution_name"),
        F.concat(F.lit("PRG-"), F.substring(seg, 1, 4)).alias("program_code"),
        F.when(F.col("copy") == 1, seg)
         .otherwise(F.concat(F.substring(seg, 1, 1), F.lower(F.substring(seg, 2, 100))))
         .alias("program_name"),
        _case(F.substring("o_orderpriority", 1, 1), FUNDING_TYPE_BY_PRIORITY)
         .alias("funding_type_code"),
        fiscal_year_of("o_orderdate").alias("fiscal_year"),
        F.when(k % 13 == 0, F.concat(F.lit("$"), _money(F.col("o_totalprice"))))
         .otherwise(_money(F.col("o_totalprice"))).alias("amount_requested"),
        F.when(k % 97 == 5, F.lit("soon"))
         .otherwise(date_text("o_orderdate", k)).alias("submission_date"),
        status.alias("status"),
    )


def _line_key(lineitem: DataFrame) -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def _site(suppkey: Column) -> Column:
    return suppkey % N_INSTITUTIONS


def raw_enrollments(spark, sf_dir, keep_line_key: bool = False) -> DataFrame:
    """One enrollment record per line; headcount text carries null tokens
    ('' / NULL / null, landed as NULL) and the odd unparsable value."""
    li = table(spark, sf_dir, "lineitem")
    k = _line_key(li)
    site = _site(F.col("l_suppkey"))
    token = F.element_at(F.array(F.lit(""), F.lit("NULL"), F.lit("null")),
                         (k % 3 + 1).cast("int"))
    extra = [k.alias("_k")] if keep_line_key else []
    return li.select(*extra,
        F.concat(F.lit("ENR-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("enrollment_id"),
        F.when(k % 2 == 0, _inst_id(site, "I-")).otherwise(_inst_id(site)).alias("institution_id"),
        F.element_at(F.array(*[F.lit(p) for p in PROGRAM_CODES]),
                     (F.col("l_partkey") % 5 + 1).cast("int")).alias("program_code"),
        fiscal_year_of("l_shipdate").alias("fiscal_year"),
        F.when(k % 7 == 0, token)
         .when(k % 29 == 0, F.lit("n/a"))
         .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("headcount"),
    )


def raw_funding_decisions(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    money = F.col("o_totalprice").cast("decimal(18,2)")
    return o.select(
        F.concat(F.lit("DEC-"), k.cast("string")).alias("decision_id"),
        F.concat(F.lit("APP-"), k.cast("string")).alias("application_id"),
        _inst_id(F.col("o_custkey") % N_INSTITUTIONS).alias("institution_id"),
        _case(F.substring("o_orderpriority", 1, 1), FUNDING_TYPE_BY_PRIORITY)
         .alias("funding_type_code"),
        fiscal_year_of("o_orderdate").alias("fiscal_year"),
        F.when(k % 5 == 0, F.lit("pending review"))
         .when(k % 2 == 0, F.concat(F.lit("$"), F.format_number(money, 2)))
         .otherwise(money.cast("string")).alias("approved_amount"),
        date_text(F.date_add(F.col("o_orderdate").cast("date"), 30), k + 1).alias("decision_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("approved"))
         .when(F.col("o_orderstatus") == "O", F.lit("DEFERRED"))
         .otherwise(F.lit("declined")).alias("decision"),
    )


def raw_disbursements(spark, sf_dir) -> DataFrame:
    """One payment per line; some reference an unknown application
    (orphans) or none at all."""
    li = table(spark, sf_dir, "lineitem")
    k = _line_key(li)
    return li.select(
        F.concat(F.lit("DSB-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("disbursement_id"),
        F.when(k % 17 == 0, F.concat(F.lit("APP-X"), F.col("l_orderkey").cast("string")))
         .when(k % 31 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("APP-"), F.col("l_orderkey").cast("string")))
         .alias("application_id"),
        _inst_id(_site(F.col("l_suppkey"))).alias("institution_id"),
        fiscal_year_of("l_shipdate").alias("fiscal_year"),
        _money(F.col("l_extendedprice")).alias("disbursed_amount"),
        date_text("l_shipdate", k + 1).alias("disbursement_date"),
    )


def landed(df: DataFrame) -> DataFrame:
    """What the CSV landing would hold: trimmed text, null tokens as NULL."""
    trimmed = df.select(*[F.trim(F.col(c)).alias(c) for c in df.columns])
    return null_tokens(trimmed)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five landed RAW extracts (lazy)."""
    return {
        "institutions": landed(raw_institutions(spark, sf_dir)),
        "applications": landed(raw_applications(spark, sf_dir)),
        "enrollments": landed(raw_enrollments(spark, sf_dir)),
        "funding_decisions": landed(raw_funding_decisions(spark, sf_dir)),
        "disbursements": landed(raw_disbursements(spark, sf_dir)),
    }


# --------------------------------------------------------------------------
# usage logs
# --------------------------------------------------------------------------

def _warehouse(event_type: Column) -> Column:
    return _case(event_type, WAREHOUSE_BY_EVENT, OTHER_WAREHOUSE)


def metering_history(spark, sf_dir) -> DataFrame:
    """warehouse_name, start_time, credits_used (exact decimal credits)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("meter_id"),
        _warehouse(F.col("event_type")).alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        (F.col("value").cast("decimal(12,2)") * F.lit(0.0001).cast("decimal(4,4)"))
        .cast("decimal(18,6)").alias("credits_used"),
    )


def query_history(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("query_id"),
        F.concat(F.lit("select "), F.col("props"), F.lit(" from star.fact_"),
                 F.col("event_type"), F.lit("s")).alias("query_text"),
        F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("user_name"),
        F.element_at(F.array(*[F.lit(r) for r in ROLE_BY_USER_MOD4]),
                     (F.col("user_id") % 4 + 1).cast("int")).alias("role_name"),
        _warehouse(F.col("event_type")).alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        F.round(F.col("value") * 1000).cast("bigint").alias("total_elapsed_time"),
        F.when(F.col("event_type") == "error", F.lit("FAILED"))
         .otherwise(F.lit("SUCCESS")).alias("execution_status"),
    )


def storage_metrics(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_brand").alias("table_schema"),
                    (F.col("p_size").cast("bigint") * 262144).alias("active_bytes"))


def clock(spark, sf_dir) -> Column:
    """'now' for the usage reports: the newest logged event, as a scalar
    subquery (a one-row global aggregate; nothing reaches the driver)."""
    return table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
