"""Dashboard aggregates, computed where the data lives.

Instead of copying whole views to the client, the year filter, the
headline KPIs and the top-15 tables are added to the Spark plan; only the
final handful of rows is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators.keys import surrogate_key
from fundlake.operators.topk import top_k

REVIEW_PREFIX = "Review"
TOP_N = 15


def fiscal_years(equity: DataFrame) -> DataFrame:
    """The year picker: sorted distinct non-NULL years of the equity view."""
    return (equity.select("fiscal_year").where(F.col("fiscal_year").isNotNull())
            .distinct().orderBy("fiscal_year"))


def _pick(df: DataFrame, years) -> DataFrame:
    return df if years is None else df.where(F.col("fiscal_year").isin(list(years)))


def headline(spark: SparkSession, equity: DataFrame, lag: DataFrame, programs: DataFrame,
             years=None) -> DataFrame:
    """One row: institutions funded, mean of the per-group average days to
    pay (rounded half-even like the display; NULL when no row is
    selected) and programs flagged for review.  Each figure is a global
    aggregate evaluated as a scalar subquery."""
    eq, lg = _pick(equity, years), _pick(lag, years)
    funded = eq.agg(F.count_distinct("institution_name")).scalar()
    avg_days = lg.agg(F.bround(F.avg("avg_days_to_pay"), 0)).scalar()
    review = programs.agg(F.count_if(F.startswith(F.col("flag"), F.lit(REVIEW_PREFIX)))).scalar()
    return spark.range(1).select(funded.cast("bigint").alias("institutions_funded"),
                                 avg_days.cast("double").alias("avg_days_to_pay"),
                                 review.cast("bigint").alias("programs_to_review"))


def year_rollup(equity: DataFrame, lag: DataFrame, path: str) -> DataFrame:
    """A row set per fiscal year from which the headline of any picked years
    follows: the funded institutions as bitmaps over dense name keys (a row per
    year and 32,768 names), the sum and number of the groups' average days.

    Written at ``path``.  Bitmaps of several years merge by OR, so distinct
    counts stay exact; sums are decimals of the one place that averages have.
    """
    spark = equity.sparkSession
    pairs = equity.where(F.col("institution_name").isNotNull()).select("fiscal_year", "institution_name").distinct()
    pairs.write.parquet(f"{path}/pairs")
    pairs = spark.read.schema(pairs.schema).parquet(f"{path}/pairs")
    names = surrogate_key(pairs.select("institution_name").distinct(), "institution_name", "_key",
                          ranged_partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = (pairs.join(names, "institution_name")
            .groupBy("fiscal_year", F.bitmap_bucket_number("_key").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("bits")))
    days = lag.groupBy("fiscal_year").agg(F.sum(F.col("avg_days_to_pay").cast("decimal(18,1)")).alias("days"),
                                          F.count("avg_days_to_pay").alias("n_groups"))
    out = bits.unionByName(days, allowMissingColumns=True)
    out.write.parquet(f"{path}/years")
    return spark.read.schema(out.schema).parquet(f"{path}/years")


def headline_of_years(spark: SparkSession, rollup: DataFrame, programs: DataFrame, years=None) -> DataFrame:
    """``headline`` for picked years (None: all) from ``year_rollup`` alone."""
    y = _pick(rollup, years)
    merged = y.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    funded = merged.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    avg_days = y.agg(F.bround(F.try_divide(F.sum("days").cast("double"), F.sum("n_groups")), 0)).scalar()
    review = programs.agg(F.count_if(F.startswith(F.col("flag"), F.lit(REVIEW_PREFIX)))).scalar()
    return spark.range(1).select(funded.cast("bigint").alias("institutions_funded"),
                                 avg_days.cast("double").alias("avg_days_to_pay"),
                                 review.cast("bigint").alias("programs_to_review"))


def top_equity(equity: DataFrame, years=None, n: int = TOP_N) -> DataFrame:
    return top_k(_pick(equity, years), "funding_per_student", n, descending=True,
                 nulls_last=True, tie_break=("institution_name", "fiscal_year"))


def top_lag(lag: DataFrame, years=None, n: int = TOP_N) -> DataFrame:
    return top_k(_pick(lag, years), "avg_days_to_pay", n, descending=True,
                 nulls_last=True, tie_break=("institution_name", "fiscal_year"))


def program_table(programs: DataFrame) -> DataFrame:
    return programs.select("program_name", "earliest_students", "latest_students",
                           "enrollment_change", "approved_funding", "flag")
