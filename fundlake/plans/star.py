"""SILVER -> STAR: dimensions with surrogate keys, and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions.dates import fiscal_year_end, fiscal_year_label, fiscal_year_start
from fundlake.operators.keys import surrogate_key
from fundlake.operators.lookup import BROADCAST_MAX_ROWS, lookup_keys
from fundlake.sources.landing import count_rows_by_table

# The funding-type reference dimension.
FUNDING_TYPES = (
    (1, "FT-OPS", "Operating Grant", "Base Funding"),
    (2, "FT-CAP", "Capital Grant", "Infrastructure"),
    (3, "FT-RES", "Research Grant", "Targeted"),
    (4, "FT-ACC", "Access & Equity Grant", "Targeted"),
    (5, "FT-INN", "Innovation Grant", "Targeted"),
)
FUNDING_TYPE_SCHEMA = ("funding_type_key bigint, funding_type_code string, "
                       "funding_type_name string, funding_stream string")

def _slices(df: DataFrame, max_rows: int | None) -> int | None:
    """How a dimension is numbered: in one window when its rows are known to
    be few, in range slices when nothing bounds them."""
    if max_rows is not None and max_rows <= BROADCAST_MAX_ROWS:
        return None
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dim_institution(institutions: DataFrame, max_rows: int | None = None) -> DataFrame:
    return surrogate_key(institutions, "institution_id", "institution_key", _slices(institutions, max_rows))


def dim_program(applications: DataFrame, max_rows: int | None = None) -> DataFrame:
    progs = (applications.where(F.col("program_code").isNotNull())
             .groupBy("program_code").agg(F.max("program_name").alias("program_name")))
    return surrogate_key(progs, "program_code", "program_key", _slices(progs, max_rows))


def dim_funding_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FUNDING_TYPES), FUNDING_TYPE_SCHEMA)


def dim_date(applications: DataFrame, max_rows: int | None = None) -> DataFrame:
    years = (applications.where(F.col("fiscal_year").isNotNull())
             .select(F.col("fiscal_year")).distinct())
    keyed = surrogate_key(years, "fiscal_year", "date_key", _slices(years, max_rows))
    fy = F.col("fiscal_year")
    return keyed.select("date_key", "fiscal_year",
                        fiscal_year_label(fy).alias("fiscal_year_label"),
                        fiscal_year_start(fy).alias("fiscal_year_start"),
                        fiscal_year_end(fy).alias("fiscal_year_end"))


def fact_applications(apps: DataFrame, dims: dict, bounds: dict) -> DataFrame:
    f = lookup_keys(apps, [
        (dims["dim_institution"], "institution_id", "institution_id", "institution_key",
         bounds.get("dim_institution")),
        (dims["dim_program"], "program_code", "program_code", "program_key",
         bounds.get("dim_program")),
        (dims["dim_date"], "fiscal_year", "fiscal_year", "date_key", bounds.get("dim_date")),
        (dims["dim_funding_type"], "funding_type_code", "funding_type_code",
         "funding_type_key", len(FUNDING_TYPES)),
    ])
    return f.select("application_id", "institution_key", "program_key", "date_key",
                    "funding_type_key", "amount_requested", "status", "submission_date")


def fact_disbursements(disb: DataFrame, dims: dict, bounds: dict) -> DataFrame:
    f = lookup_keys(disb, [
        (dims["dim_institution"], "institution_id", "institution_id", "institution_key",
         bounds.get("dim_institution")),
        (dims["dim_date"], "fiscal_year", "fiscal_year", "date_key", bounds.get("dim_date")),
    ])
    return f.select("disbursement_id", "application_id", "institution_key", "date_key",
                    "disbursed_amount", "disbursement_date", "orphan_flag")


def fact_enrollments(enr: DataFrame, dims: dict, bounds: dict) -> DataFrame:
    f = lookup_keys(enr, [
        (dims["dim_institution"], "institution_id", "institution_id", "institution_key",
         bounds.get("dim_institution")),
        (dims["dim_program"], "program_code", "program_code", "program_key",
         bounds.get("dim_program")),
        (dims["dim_date"], "fiscal_year", "fiscal_year", "date_key", bounds.get("dim_date")),
    ])
    return f.select("enrollment_id", "institution_key", "program_key", "date_key",
                    "headcount", "headcount_missing_flag")


def build_star(spark: SparkSession, silver: dict, bounds: dict | None = None) -> dict:
    """All dimensions and facts (lazy).

    ``bounds``: proven row bounds for the data-derived dimensions
    (``dim_institution``, ``dim_program``); a bounded dimension is
    broadcast into the fact lookups, an unbounded one is left to the
    planner/AQE and numbered in range slices.
    """
    bounds = bounds or {}
    dims = {
        "dim_institution": dim_institution(silver["institutions"], bounds.get("dim_institution")),
        "dim_program": dim_program(silver["applications"], bounds.get("dim_program")),
        "dim_funding_type": dim_funding_type(spark),
        "dim_date": dim_date(silver["applications"], bounds.get("dim_date")),
    }
    star = dict(dims)
    star["fact_applications"] = fact_applications(silver["applications"], dims, bounds)
    star["fact_disbursements"] = fact_disbursements(silver["disbursements"], dims, bounds)
    star["fact_enrollments"] = fact_enrollments(silver["enrollments"], dims, bounds)
    return star


def star_counts(star: dict) -> DataFrame:
    """Sanity counts: a fact must keep every silver row (no fan-out)."""
    return count_rows_by_table({k: star[k] for k in (
        "dim_institution", "fact_applications", "fact_disbursements", "fact_enrollments")},
        label="t", value="n")
