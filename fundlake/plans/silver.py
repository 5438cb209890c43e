"""RAW -> SILVER: cleanse and conform the five extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions import (
    initcap_words, money_to_number, normalise_prefix, parse_any_date, try_number,
)
from fundlake.operators.counts import count_report
from fundlake.operators.dedupe import dedupe_first
from fundlake.operators.lookup import conform, flag_orphans

# Enrolment ids in the short spelling are rewritten to the
# master spelling.
SHORT_ID_PREFIX, MASTER_ID_PREFIX = "I-", "INST-"


def silver_institutions(raw: DataFrame) -> DataFrame:
    """The conformed master: typed (text) and trimmed."""
    return raw.select(*[F.trim(F.col(c)).alias(c) for c in (
        "institution_id", "institution_name", "institution_type", "region", "size_category")])


def deduped_applications(raw: DataFrame) -> DataFrame:
    """First row per application id, ordered by the raw submission text
    (as landed: text order, not date order), NULLs last."""
    return dedupe_first(raw, "application_id", ["submission_date"])


def silver_applications(raw: DataFrame, institutions: DataFrame,
                        master_rows: int | None = None) -> DataFrame:
    d = deduped_applications(raw)
    d = conform(d, institutions, "institution_id", {"institution_name": "institution_name"},
                master_rows=master_rows)
    return d.select(
        "application_id", "institution_id", "institution_name", "program_code",
        "program_name", "funding_type_code", "fiscal_year",
        try_number("amount_requested").alias("amount_requested"),
        parse_any_date("submission_date").alias("submission_date"),
        initcap_words("status").alias("status"),
    )


def silver_enrollments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "enrollment_id",
        normalise_prefix("institution_id", SHORT_ID_PREFIX, MASTER_ID_PREFIX).alias(
            "institution_id"),
        "program_code", "fiscal_year",
        try_number("headcount").alias("headcount"),
        F.col("headcount").isNull().alias("headcount_missing_flag"),
    )


def silver_funding_decisions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "decision_id", "application_id", "institution_id", "funding_type_code", "fiscal_year",
        money_to_number("approved_amount").alias("approved_amount"),
        parse_any_date("decision_date").alias("decision_date"),
        initcap_words("decision").alias("decision"),
    )


def silver_disbursements(raw: DataFrame, applications: DataFrame) -> DataFrame:
    typed = raw.select(
        "disbursement_id", "application_id", "institution_id", "fiscal_year",
        try_number("disbursed_amount").alias("disbursed_amount"),
        parse_any_date("disbursement_date").alias("disbursement_date"),
    )
    # SILVER applications is unique by construction (dedupe_first on the key).
    return flag_orphans(typed, applications, "application_id", "orphan_flag", parent_unique=True)


def build_silver(raw: dict, master_rows: int | None = None) -> dict:
    inst = silver_institutions(raw["institutions"])
    apps = silver_applications(raw["applications"], inst, master_rows)
    return {
        "institutions": inst,
        "applications": apps,
        "enrollments": silver_enrollments(raw["enrollments"]),
        "funding_decisions": silver_funding_decisions(raw["funding_decisions"]),
        "disbursements": silver_disbursements(raw["disbursements"], apps),
    }


# Data-quality metric labels.
DQ_KEPT = "applications: rows kept after dedupe"
DQ_RAW = "applications: raw rows (incl. dupes)"
DQ_MISSING = "enrollments: rows missing headcount"
DQ_NORMALISED = "enrollments: institution ids normalised"
DQ_ORPHANS = "disbursements: orphan rows flagged"


def quality_report(raw: dict, silver: dict) -> DataFrame:
    """Five data-quality metrics (values as text), in report order.  The
    two enrolment metrics share one scan of the landed extract."""
    enr = raw["enrollments"]
    return count_report([
        (silver["applications"], {DQ_KEPT: None}),
        (raw["applications"], {DQ_RAW: None}),
        (enr, {DQ_MISSING: F.col("headcount").isNull(),
               DQ_NORMALISED: F.col("institution_id").like(SHORT_ID_PREFIX + "%")}),
        (silver["disbursements"], {DQ_ORPHANS: F.col("orphan_flag")}),
    ])
