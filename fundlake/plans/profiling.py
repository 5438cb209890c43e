"""Data-profiling looks at the landed extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def name_variants(applications: DataFrame, pattern: str) -> DataFrame:
    """Distinct spellings of institution names matching ``pattern``
    (case-insensitive LIKE)."""
    return (applications.where(F.col("institution_name").ilike(pattern))
            .select("institution_name").distinct())


def sample(df: DataFrame, col: str, n: int) -> DataFrame:
    """A peek at ``n`` values (any rows; no order promised)."""
    return df.select(col).limit(n)


def null_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_if(F.col(col).isNull()).alias("null_count"))
