"""Tolerant numeric conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# NUMBER with default precision/scale: 38 digits, no fraction (fractions
# round half away from zero).
DEFAULT_PRECISION = 38


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def try_number(col, scale: int = 0, precision: int = DEFAULT_PRECISION) -> Column:
    """Text to decimal, NULL on anything unparsable ('$1,250', 'abc', '')."""
    return _c(col).try_cast(f"decimal({precision},{scale})")


def money_to_number(col, scale: int = 0, strip: str = "$,") -> Column:
    """Money text such as "$1,250,000" to a number: drop the currency sign
    and thousands separators, then convert tolerantly."""
    return try_number(F.translate(_c(col), strip, ""), scale=scale)


def ratio(num, den, digits: int = 0) -> Column:
    """round(num / den, digits) with a zero denominator giving NULL."""
    return F.round(_c(num) / F.nullif(_c(den), F.lit(0)), digits)
