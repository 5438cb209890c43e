"""Column-level functions (pure expressions, evaluated inside codegen)."""

from fundlake.functions.dates import (
    ANY_DATE_FORMATS, date_text, fiscal_year_end, fiscal_year_label,
    fiscal_year_of, fiscal_year_start, parse_any_date,
)
from fundlake.functions.numbers import money_to_number, ratio, try_number
from fundlake.functions.text import (
    initcap_words, normalise_prefix, null_if_tokens, preview,
)

__all__ = [
    "ANY_DATE_FORMATS", "date_text", "fiscal_year_end", "fiscal_year_label",
    "fiscal_year_of", "fiscal_year_start", "parse_any_date",
    "money_to_number", "ratio", "try_number",
    "initcap_words", "normalise_prefix", "null_if_tokens", "preview",
]
