"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "no value" at landing.
NULL_TOKENS = ("", "NULL", "null")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_if_tokens(col, tokens=NULL_TOKENS) -> Column:
    """NULL when the (already trimmed) cell equals one of ``tokens``."""
    c = _c(col)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def initcap_words(col, delimiters: str | None = None) -> Column:
    """Capitalise the first letter of each word, lower-case the rest.

    With ``delimiters=None`` words are split on whitespace (Spark's
    ``initcap``).  Otherwise every character in ``delimiters`` also starts a
    new word, e.g. ``delimiters=" -"`` turns "under-review" into
    "Under-Review"; this stays a JVM expression (split + transform).
    """
    c = _c(col)
    if delimiters is None:
        return F.initcap(c)
    cls = "".join("\\" + ch if ch in "\\^-]" else ch for ch in delimiters)
    pieces = F.split(F.lower(c), f"(?<=[{cls}])")
    cap = F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                 F.substring(w, 2, 1 << 30)))
    return F.when(c.isNull(), None).otherwise(F.array_join(cap, ""))


def normalise_prefix(col, old: str, new: str) -> Column:
    """Rewrite an id that starts with ``old`` to start with ``new``
    (``I-002`` -> ``INST-002``); other ids pass unchanged."""
    c = _c(col)
    return F.when(c.startswith(old), F.concat(F.lit(new), F.substring(c, len(old) + 1, 1 << 30))
                  ).otherwise(c)


def preview(col, n: int = 60) -> Column:
    """The first ``n`` characters of a text (a display column)."""
    return F.left(_c(col), F.lit(n))
