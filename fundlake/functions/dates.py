"""Date parsing and fiscal-calendar expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted input layouts, tried in this order; the first
# that parses wins (so an ambiguous 03/04/2023 reads day-first).
#   YYYY-MM-DD | MON DD YYYY | DD/MM/YYYY | MM/DD/YYYY
ANY_DATE_FORMATS = ("yyyy-MM-dd", "MMM dd yyyy", "dd/MM/yyyy", "MM/dd/yyyy")

# Fiscal year starts on April 1 and ends on March 31 of the next year.
FISCAL_START_MONTH = 4


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _separators(fmt: str) -> str:
    """Literal characters every text accepted by ``fmt`` must contain."""
    return "".join(dict.fromkeys(ch for ch in fmt if not ch.isalpha() and ch != "'"))


# Layouts made of these fields, each once, have a fixed width, so their parts can
# be cut out of a text by position.
_WIDTHS = {"yyyy": 4, "MMM": 3, "MM": 2, "dd": 2}
_SHAPES = {"yyyy": "[0-9]{4}", "MMM": "(?i:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)", "MM": "[0-9]{2}", "dd": "[0-9]{2}"}
_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _fields(fmt: str) -> list[str] | None:
    """``fmt`` as fields and separators; None unless it is one year, one month
    and one day with separators that are no letters or digits."""
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]", fmt)
    names = [p for p in parts if p[0].isalpha()]
    if sorted(n[:1] for n in names) != ["M", "d", "y"] or not set(names) <= set(_WIDTHS):
        return None
    return parts if all(p in _WIDTHS or p in " -/." for p in parts) else None


def _shape_and_places(fmt: str) -> tuple[str, dict[str, int]] | None:
    """A pattern that a text of the fixed width matches, and where each field
    starts (from 1)."""
    parts = _fields(fmt)
    if parts is None:
        return None
    shape, places, at = "", {}, 1
    for p in parts:
        shape += _SHAPES.get(p, f"[{p}]")
        places[p] = at
        at += _WIDTHS.get(p, 1)
    return rf"\A{shape}\z", {p: n for p, n in places.items() if p in _WIDTHS}


def _by_position(c: Column, fmt: str) -> tuple[Column, Column] | None:
    """Whether the text has the layout's shape, and its date then (NULL when there
    is no such day): the same as a strict parse, without an exception per text
    whose month and day are out of range."""
    found = _shape_and_places(fmt)
    if found is None:
        return None
    shape, at = found
    part = {f: F.substring(c, n, _WIDTHS[f]) for f, n in at.items()}
    if "MMM" in part:
        names = F.lit(" ".join(_MONTHS).lower())
        month = F.lpad(((F.instr(names, F.lower(part["MMM"])) + 3) / 4).cast("int").cast("string"), 2, "0")
    else:
        month = part["MM"]
    known = month.between("01", "12") & part["dd"].between("01", "31")
    iso = F.concat(part["yyyy"], F.lit("-"), month, F.lit("-"), part["dd"])
    return c.rlike(shape), F.when(known, iso.try_cast("date"))


def parse_any_date(col, formats=ANY_DATE_FORMATS) -> Column:
    """First successful strict parse among ``formats``; NULL when none fits.

    ``try_to_date`` never raises under ANSI mode, so bad text ("soon",
    31/02/2023) simply falls through to NULL.  A failed parse is costly
    inside the JVM (an exception per attempt), so each attempt is guarded
    by a test that the text contains the format's literal separators - a
    necessary condition, so results are unchanged while an ISO date is
    never tried against the slash layouts and vice versa.  A text of the
    layout's exact shape (01/15/2023 is tried day-first, too) is cut by position
    instead; the parser is left with odd spellings.
    """
    c = _c(col)
    attempts = []
    for fmt in formats:
        guard = F.lit(True)
        for ch in _separators(fmt):
            guard = guard & c.contains(ch)
        quick = _by_position(c, fmt)
        parsed = F.when(guard, F.try_to_date(c, fmt))
        if quick:
            shaped, value = quick
            parsed = F.when(guard & shaped, value).when(guard, F.try_to_date(c, fmt))
        attempts.append(parsed)
    return F.coalesce(*attempts)


def parse_any_date_sql(name: str, formats=ANY_DATE_FORMATS) -> str:
    """``parse_any_date`` of the text column ``name`` as an SQL expression."""
    tries = []
    for fmt in formats:
        guard = " AND ".join(["TRUE", *(f"contains({name}, '{ch}')" for ch in _separators(fmt))])
        slow = f"WHEN {guard} THEN try_to_date({name}, '{fmt}')"
        found = _shape_and_places(fmt)
        if found:
            shape, at = found
            part = {f: f"substring({name}, {n}, {_WIDTHS[f]})" for f, n in at.items()}
            month = part.get("MM") or (f"lpad(CAST((instr('{' '.join(_MONTHS).lower()}', lower({part['MMM']})) + 3) DIV 4 AS STRING),"
                                       " 2, '0')")
            known = f"{month} BETWEEN '01' AND '12' AND {part['dd']} BETWEEN '01' AND '31'"
            iso = f"concat({part['yyyy']}, '-', {month}, '-', {part['dd']})"
            slow = (f"WHEN {guard} AND rlike({name}, r'{shape}') THEN CASE WHEN {known} THEN try_cast({iso} AS DATE) END {slow}")
        tries.append(f"CASE {slow} END")
    return "coalesce(" + ", ".join(tries) + ")"


def date_text(col, selector, formats=ANY_DATE_FORMATS) -> Column:
    """Render a date/timestamp in one of ``formats`` picked by ``selector``
    (an integer column, taken modulo the number of formats)."""
    c = _c(col)
    pick = F.pmod(_c(selector), F.lit(len(formats)))
    expr = None
    for i, fmt in enumerate(formats):
        branch = F.date_format(c, fmt)
        expr = F.when(pick == i, branch) if expr is None else expr.when(pick == i, branch)
    return expr


def fiscal_year_of(col, start_month: int = FISCAL_START_MONTH) -> Column:
    """Fiscal year (as text) a date falls in: the calendar year in which the
    fiscal year began."""
    c = _c(col)
    shift = F.when(F.month(c) < start_month, 1).otherwise(0)
    return (F.year(c) - shift).cast("string")


def fiscal_year_label(fy) -> Column:
    return F.concat(F.lit("FY"), _c(fy))


def fiscal_year_start(fy) -> Column:
    """April 1 of the fiscal year.  A strict cast: odd labels fail loudly."""
    return F.concat(_c(fy), F.lit("-04-01")).cast("date")


def fiscal_year_end(fy) -> Column:
    """March 31 of the following calendar year (strict casts)."""
    nxt = (_c(fy).cast("int") + 1).cast("string")
    return F.concat(nxt, F.lit("-03-31")).cast("date")
