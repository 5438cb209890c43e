"""Scalar column functions, including every planted case of the fixture
catalogue that a single expression decides."""

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundlake.functions import (
    date_text, fiscal_year_end, fiscal_year_label, fiscal_year_of, fiscal_year_start,
    initcap_words, money_to_number, normalise_prefix, null_if_tokens, parse_any_date,
    preview, ratio, try_number,
)


def col1(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_any_date_cases(spark):
    got = col1(spark, ["2023-01-15", "Jan 15 2023", "15/01/2023", "01/15/2023", "03/04/2023",
                       "31/02/2023", "soon", None, "jan 15 2023"], parse_any_date)
    d = dt.date
    assert got == [d(2023, 1, 15), d(2023, 1, 15), d(2023, 1, 15), d(2023, 1, 15),
                   d(2023, 4, 3), None, None, None, d(2023, 1, 15)]


def test_try_number_and_money(spark):
    got = col1(spark, ["123.5", "-123.5", "$1,250", "", "abc", "42", None], try_number)
    assert got == [Decimal(124), Decimal(-124), None, None, None, Decimal(42), None]
    got = col1(spark, ["$1,250,000", "1250", "pending", None], money_to_number)
    assert got == [Decimal(1250000), Decimal(1250), None, None]


def test_initcap(spark):
    got = col1(spark, ["APPROVED", "approved", "under review", "under-review", None],
               initcap_words)
    assert got == ["Approved", "Approved", "Under Review", "Under-review", None]
    got = col1(spark, ["under-review", "o'neil x"], lambda c: initcap_words(c, " -"))
    assert got == ["Under-Review", "O'neil X"]


def test_normalise_prefix_and_tokens(spark):
    got = col1(spark, ["I-002", "INST-002", "X-1", None],
               lambda c: normalise_prefix(c, "I-", "INST-"))
    assert got == ["INST-002", "INST-002", "X-1", None]
    got = col1(spark, ["", "NULL", "null", "Null", "x", None], null_if_tokens)
    assert got == [None, None, None, "Null", "x", None]


def test_fiscal_calendar(spark):
    got = col1(spark, [dt.date(2023, 3, 31), dt.date(2023, 4, 1)], fiscal_year_of, "date")
    assert got == ["2022", "2023"]
    df = spark.createDataFrame([("2023",)], "fy string")
    r = df.select(fiscal_year_label("fy"), fiscal_year_start("fy"), fiscal_year_end("fy")).first()
    assert tuple(r) == ("FY2023", dt.date(2023, 4, 1), dt.date(2024, 3, 31))


def test_ratio_and_preview(spark):
    df = spark.createDataFrame([(10.0, 4.0), (5.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(ratio("a", "b", 0)).collect()] == [3.0, None, None]
    assert col1(spark, ["x" * 80], lambda c: preview(c, 60)) == ["x" * 60]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)),
                min_size=1, max_size=40))
def test_date_text_roundtrip(spark, dates):
    """Every layout parses back; MM/DD text with a day <= 12 reads day-first."""
    rows = [(d, i % 4) for i, d in enumerate(dates)]
    df = spark.createDataFrame(rows, "d date, k int")
    out = df.select("d", "k", parse_any_date(date_text("d", "k")).alias("p")).collect()
    for d, k, p in out:
        if k == 3 and d.day <= 12 and d.day != d.month:
            assert p == dt.date(d.year, d.day, d.month)
        else:
            assert p == d


def test_odd_fiscal_year_fails_loudly(spark):
    import pytest as _pytest
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        _pytest.skip("strict casts only raise under ANSI mode")
    df = spark.createDataFrame([("2023-24",)], "fy string")
    with _pytest.raises(Exception, match="CAST|cast|DATETIME|date"):
        df.select(fiscal_year_start("fy")).collect()


def test_dates_cut_by_position_equal_the_parser(spark):
    from fundlake.functions import ANY_DATE_FORMATS
    from fundlake.functions.sql import register_sql_functions
    months = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
    texts = [None, "", "soon", "2023-01-15\n", "0000-01-01", "9999-12-31", "12345-01-01", "+12345-01-01", "2023-1-5",
             "2023-01-15 ", "\uff12\uff10\uff12\uff13-01-15", "Sept 15 2023", "SEP 15 2023", "ma3 15 2023", "an 12 2023",
             "\u017fep 15 2023", "Feb 30 2023", "Jan 00 2023", "02/31/2023", "13/13/2023", "00/01/2023", "01/00/2023",
             "29/02/2024", "02/29/2024", "02/29/2023", "1 /12/2023", "2023-13-01", "2023-02-29", "1995-06-17x", "a/b-c d"]
    texts += [f"{m} {d} 1996" for m in months for d in ("01", "29", "31")] + [f"{d:02}/{m:02}/2021" for d in range(34) for m in range(14)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    parser = F.coalesce(*[F.try_to_date("x", f) for f in ANY_DATE_FORMATS])
    register_sql_functions(spark)
    made = df.select("x", parser.alias("a"), parse_any_date("x").alias("b"), F.expr("parse_any_date(x)").alias("c"))
    rows = made.select("x", *[F.col(c).cast("string") for c in "abc"]).collect()   # Python has no year 0
    assert [r for r in rows if not r.a == r.b == r.c] == [] and sum(r.a is not None for r in rows) > 400
    # Texts of a layout's shape never reach the parser, whatever their month.
    for col in (parse_any_date("x"), F.expr("parse_any_date(x)")):
        plan = spark.range(1).select(F.col("id").cast("string").alias("x")).select(col)._jdf.queryExecution().optimizedPlan()
        assert plan.toString().count("RLIKE") >= len(ANY_DATE_FORMATS)
