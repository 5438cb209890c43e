"""Property tests against plain-Python brute force."""

import random
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from fundlake.functions import money_to_number, try_number
from fundlake.operators.dedupe import dedupe_first

amounts = st.decimals(min_value=-10**12, max_value=10**12, places=2, allow_nan=False)


@settings(max_examples=5, deadline=None)
@given(st.lists(amounts, min_size=1, max_size=50))
def test_number_and_money_text(spark, values):
    rows = [(str(v), "${:,.2f}".format(v) if v >= 0 else None) for v in values]
    df = spark.createDataFrame(rows, "plain string, money string")
    got = df.select(try_number("plain").alias("a"), money_to_number("money").alias("b"),
                    try_number("money").alias("c")).collect()
    for v, r in zip(values, got):
        want = v.quantize(Decimal(1), rounding=ROUND_HALF_UP)
        assert r.a == want
        assert r.b == (want if v >= 0 else None)
        assert r.c is None            # money text is not a plain number


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=0, max_value=10**6))
def test_dedupe_matches_sort_and_first(spark, seed):
    rnd = random.Random(seed)
    keys = [None, "A", "B", "C"]
    texts = [None, "2023-01-05", "Jan 05 2023", "05/01/2023", "01/05/2023", "soon"]
    rows = [(rnd.choice(keys), rnd.choice(texts), f"v{rnd.randint(0, 9)}") for _ in range(60)]
    df = spark.createDataFrame(rows, "id string, d string, v string").repartition(3)
    got = {r.id: (r.d, r.v) for r in dedupe_first(df, "id", ["d"]).collect()}

    def sort_key(row):   # text order, NULLs last, then the tie-break column
        return (row[1] is None, row[1] or "", row[2] is None, row[2] or "")

    want = {}
    for row in sorted(rows, key=sort_key):
        want.setdefault(row[0], (row[1], row[2]))
    assert got == want
