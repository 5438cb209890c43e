import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundlake.llm import periodic
from tests.llm.helpers import SF, documents, sf

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=6, times=4):
    """All runs straight from the definition: every period, every stretch."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                out.setdefault((i, j + q), q)             # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items() if e - s >= max(least, times * q))


def planted(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


def answer(words):
    runs = brute_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


COLS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in sf(spark, "documents").collect()}
    got = periodic.op13_periodic_runs(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in COLS) == answer(planted(r.doc_id, texts[r.doc_id])), r.doc_id
    assert sum(r.n_runs > 0 for r in got) > 5


def block(docs):
    key, first = [], []
    for k, d in enumerate(docs):
        first.append(len(key))
        key += [(k, x) for x in d] + [(len(docs), k)]
    number = {x: i for i, x in enumerate(sorted(set(key)))}
    return np.array([number[x] for x in key], np.int64), first


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4), st.sampled_from([(6, 4), (2, 2), (1, 3)]))
def test_runs_of_a_block_equal_brute_force(docs, limits):
    key, first = block(docs)
    want = sorted((f + s, f + s + n, q) for f, d in zip(first, docs) for s, n, q in brute_runs(d, *limits))
    assert periodic.runs_of_block(key, *limits) == want


def test_special_strings():
    fib = [0], [1]
    for _ in range(11):
        fib = fib[1], fib[1] + fib[0]
    rnd = random.Random(3)
    for d in ([0] * 500, [0, 1] * 300, [0, 0, 1] * 100 + [0, 0], fib[1][:300], [rnd.randrange(2) for _ in range(400)],
              ([0] * 20 + [1]) * 12):
        for limits in ((6, 4), (2, 2)):
            key, _ = block([d])
            assert periodic.runs_of_block(key, *limits) == [(s, s + n, q) for s, n, q in brute_runs(d, *limits)]


def test_intervals_in_small_chunks(monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK", 3)
    d = [0, 1, 1, 0, 1, 1, 0, 1, 1, 0, 1, 1, 0] * 4
    assert periodic.runs_of_block(block([d])[0], 2, 2) == [(s, s + n, q) for s, n, q in brute_runs(d, 2, 2)]


def test_odd_rows_and_clashing_columns(spark):
    df = documents(spark).withColumns({c: F.lit(1) for c in ("runs", "best", "collapsed", "start", "period")})
    got = sorted((r.id is None, r.id or 0, r.n_words, r.collapsed, [tuple(x) for x in r.runs])
                 for r in periodic.find_runs(df).collect())
    want = []
    for r in df.select("doc_id", "text").collect():
        w = WORD.findall(r.text or "")
        runs = brute_runs(w) if len(w) < 5000 else []
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((r.doc_id is None, r.doc_id or 0, len(w), " ".join(x for k, x in enumerate(w) if k not in gone), runs))
    for g, w in zip(got, sorted(want)):
        assert g[:3] == w[:3] and (g[2] >= 5000 or g == w)
    assert periodic.find_runs(df.limit(0)).count() == 0


def test_words_split_at_the_contract_s_spaces(spark):
    text = "  a\x0bb\x0cc\x1cd\x85e f g\r\n\th \n"
    r = periodic.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.n_words == len(WORD.findall(text)) and r.collapsed == " ".join(WORD.findall(text))


def test_one_word_repeated_very_often(spark):
    df = spark.createDataFrame([(1, "x " * 200_000 + "y"), (2, "a b " * 50_000)], "doc_id long, text string")
    got = {r.id: r for r in periodic.find_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 200_000, 1)] and got[1].collapsed == "x y"
    assert [tuple(x) for x in got[2].runs] == [(0, 100_000, 2)] and got[2].collapsed == "a b"
