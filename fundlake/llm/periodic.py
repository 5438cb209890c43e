"""Periodic runs of words, found on an enhanced suffix array.

A run is a longest stretch of words in which every word equals the one
``period`` words before it.  Its last square (two copies of one period) can't be
rotated to the right, and such a "branching" square shows in the suffix array:
for the LCP interval of depth d that holds suffix i, the square i, i + d is
branching if ISA[i + d] lies in the interval, but in another child.  For every
interval the suffixes of all children but the largest are tested, forwards
(ISA[i + d]) and backwards (ISA[i - d]), so every word is tested at most once
for each halving: O(n log n).  Branching squares are then rotated to the left
as far as words agree, which gives the run; squares of a multiple of a found
period with the same end belong to that run and are not rotated again.  No tree
is built: intervals are found from the LCP array by doubling range minima.

Documents are independent.  A task lays the words of many documents end to end
in a block of bounded size; the word numbers of each document differ from those
of any other and each ends with a number of its own, so no repeat crosses
documents.  Nothing is shuffled.

Defined cases: a null text has no words, like an empty or blank one; it has no
runs and an empty collapsed text.  Very long texts are blocks of their own, with
memory in proportion to their words.  Repeated rows, null ids and ties give each
row its own result; an empty table gives an empty one.  Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import SPACE_CLASS, batch_rows, let, slices, table, written

MIN_LENGTH = 6
MIN_EXPONENT = 4
BLOCK_BYTES = 1_500_000      # text of one block; a longer document is a block of its own
CHUNK = 1 << 20              # suffixes tested at once

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def suffix_order(key: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 1, 2, 4, ... numbers) by prefix doubling.

    The last number must be unique.  A rank is the place of its group's first
    suffix; only groups of two or more are sorted again.  The last ranks are the
    inverse suffix array.
    """
    n = len(key)
    sa = np.argsort(key, kind="stable").astype(np.int32)
    found = key[sa]
    first = np.r_[True, found[1:] != found[:-1]]
    head = np.flatnonzero(first).astype(np.int32)
    size = np.diff(np.r_[head, n])
    rank = np.empty(n, np.int32)
    rank[sa] = np.repeat(head, size)
    levels, step = [rank], 1
    tied = np.flatnonzero(np.repeat(size > 1, size)).astype(np.int32)
    while len(tied):
        sub = sa[tied]
        pair = rank[sub].astype(np.int64) * n + rank[sub + step]
        order = np.argsort(pair, kind="stable")
        pair, sub = pair[order], sub[order]
        sa[tied] = sub
        first = np.r_[True, pair[1:] != pair[:-1]]
        size = np.diff(np.r_[np.flatnonzero(first), len(tied)])
        rank = rank.copy()
        rank[sub] = np.repeat(tied[first], size)
        levels.append(rank)
        tied = tied[np.repeat(size > 1, size)]
        step *= 2
    return sa, levels


def neighbour_lcp(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[r]: numbers that suffixes r - 1 and r of the array share; lcp[0] = 0."""
    lcp = np.zeros(len(sa), np.int32)
    at = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    a, b = sa[at - 1].copy(), sa[at].copy()
    for k in reversed(range(len(levels) - 1)):
        same = levels[k][a] == levels[k][b]
        a[same] += 1 << k
        b[same] += 1 << k
    lcp[at] = a - sa[at - 1]
    return lcp


def intervals(lcp: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(r, first, last) of each r with lcp[r] > 0: the LCP interval of depth
    lcp[r] around r.  ``largest``: no interval has more suffixes."""
    n = len(lcp)
    at = np.flatnonzero(lcp).astype(np.int32)
    depth = lcp[at]
    lows = [np.r_[lcp, np.int32(0)]]             # lows[k][j]: least of lcp[j : j + 2 ** k]
    while 1 << len(lows) <= largest:
        half, low = 1 << (len(lows) - 1), lows[-1]
        wide = np.zeros(n + 1, np.int32)
        wide[:n + 1 - half] = np.minimum(low[:n + 1 - half], low[half:])
        lows.append(wide)
    left, right = at - 1, at + 1
    for k in reversed(range(len(lows))):
        step = 1 << k
        begin = left - (step - 1)
        wider = (lows[k][np.maximum(begin, 0)] >= depth) & (begin >= 0)
        left[wider] -= step
        wider = lows[k][np.minimum(right, n)] >= depth
        right[wider] += step
    return at, left, right - 1


def branching_squares(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(start, period) of all branching squares, and the ranks of ``suffix_order``."""
    n = len(key)
    sa, levels = suffix_order(key)
    isa, lcp = levels[-1], neighbour_lcp(sa, levels)
    none = np.zeros(0, np.int64)
    if not lcp.any():
        return none, none, levels
    heads = np.unique(levels[0])
    at, lb, rb = intervals(lcp, int(np.diff(np.r_[heads, n]).max()))
    depth = lcp[at]
    order = np.argsort(lb.astype(np.int64) * n + rb, kind="stable")
    at, lb, rb, depth = at[order], lb[order], rb[order], depth[order]
    new = np.flatnonzero(np.r_[True, (lb[1:] != lb[:-1]) | (rb[1:] != rb[:-1])])
    # Children of an interval start at its first suffix and at each of its r.
    start = np.insert(at, new, lb[new])
    lb, rb, depth = (np.insert(x, new, x[new]) for x in (lb, rb, depth))
    group = new + np.arange(len(new))
    end = np.r_[start[1:] - 1, 0].astype(np.int32)
    last = np.r_[group[1:], len(start)] - 1
    end[last] = rb[last]
    size = end - start + 1
    most = np.repeat(np.maximum.reduceat(size, group), np.diff(np.r_[group, len(size)]))
    big = np.flatnonzero(size == most)
    owner = np.searchsorted(group, big, side="right")
    tested = np.ones(len(size), bool)
    tested[big[np.r_[True, owner[1:] != owner[:-1]]]] = False
    tested = np.flatnonzero(tested)

    found_i, found_d = [none], [none]
    upto = np.cumsum(size[tested].astype(np.int64))
    a = 0
    while a < len(tested):
        z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + CHUNK, side="right")))
        t = tested[a:z]
        m = size[t]
        inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        i = sa[np.repeat(start[t], m) + inside].astype(np.int64)
        d, lo, hi, cl, cr = (np.repeat(x[t], m) for x in (depth, lb, rb, start, end))

        def other_child(j):
            r = isa[j]
            return (r >= lo) & (r <= hi) & ((r < cl) | (r > cr))

        ahead = other_child(i + d)
        behind = (i >= d) & other_child(np.maximum(i - d, 0))
        found_i += [i[ahead], i[behind] - d[behind]]
        found_d += [d[ahead].astype(np.int64), d[behind].astype(np.int64)]
        a = z
    i, d = np.concatenate(found_i), np.concatenate(found_d)
    once = np.unique(d * n + i)
    return once % n, once // n, levels


def long_enough(i, d, levels, min_length: int, min_exponent: int) -> np.ndarray:
    """Whether square i, d rotates to the left so often that its run is long
    enough, told by comparing ranks of two overlapping pieces."""
    need = np.maximum(min_length, min_exponent * d) - 2 * d
    ok = i - need >= 0
    out = np.zeros(len(i), bool)
    todo = np.flatnonzero(ok & (need > 0))
    a, m = i[todo] - need[todo], need[todo]
    b = a + d[todo]
    k = np.minimum(np.frexp(m.astype(np.float64))[1] - 1, len(levels) - 1)
    for level in np.unique(k):
        w = np.flatnonzero((k == level) & (m < 1 << (level + 1)))
        rank, step = levels[level], 1 << int(level)
        s = m[w] - step
        out[todo[w]] = (rank[a[w]] == rank[b[w]]) & (rank[a[w] + s] == rank[b[w] + s])
    out[ok & (need <= 0)] = True
    return out


def runs_of_block(key: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple]:
    """(start, end, period) of all runs of at least ``min_length`` words and
    ``min_exponent`` (2 or more) periods, by start, then period.  ``key``: numbers
    in which each document ends with a unique one."""
    i, d, levels = branching_squares(key)
    keep = long_enough(i, d, levels, min_length, min_exponent)
    i, d = i[keep], d[keep]
    by_end: dict[int, list[tuple]] = {}
    for start, period in zip(i.tolist(), d.tolist()):        # periods ascend
        end = start + 2 * period
        known = by_end.setdefault(end, [])
        if any(s <= start and period % q == 0 for s, q in known):
            continue
        width = 16
        while start > 0:
            a = max(0, start - width)
            differ = np.flatnonzero(key[a:start] != key[a + period:start + period])
            if len(differ):
                start = a + int(differ[-1]) + 1
                break
            start, width = a, 2 * width
        known.append((start, period))
    return sorted((s, end, q) for end, known in by_end.items() for s, q in known)


def split_words(texts) -> tuple[np.ndarray, np.ndarray, object]:
    """(words of each text, word numbers, the words) of an Arrow string column."""
    import pyarrow as pa
    import pyarrow.compute as pc
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    per = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    real = pc.greater(pc.binary_length(words), 0)
    owner = np.repeat(np.arange(len(per)), per)[real.to_numpy(zero_copy_only=False)]
    words = words.filter(real)
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.bincount(owner, minlength=len(per)), codes, words


def best_run(runs: list[tuple]):
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(id, n_words, runs, best, collapsed): one row per document.

    ``runs``: start (word number), length and period, by start, then period;
    ``best``: the run with the greatest length / period (ties: smallest start,
    then period), null without runs; ``collapsed``: the words joined by one
    space, without those that any run holds after its first period.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        for batch in slices(batches, rows=4096, chars=BLOCK_BYTES):
            per, codes, words = split_words(batch.column(1))
            n_docs, n = len(per), len(codes)
            owner = np.repeat(np.arange(n_docs), per)
            # Word w of document o stands at w + o: a number of its own follows each document.
            key = np.empty(n + n_docs, np.int64)
            first = np.cumsum(per) - per + np.arange(n_docs)
            key[np.arange(n) + owner] = owner * (int(codes.max(initial=0)) + 1) + codes
            key[first + per] = n_docs * (int(codes.max(initial=0)) + 1) + np.arange(n_docs)
            found = [[] for _ in range(n_docs)]
            dropped = np.zeros(n + n_docs + 1, np.int64)
            for s, e, q in runs_of_block(key, min_length, min_exponent):
                o = int(np.searchsorted(first, s, side="right")) - 1
                found[o].append((s - int(first[o]), e - s, q))
                dropped[s + q] += 1
                dropped[e] -= 1
            kept = (np.cumsum(dropped)[np.arange(n) + owner] == 0)
            offsets = np.r_[0, np.cumsum(np.bincount(owner[kept], minlength=n_docs))].astype(np.int32)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.filter(pa.array(kept))), " ")
            best = [best_run(r) for r in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(per, pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in found], pa.list_(run_type)),
                pa.array([None if r is None else dict(zip(("start", "length", "period"), r)) for r in best], run_type),
                texts], ["id", "n_words", "runs", "best", "collapsed"])

    one = RUNS.removeprefix("array<")[:-1]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_words bigint, runs {RUNS}, best {one}, collapsed string")


def with_planted_period(text: Column, doc_id: Column) -> Column:
    """The text whose words from a on repeat with period p, for one in ten ids
    (see the query's contract); other texts, and those of null ids, as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return let(F.struct(a.alias("a"), p.alias("p")), lambda s: F.array_join(F.transform(
            words, lambda w, i: F.when(i < s["a"], w).otherwise(F.get(words, s["a"] + (i - s["a"]) % s["p"]))), " "))

    return F.when(h % 10 == 0, let(F.array_remove(F.split(text, SPACE_CLASS), ""), lambda w: F.when(
        F.size(w) > 0, planted(w)).otherwise(F.lit("")))).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", with_planted_period(F.col("text"), F.col("doc_id")).alias("text")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    told = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    exact = (F.lit(1000) * F.col("best.length") - (F.lit(1000) * F.col("best.length")) % F.col("best.period"))
    out = found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        (exact / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    with batch_rows(spark):
        return written(out, "periodic-runs")


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
# Suffix arrays have no SQL form; tests/llm/test_periodic.py holds the query against brute force.
ORACLES: dict[str, str] = {}
