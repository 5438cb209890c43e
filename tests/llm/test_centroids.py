import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlake.llm import centroids
from tests.llm.helpers import SF, sf


def brute(rows, dim=64, k=8, rounds=10):
    """rows: (id, vector) -> sorted [(id, cluster, distance)] and final centroids, in plain integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(1024 * Fraction(c)) for c in v]))
    order = sorted(kept, key=lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    cents = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds if cents else 0):
        at = [c for c, _ in assign()]
        for c in range(len(cents)):
            mine = [v for (_, v), a in zip(kept, at) if a == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, c, d) for (i, _), (c, d) in zip(kept, assign())] if cents else [], cents


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in sf(spark, "embeddings").collect()]
    want, cents = brute(rows)
    got = centroids.op11_centroids(spark, SF).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(want)
    sums = {}
    for _, c, d in want:
        sums[c] = sums.get(c, 0) + d
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (sums[r.cluster], sum(sums.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest()


def table(spark, rows, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.select("*", *[F.lit(1).alias(c) for c in ("id", "q", "big", "lead", "rest", "cluster", "distance")])


def answer(found):
    return sorted(((r.id, r.cluster, r.distance) for r in found[0].collect()), key=str)


def test_odd_vectors_ties_and_clashing_columns(spark):
    rnd = np.random.default_rng(5)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rnd.integers(-3, 4, 4).astype(float).tolist()) for i in range(60)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [1.0, nan, 0.0, 0.0]),
             (105, [inf, 0.0, 0.0, 0.0]), (106, [None, 1.0, 1.0, 1.0]), (None, [0.5, -0.5, 0.0001, -0.0001]), (107, [0.0] * 4)]
    found = centroids.cluster(table(spark, rows), dim=4, k=5, rounds=6, leading=2)
    want, cents = brute(rows, 4, 5, 6)
    assert answer(found) == sorted(want, key=str) and found[1] == cents


def test_very_large_components_stay_exact(spark):
    rows = [(i, [float(i % 7) * 10.0 ** (i % 40), -(i % 5) * 2.0 ** (i % 90), 1.0]) for i in range(50)] + [
        (90, [1.7e308, -1.7e308, 5e-324]), (91, [1e306, 0.0, 0.0])]
    found = centroids.cluster(table(spark, rows), dim=3, k=4, rounds=5, leading=2)
    want, cents = brute(rows, 3, 4, 5)
    assert found[1] == cents
    assert answer(found) == sorted(((i, c, d if d < 2 ** 63 else None) for i, c, d in want), key=str)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [4.0, 2.0])]])
def test_few_rows(spark, rows):
    found = centroids.cluster(table(spark, rows, "float"), dim=2, k=8, rounds=3, leading=2)
    want, cents = brute(rows, 2, 8, 3)
    assert answer(found) == sorted(want, key=str) and found[1] == cents


def test_filter_saves_distances_and_never_changes_the_answer():
    rnd = np.random.default_rng(1)
    middles = rnd.integers(-3000, 3000, (8, 64))
    q = middles[rnd.integers(0, 8, 5000)] + rnd.integers(-300, 300, (5000, 64))
    mean = q.mean(axis=0)
    axes = np.linalg.eigh(np.cov(q.T.astype(float)))[1][:, ::-1][:, :16].T
    seen = []
    cluster, dist = centroids.nearest(q, *centroids.rotated(q, mean, axes), middles.tolist(), mean, axes, seen)
    d = ((q[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (cluster == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
    assert seen[0] < 1.1 * len(q)
    # On a small grid many centroids tie exactly: rounding must not lose the smaller number.
    q = rnd.integers(-2, 3, (3000, 3)) + np.array([NEAR, -NEAR, 0])
    cents = [(q[i]).tolist() for i in range(40)]
    axes = np.linalg.qr(rnd.normal(size=(3, 3)))[0][:2]
    mean = q.mean(axis=0)
    cluster, dist = centroids.nearest(q, *centroids.rotated(q, mean, axes), cents, mean, axes)
    d = ((q[:, None, :] - np.array(cents)[None]) ** 2).sum(axis=2)
    assert (cluster == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()


NEAR = centroids.NARROW - 100
