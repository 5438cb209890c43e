import numpy as np
from pyspark.sql import functions as F

from fundlake.llm import pivots


def brute(rows, limit=0.93):
    unit = []
    for _, v, label in rows:
        x = None if v is None else np.array([np.nan if c is None else c for c in v], float)
        ok = x is not None and label is not None and len(x) == 8 and np.isfinite(x).all() and np.abs(x).max() > 0
        unit.append(x / np.linalg.norm(x) if ok else None)
    near = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None
             and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= limit] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def random_rows(n=400, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 8))
    rows = []
    for i in range(n):
        x = base[i % 40] + 0.08 * rng.normal(size=8) if i % 3 else rng.normal(size=8)
        rows.append((i, [float(np.float32(c)) for c in x], int(i % 40 % 3)))
    return rows


def answers(df):
    return sorted(((r.id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_recall_and_no_false_link(spark):
    rows = random_rows()
    want = {i: n for i, n, _ in brute(rows)}
    got = {r.id: r.n_links for r in pivots.near_duplicates(table(spark, rows)).collect()}
    assert len(got) == len(rows) and all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.9 * sum(want.values()) > 100


def test_blocks_change_nothing(spark):
    df = table(spark, random_rows())
    assert answers(pivots.near_duplicates(df, block=7)) == answers(pivots.near_duplicates(df))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (None, v, 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [0.0] * 8, 0),
            (7, [nan] + v[1:], 0), (8, [inf] + v[1:], 0), (9, [None] + v[1:], 0), (10, v[:3], 0), (11, [], 0),
            (12, [1e-30 * x for x in v], 0), (13, [-x for x in v], 0)]
    got = pivots.near_duplicates(table(spark, rows))
    assert answers(got) == sorted(brute(rows), key=str)
    assert all(r.kept == (r.id is not None and r.id == r.component_id) for r in got.collect())


def test_empty_table_and_clashing_columns(spark):
    assert pivots.near_duplicates(table(spark, [])).count() == 0
    df = table(spark, random_rows(30)).selectExpr("*", "1 as id", "2 as row", "3 as near", "4 as n_links")
    assert pivots.near_duplicates(df).count() == 30


def whole(spark, rows):
    want = {i: n for i, n, _ in brute(rows)}
    assert {r.id: r.n_links for r in pivots.near_duplicates(table(spark, rows)).collect()} == want and max(want.values())


def test_two_equal_rows_and_one_cluster(spark):
    v = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    whole(spark, [(1, v, 0), (2, v, 0)])
    rng = np.random.default_rng(7)
    whole(spark, [(i, [float(np.float32(c)) for c in np.array(v) + 0.3 * rng.normal(size=8)], i % 2) for i in range(60)])


def test_vectors_with_a_common_mean(spark):
    rng = np.random.default_rng(8)
    for mean in (2.0, 6.0):
        base = rng.normal(size=(60, 8)) + mean
        whole(spark, [(i, [float(np.float32(c)) for c in base[i % 60] + 0.02 * rng.normal(size=8)], 0) for i in range(120)])


def test_copies_take_no_place_in_the_sample(spark):
    rng = np.random.default_rng(9)
    spread = [[float(np.float32(c)) for c in rng.normal(size=8)] for _ in range(40)]
    df = spark.createDataFrame([(v,) for v in spread], "v array<float>")
    first = df.orderBy(F.xxhash64("v", F.lit(7))).first().v
    rows = [(i, first, 0) for i in range(200)] + [(200 + i, v, 0) for i, v in enumerate(spread + spread)]
    sampled = pivots.hashed_sample(table(spark, rows), F.xxhash64("embedding", F.lit(7)), 30)
    assert sampled.count() == 30
    assert len(pivots.fit_pivots(table(spark, rows), "embedding", len(rows))) > 6
    whole(spark, rows)


def test_copies_are_one_entry_of_each_list(spark):
    rows = random_rows(120)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(80)]
    index = pivots.permutations(table(spark, rows), pivots.pivots_by_length(table(spark, rows), "embedding", len(rows)),
                                "vec_id", "embedding", "label")
    nodes = pivots.folded(index).collect()
    assert len(nodes) == 120 and max(r.weight for r in nodes) == 81 and sum(r.weight for r in nodes) == 200
    got = {r.id: r.n_links for r in pivots.near_duplicates(table(spark, rows)).collect()}
    want = {i: n for i, n, _ in brute(rows)}
    assert all(got[i] <= want[i] for i in got) and got[1000] == got[5] >= 80
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_every_length_links_with_its_own(spark):
    v = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    rows = [(i, v, 0) for i in range(3)] + [(10, v[:3], 0), (11, v[:3], 0), (12, [2.0, 4.0, 6.0], 0), (13, v[:3], 1), (20, [1.0], 0), (21, [3.0], 0)]
    for known in (True, False):              # with and without a pivot of the rare lengths
        df = table(spark, rows)
        found = pivots.pivots_by_length(df, "embedding", len(rows))
        if not known:
            found = {8: found[8]}
        index = pivots.written(pivots.permutations(df, found, "vec_id", "embedding", "label"), "test-index")
        nodes = pivots.written(pivots.folded(index), "test-nodes")
        linked = {r.row for r in pivots.compare(nodes, "<f4").where("other is null").collect()}
        ids = {r.row: r.id for r in index.collect()}
        assert {ids[r] for r in linked} >= {12, 20, 21} and 13 not in {ids[r] for r in linked}
    got = {r.id: (r.n_links, r.component_id) for r in pivots.near_duplicates(table(spark, rows)).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 10: (2, 10), 11: (2, 10), 12: (2, 10), 13: (0, 13), 20: (1, 20), 21: (1, 20)}
