import numpy as np
from xxhash import xxh64_intdigest

from pyspark.sql import functions as F

from fundlake.llm import graph, simhash
from tests.llm.helpers import SF, documents, sf


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    out = 0
    for bit in range(64):
        n = sum(xxh64_intdigest(s, 42) >> bit & 1 for s in shingles)
        out |= (2 * n > len(shingles)) << bit
    return out


def brute_components(fps):
    """fps: list of (id, fingerprint) -> smallest id reachable, per row."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    out = []
    for i in range(len(fps)):
        ids = [fps[j][0] for j in range(len(fps)) if find(j) == find(i) and fps[j][0] is not None]
        out.append(min(ids) if ids else None)
    return out


def rows(df):
    return sorted(((r.id, r.fp % (1 << 64), r.component) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    got = {r.doc_id: r for r in simhash.op2_simhash(spark, SF).collect()}
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in sf(spark, "documents").collect()]
    for (i, fp), c in zip(docs, brute_components(docs)):
        assert got[i].fingerprint == f"{fp:016x}" and got[i].component_id == c


def test_odd_rows_and_clashing_columns(spark):
    df = documents(spark)
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in df.collect()]
    want = sorted(((i, fp, c) for (i, fp), c in zip(docs, brute_components(docs))), key=str)
    assert rows(simhash.near_duplicates(df)) == want
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    df = documents(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    want = {r.component for r in simhash.near_duplicates(df).collect()} - {None}
    assert ids == sorted([*want, None, None], key=str)


def test_links_found_in_chunks_span_the_same_components(spark):
    """A dense group over many chunks, chains of three bits and lone rows."""
    rng = np.random.default_rng(1)
    center = int(rng.integers(0, 2**63))
    fps = {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (400, 2))}
    x = int(rng.integers(0, 2**63))
    for _ in range(30):
        fps.add(x)
        for b in rng.choice(64, 3, replace=False):
            x ^= 1 << int(b)
    fps |= {int(v) for v in rng.integers(0, 2**63, 300)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    want = brute_components([(f - (1 << 64) if f >> 63 else f, f) for f in fps])
    for chunk in (16, 8192):
        found = {r.node: r.root for r in graph.components(simhash.links(nodes, chunk=chunk)).collect()}
        lone = {f: f for f in (f - (1 << 64) if f >> 63 else f for f in fps)}
        got = [(lone | found)[f - (1 << 64) if f >> 63 else f] for f in fps]
        assert got == want


def test_pivot_filter_discards_no_link():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in set(rng.integers(0, 64, 3))) for _ in a], np.uint64)
    refs = simhash.references()
    da = np.bitwise_count(a[:, None] ^ refs).astype(int)
    db = np.bitwise_count((a ^ flips)[:, None] ^ refs).astype(int)
    assert np.abs(da - db).max() <= 3


def test_long_chain_settles(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(7, 7), (1, 0)], "u long, v long")
    got = {r.node: r.root for r in graph.components(df).collect()}
    assert got == {i: 0 for i in range(201)}
    assert graph.components(df.limit(0)).count() == 0


def test_repeated_and_null_ids_lose_no_text_and_leave_no_copies(spark):
    rng = np.random.default_rng(6)
    a, b, c, d = (" ".join(f"w{v}" for v in rng.integers(0, 10_000, 60)) for _ in range(4))
    rows = [(5, a), (5, b), (6, b), (5, a), (7, c), (None, d), (None, d), (None, d + " "), (None, c), (None, c)]
    kept = simhash.keep_one(documents(spark, rows))
    assert sorted(((r.doc_id, r.text.strip()) for r in kept.collect()), key=str) == sorted(
        [(5, a), (5, b), (7, c), (None, c), (None, d)], key=str)


def test_a_hub_s_links_are_split_in_the_final_plans(spark, monkeypatch):
    """Half of all links at one node: every join that reads them is split."""
    n = 60_000
    df = spark.range(1, n).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") * 1000).alias("u"),
                                  (F.col("id") * 1000 + 1).alias("v"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        e = graph.written(df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "hub")
        for stars, links in ((graph._large_star, graph._both_ways(e)), (graph._small_star, e)):
            if stars is graph._small_star:
                e = graph.written(e.select(F.when(F.col("v") == 0, F.lit(10 ** 9)).otherwise(F.col("u")).alias("u"), F.when(
                    F.col("v") == 0, F.col("u")).otherwise(F.col("v")).alias("v")), "hub-up")
                links = e
            out = stars(e, graph._lows(links))
            out.collect()
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString(), stars
        got = {r.root for r in graph.components(df.where("u = 0")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {0}
