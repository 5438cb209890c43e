import numpy as np
from pyspark.sql import functions as F

from fundlake.llm import kernel
from fundlake.llm.common import held_out
from tests.llm.helpers import documents, labels

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_ranges(spark):
    out = kernel.op6_quality_kernel(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    test = [r for r in out if r.held_out]
    assert test and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert np.mean([r.predicted == r.quality for r in test]) >= 0.95
    good = [r.predicted for r in test if r.quality == 1]
    assert np.mean(good) >= 0.97


def test_held_out_is_crc32_of_the_id_text(spark):
    import zlib
    for r in spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = known.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    stats = kernel.features(docs)
    a, b = (kernel.fit(stats, k, "quality") for k in (known, turned))
    x = kernel.statistics([r.text for r in docs.limit(50).collect()])
    assert np.allclose(a.score(x), b.score(x), atol=1e-9)


def test_normal_equations_equal_one_matrix(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.normal(size=len(kernel.STATS))]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, stats array<double>").repartition(7)
    x = np.array([r[1] for r in rows])

    def part(b):
        m = kernel._matrix(b.column("stats"))
        return (m.T @ m).ravel()

    got = kernel.summed(df.select("stats"), part, len(kernel.STATS) ** 2)
    assert np.allclose(got, (x.T @ x).ravel())


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 6))
    z = kernel.fourier(x, n=20_000, bandwidth=2.0)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 2.0 ** 2))
    assert np.abs(z @ z.T - want).max() < 0.06


def test_pool_adjacent_is_the_isotonic_fit():
    rng = np.random.default_rng(2)
    for _ in range(30):
        w = rng.integers(1, 5, 12).astype(float)
        t = rng.integers(0, 2, 12) * w
        got = kernel.pool_adjacent(t, w)
        y = t / w
        brute = [max(min((y[a:b + 1] * w[a:b + 1]).sum() / w[a:b + 1].sum() for b in range(i, 12)) for a in range(i + 1))
                 for i in range(12)]
        assert np.allclose(got, brute)


def test_odd_rows_no_labels_and_empty_table(spark):
    df = documents(spark)
    stats = kernel.features(df)
    nothing = kernel.fit(stats, labels(spark, [(1, None, None)]), "quality")
    assert {r.score for r in kernel.score(stats, nothing).collect()} == {0.5}
    model = kernel.fit(stats, labels(spark, [(1, 1, 0), (2, 0, 0), (None, 1, 1), (7, 0, 0), (5, 1, 0)]), "quality")
    got = kernel.score(stats, model).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    by_col = df.select("doc_id", kernel.score_column(F.col("text"), model).alias("s")).collect()
    assert np.allclose(sorted(r.s for r in by_col), sorted(r.score for r in got))
    none = kernel.features(df.limit(0))
    assert kernel.score(none, kernel.fit(none, labels(spark), "quality")).count() == 0
