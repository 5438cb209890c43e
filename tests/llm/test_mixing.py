import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlake.llm import mixing
from tests.llm.helpers import documents

SF01 = "/root/testdata/sf0.01"


def known(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.3, 0.3, 0.3], n)
    t = rng.integers(0, 500, n)
    return p, t, spark.createDataFrame([(i, int(t[i]), [float(v) for v in p[i]]) for i in range(n)],
                                       "id long, tokens long, p array<double>")


def test_totals_match_targets_with_nonnegative_rates(spark):
    p, t, df = known(spark)
    mixer = mixing.Mixer(("a", "b", "c"), None)
    targets = {"a": 0.6, "b": 0.3, "c": 0.1}
    rated = sorted(mixing.fit_rates(df, mixer, targets, budget=1.5 * t.sum(), max_steps=300).collect(), key=lambda r: r.id)
    r = np.array([x.rate for x in rated])
    assert (r >= 0).all()
    assert np.allclose((r * t) @ p / t.sum(), 1.5 * np.array([0.6, 0.3, 0.1]), atol=5e-3)
    assert np.allclose(mixer.rates(p), r)                       # replay equals the distributed steps


def test_steps_equal_one_machine_descent(spark):
    p, t, df = known(spark, 60, 1)
    mixer = mixing.Mixer(("a", "b", "c"), None)
    want = np.array([0.8, 0.1, 0.1]) * 2
    got = mixing.fit_rates(df, mixer, {"a": 0.8, "b": 0.1, "c": 0.1}, budget=2.0 * t.sum(), max_steps=20)
    r = np.ones(60)
    for _ in mixer.residuals:
        e = (r * t) @ p / t.sum() - want
        r = np.maximum(0, r - mixer.step * (p @ e + mixer.pull * (r - 1)))
    assert np.allclose(r, [x.rate for x in sorted(got.collect(), key=lambda x: x.id)])


def test_query_learns_languages_and_keeps_every_document(spark):
    out = mixing.op4_soft_mixing(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet"), "doc_id").collect()
    assert len(out) == 1000
    right = [max(mixing.TARGETS, key=lambda d: r[f"p_{d}"]) == r.lang for r in out]
    assert np.mean(right) >= 0.97 and min(r.rate for r in out) >= 1
    total = {d: sum(r.rate * r.tokens * r[f"p_{d}"] for r in out) for d in mixing.TARGETS}
    for d, w in mixing.TARGETS.items():
        assert abs(total[d] / sum(total.values()) - w) < 0.01


def test_copies_follow_rates(spark):
    df = spark.range(20_000).select("id", F.lit(1.3).alias("rate"), F.lit(2.0).alias("two"), F.lit(0.0).alias("none"))
    r = df.select(*[mixing.copies(F.col(c), F.col("id")).alias(c) for c in ("rate", "two", "none")]).agg(
        F.avg("rate").alias("rate"), F.min("two").alias("two"), F.max("none").alias("none")).first()
    assert abs(r.rate - 1.3) < 0.02 and r.two == 2 and r.none == 0


def test_odd_rows_no_labels_and_empty_table(spark):
    df = documents(spark)
    none = spark.createDataFrame([], "id long, domain string")
    mixer, rated = mixing.fit(df, none, mixing.TARGETS)
    assert rated.count() == df.count() and all(r.rate >= 0 for r in rated.collect())
    mixed = mixing.mix(df, mixer)
    assert mixed.columns == df.columns
    one = spark.createDataFrame([(1, "en"), (5, "en"), (None, "de"), (7, "xx")], "id long, domain string")
    mixer, rated = mixing.fit(df, one, mixing.TARGETS)
    assert rated.count() == df.count()
    mixer, rated = mixing.fit(df.limit(0), none, mixing.TARGETS)
    assert rated.count() == 0 and mixing.mix(df.limit(0), mixer).count() == 0


def skewed(spark, shares, n=4000):
    rng = np.random.default_rng(5)
    y, t = rng.choice(4, n, p=shares), rng.integers(1, 500, n)
    p = np.full((n, 4), 0.02 / 3)
    p[np.arange(n), y] = 0.98
    return p, t, spark.createDataFrame([(i, int(t[i]), p[i].tolist()) for i in range(n)],
                                       "id long, tokens long, p array<double>")


def test_defaults_reach_targets_whatever_the_shares(spark):
    want = np.array(list(mixing.TARGETS.values()))
    for shares in ([0.9, 0.06, 0.03, 0.01], [0.97, 0.015, 0.01, 0.005]):
        p, t, df = skewed(spark, shares)
        mixer = mixing.Mixer(tuple(mixing.TARGETS), None)
        r = np.array([x.rate for x in sorted(mixing.fit_rates(df, mixer, mixing.TARGETS).collect(), key=lambda x: x.id)])
        total = (r * t) @ p
        assert (r >= 0).all() and np.allclose(mixer.rates(p), r)
        assert np.abs(total / total.sum() - want).max() <= 2 * mixing.TOLERANCE and mixer.missed <= mixing.TOLERANCE


def test_targets_out_of_reach_are_reported(spark):
    df = spark.createDataFrame([(i, 10, [1.0, 0.0, 0.0, 0.0]) for i in range(50)], "id long, tokens long, p array<double>")
    mixer = mixing.Mixer(tuple(mixing.TARGETS), None)
    with pytest.warns(UserWarning, match="misses its targets"):
        rated = mixing.fit_rates(df, mixer, mixing.TARGETS)
    assert mixer.missed > 0.1 and all(0 < r.rate < 10 for r in rated.collect())


def one_machine(p, t, want, pull=mixing.EXACT_PULL, close=mixing.TOLERANCE):
    """Scaled projected gradient in numpy, rates held as one vector."""
    r, n = np.ones(len(t)), t.sum()

    def misses(r):
        return (r * t) @ p / n - want

    def value(r):
        return (misses(r) ** 2).sum() / 2 + pull / 2 * (t * (r - 1) ** 2).sum() / n

    for _ in range(50):
        e = misses(r)
        if np.abs(e).max() <= close:
            break
        free = (r > 0) | (p @ e < 0)
        w = t[free, None] * p[free] / n
        v = np.linalg.solve(w.T @ p[free] + pull * np.eye(len(want)), e - w.T @ (r[free] - 1))
        length = 1.0
        while length > 1e-6:
            new = np.where(free, np.maximum(0, (1 - length) * r + length * (1 - p @ v)), 0)
            if value(new) < value(r) * (1 - 1e-4 * length):
                break
            length /= 2
        r = new
    return r


@pytest.mark.parametrize("targets, budget", [([0.6, 0.3, 0.1], None), ([0.05, 0.05, 0.9], 0.4), ([0.3, 0.3, 0.4], 1.0), ([0.02, 0.9, 0.08], 3.0)])
def test_registered_path_equals_one_machine(spark, targets, budget):
    p, t, df = known(spark, 400, 3)
    mixer = mixing.Mixer(("a", "b", "c"), None)
    rated = mixing.fit_rates(df, mixer, dict(zip("abc", targets)), None if budget is None else budget * t.sum())
    r = np.array([x.rate for x in sorted(rated.collect(), key=lambda x: x.id)])
    share = t @ p / t.sum()
    scale = budget or mixing.HEADROOM * max(1.0, *(share / np.array(targets)))
    want = np.array(targets) * scale
    assert np.allclose(r, one_machine(p, t, want, close=mixing.TOLERANCE * scale)) and np.allclose(r, mixer.rates(p))
    assert (r >= 0).all() and np.abs((r * t) @ p / t.sum() - want).max() <= mixing.TOLERANCE * scale
    assert mixer.steps and not mixer.residuals
    # Of all rates that meet these totals, ours are (nearly) the closest to 1.
    other = np.maximum(0, r + 0.05 * np.random.default_rng(1).normal(size=len(r)))
    a = (t[:, None] * p / t.sum()).T
    other -= (p @ np.linalg.solve(a @ p, a @ (other - r)))
    if (other >= 0).all():
        assert (t * (other - 1) ** 2).sum() >= 0.999 * (t * (r - 1) ** 2).sum()


def test_an_id_of_many_rows_sends_one_row_to_the_driver(spark):
    docs = spark.createDataFrame([(1, f"the and of {i}") for i in range(500)] + [(2, "der die das und"), (3, "le la les")],
                                 "doc_id long, text string")
    labelled = spark.createDataFrame([(1, "en"), (1, "en"), (2, "de"), (3, "fr")], "id long, domain string")
    weights = mixing.learn(docs, labelled, ("en", "de", "fr"), "doc_id", "text")
    x, _ = mixing.byte_pairs(["the and of 7", "der und die", "la le les"])
    assert mixing.Mixer(("en", "de", "fr"), weights).posteriors(x).argmax(axis=1).tolist() == [0, 1, 2]
