from pyspark.sql import functions as F

from fundlake.llm import rollup as R

CHANGES = "old {0}, new {0}".format(R.SIDE)


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGES)


def totals(r):
    return {(x.source, x.lang, x.version): (x.n_docs, x.n_tokens) for x in r.totals().collect()}


A, B = ("s", "en", "v1", 10), ("s", "en", "v2", 12)


def test_inserts_revisions_and_deletes(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    assert totals(r) == {}
    assert r.commit("1", changes(spark, [(None, A), (None, A), (None, ("t", None, "v1", None))]))
    assert totals(r) == {("s", "en", "v1"): (2, 20), ("t", None, "v1"): (1, 0)}
    assert r.commit("2", changes(spark, [(A, B), (("t", None, "v1", None), None)]))
    assert totals(r) == {("s", "en", "v1"): (1, 10), ("s", "en", "v2"): (1, 12)}


def test_a_batch_counts_once(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    assert r.commit("a/b ä", changes(spark, [(None, A)]))
    assert not r.commit("a/b ä", changes(spark, [(None, A)]))
    assert totals(r) == {("s", "en", "v1"): (1, 10)} and r.batches() == ["a/b ä"]


def test_a_broken_off_batch_is_overwritten(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    r.commit("1", changes(spark, [(None, A)]))
    # rows written, ledger entry missing: they do not count, and a retry does not add to them
    R._added(R.signed(changes(spark, [(None, B)]))).write.parquet(f"{r.path}/data/{b'2'.hex()}")
    assert totals(r) == {("s", "en", "v1"): (1, 10)}
    assert r.commit("2", changes(spark, [(None, B)]))
    assert totals(r) == {("s", "en", "v1"): (1, 10), ("s", "en", "v2"): (1, 12)}


def test_compaction_keeps_totals_and_ids(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    r.commit("1", changes(spark, [(None, A), (None, B)]))
    r.commit("2", changes(spark, [(A, None)]))
    c = r.compact(str(tmp_path / "c"))
    assert totals(c) == totals(r) == {("s", "en", "v2"): (1, 12)} and c.batches() == r.batches()
    assert not c.commit("2", changes(spark, [(A, None)]))


def test_odd_rows_and_empty_batches(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    extra = changes(spark, [(None, None), (None, (None, None, None, None))]).withColumn("n_docs", F.lit(5))
    assert r.commit("1", extra) and r.commit("2", changes(spark, []))
    assert totals(r) == {(None, None, None): (1, 0)}


def test_two_writers_of_a_batch_count_once(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    r.commit("1", changes(spark, [(None, A)]))
    # Both passed the check before either had an entry: each wrote rows, one entry stands.
    for folder in ("bone", "btwo"):
        R._added(R.signed(changes(spark, [(None, B)]))).write.parquet(f"{r.path}/batches/folder={folder}")
    r._enter("2", "bone")
    r._enter("2", "btwo")
    assert totals(r) == {("s", "en", "v1"): (1, 10), ("s", "en", "v2"): (1, 12)} and r.batches() == ["1", "2"]
    # rows without an entry are not read
    R._added(R.signed(changes(spark, [(None, B)]))).write.parquet(f"{r.path}/batches/folder=bthree")
    assert totals(r) == {("s", "en", "v1"): (1, 10), ("s", "en", "v2"): (1, 12)}


def test_many_batches_are_one_scan(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    names = [f"batch {i} " + "x" * 300 for i in range(12)]
    for n in names:
        assert r.commit(n, changes(spark, [(None, A)]))
    assert totals(r) == {("s", "en", "v1"): (12, 120)}
    plan = r.totals()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("n_tokens#") and plan.count("parquet") == 1 and r.batches() == sorted(names)
    c = r.compact(str(tmp_path / "c"))
    assert c.commit("later", changes(spark, [(A, B)])) and not c.commit(names[3], changes(spark, [(None, A)]))
    assert totals(c) == {("s", "en", "v1"): (11, 110), ("s", "en", "v2"): (1, 12)}
    d = c.compact(str(tmp_path / "d"))
    assert totals(d) == totals(c) and d.batches() == sorted([*names, "later"])
