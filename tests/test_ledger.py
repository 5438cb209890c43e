"""Loads that take each file once, gapless refresh, session roles."""

import pytest
from pyspark.sql import types as T

from fundlake.operators import governance as gov
from fundlake.plans import pipeline
from fundlake.sources import landing
from fundlake.sources.ledger import Ledger

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("k", "a")])


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_each_file_is_taken_once_and_accounted_for(spark, tmp_path):
    inbox, led = tmp_path / "in box", Ledger(spark, str(tmp_path / "led"), SCHEMA, "k")
    assert led.rows().count() == 0 and led.entries().count() == 0
    put(inbox, "a.csv", "k,a\n1,x\n2\n,y\n")
    put(inbox, "empty.csv", "k,a\n")
    first = led.load(str(inbox))
    assert (first.files, first.loaded, first.ragged, first.rejected) == (2, 2, 1, 1)
    assert led.load(str(inbox)) is None
    put(inbox, "b.csv", "k,a\n3,z\n")
    assert led.load(str(inbox)).files == 1
    assert sorted((r.k, r.a, r.ragged) for r in led.rows().collect()) == [("1", "x", False), ("2", None, True), ("3", "z", False)]
    assert [(r.k, r.a) for r in led.rejects().collect()] == [(None, "y")]
    account = {r.path.rsplit("/", 1)[1]: (r.loaded, r.ragged, r.rejected) for r in led.entries().collect()}
    assert account == {"a.csv": (2, 1, 1), "b.csv": (1, 0, 0), "empty.csv": (0, 0, 0)}
    put(inbox, "b.csv", "k,a\n3,z\n4,w\n")                 # a changed file is a new one
    assert led.load(str(inbox)).loaded == 2 and led.rows().count() == 5


def test_quoted_line_breaks_through_the_ledger(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "led"), SCHEMA, "k")
    put(tmp_path / "in", "a.csv", 'k,a\n1,"x\ny"\n,"p\nq"\n')
    done = led.load(str(tmp_path / "in"), multi_line=True)
    assert (done.loaded, done.rejected) == (1, 1) and led.rows().first().a == "x\ny"
    assert led.entries().first().loaded == 1


def test_failed_and_concurrent_loads_add_nothing(spark, tmp_path, monkeypatch):
    root, inbox = str(tmp_path / "led"), tmp_path / "in"
    led, other = Ledger(spark, root, SCHEMA, "k"), Ledger(spark, root, SCHEMA, "k")
    put(inbox, "a.csv", "k,a\n1,x\n")
    commit = Ledger._commit

    def crash(self, aside, to):
        raise OSError("lost")
    monkeypatch.setattr(Ledger, "_commit", crash)
    with pytest.raises(OSError):
        led.load(str(inbox))
    assert led.rows().count() == 0                          # its rows are written, but no entry names them

    def late(self, aside, to):                              # another load commits in between
        monkeypatch.setattr(Ledger, "_commit", commit)
        assert other.load(str(inbox)).loaded == 1
        return commit(self, aside, to)
    monkeypatch.setattr(Ledger, "_commit", late)
    assert led.load(str(inbox)) is None                     # starts anew and finds the file taken
    assert led.rows().count() == 1 and led.entries().count() == 1


def test_refresh_leaves_no_gap(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS star")
    name = "star.refreshed"
    seen = []
    try:
        landing.refresh(spark.range(3), name, str(tmp_path))
        began_before = spark.table(name)
        new = spark.range(10)
        write = type(new.write).parquet

        def watched(self, path, *a, **k):                   # a reader just before and after the files are there
            seen.append(spark.table(name).count())
            write(self, path, *a, **k)
            seen.append(spark.table(name).count())
        type(new.write).parquet = watched
        try:
            landing.refresh(new, name, str(tmp_path))
        finally:
            type(new.write).parquet = write
        assert seen == [3, 3] and spark.table(name).count() == 10 and began_before.count() in (3, 10)
        with pytest.raises(ValueError, match="has"):
            landing.refresh(spark.range(1).selectExpr("id AS other"), name, str(tmp_path))
        assert spark.table(name).count() == 10
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_current_run_is_switched_by_one_rename(spark, tmp_path):
    out = str(tmp_path)
    for run in ("run-1", "run-2", "run-3"):
        pipeline._switch(spark, out, run)
        assert pipeline.current_run(spark, out).endswith(run)


def test_detach_of_an_unknown_name_is_refused(spark):
    df = spark.range(1)
    reg = gov.Registry().attach("star.facts", gov.MaskPolicy("id"))
    for name in ("secret", "star.fact", "`FACT`"):
        with pytest.raises(PermissionError):
            reg.detach(name)
        with pytest.raises(PermissionError):
            reg.secure(name, df, "ADMIN")
    assert reg.detach("`star`.`FACTS`").secure("facts", df, "X").count() == 1


def test_session_role_alone_changes_what_is_seen(spark, tmp_path):
    tables = {"dim_institution": spark.createDataFrame([(1, "I1"), (2, "I2")], "institution_key long, institution_id string"),
              "fact": spark.createDataFrame([(1, 5), (1, 50), (2, 7), (None, 9)], "institution_key long, headcount long")}
    sources = {}
    for n, df in tables.items():
        df.write.parquet(f"{tmp_path}/{n}")
        sources[n] = (f"parquet.`{tmp_path}/{n}`", df.schema)
    ent = spark.createDataFrame([("R", "I1"), ("fundlake_role", "I2")], "role_name string, institution_id string")
    reg = gov.Registry().open("dim_institution").attach("fact", gov.RowPolicy("institution_key", ent, tables["dim_institution"]))
    reg.attach("fact", gov.MaskPolicy("headcount"))
    gov.session_views(spark, reg, sources, ent, prefix="t_")

    def seen(role):
        spark.sql("SET VAR fundlake_role = CAST(:r AS STRING)", args={"r": role})
        return sorted((r.headcount if r.headcount is not None else -1) for r in spark.table("t_fact").collect())
    assert seen(None) == [] and seen("nobody") == []
    assert seen("R") == [-1, 50] and seen("ANALYST") == [5, 7, 9, 50] and seen("R") == [-1, 50]
    plan = spark.table("t_fact")._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "CartesianProduct" not in plan
    spark.sql("SET VAR fundlake_role = 'ADMIN'")
    assert "Join" not in spark.table("t_fact")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(PermissionError):
        gov.session_views(spark, gov.Registry(), sources, ent)
