from fundlake.sources.landing import LANDING_SCHEMAS
from fundlake.streaming.incremental import land_new_files

HEAD = "enrollment_id,institution_id,program_code,fiscal_year,headcount\n"


def test_new_files_land_exactly_once(spark, tmp_path):
    inbox, table, ckpt = tmp_path / "inbox", str(tmp_path / "t"), str(tmp_path / "ck")
    inbox.mkdir()
    schema = LANDING_SCHEMAS["enrollments"]
    (inbox / "a.csv").write_text(HEAD + "E1, I-002 ,PRG-A,2023,NULL\nE2,INST-001,PRG-A,2023,5\n")
    land_new_files(spark, str(inbox), schema, table, ckpt)
    assert spark.read.parquet(table).count() == 2
    land_new_files(spark, str(inbox), schema, table, ckpt)   # nothing new
    assert spark.read.parquet(table).count() == 2
    (inbox / "b.csv").write_text(HEAD + "E3,INST-003,PRG-B,2024,\n")
    land_new_files(spark, str(inbox), schema, table, ckpt)
    rows = {r.enrollment_id: r for r in spark.read.parquet(table).collect()}
    assert sorted(rows) == ["E1", "E2", "E3"]
    assert rows["E1"].institution_id == "I-002" and rows["E1"].headcount is None
    assert rows["E3"].headcount is None


def test_ragged_lines_and_rejects_like_the_batch_reader(spark, tmp_path):
    inbox, good, bad, ckpt = tmp_path / "in", str(tmp_path / "g"), str(tmp_path / "b"), str(tmp_path / "ck2")
    inbox.mkdir()
    schema = LANDING_SCHEMAS["enrollments"]
    (inbox / "a.csv").write_text(HEAD + "E1,INST-001,PRG-A,2023\nE2,INST-001,PRG-A,2023,5,extra\n,INST-002,PRG-B,2023,7\n")
    args = (spark, str(inbox), schema, good, ckpt)
    assert land_new_files(*args, key="enrollment_id", rejects_path=bad) == 1
    assert land_new_files(*args, key="enrollment_id", rejects_path=bad) == 0
    rows = {r.enrollment_id: (r.headcount, r.ragged) for r in spark.read.parquet(good).collect()}
    assert rows == {"E1": (None, True), "E2": ("5", True)}
    assert [(r.institution_id, r.ragged) for r in spark.read.parquet(bad).collect()] == [("INST-002", False)]


def test_every_micro_batch_is_counted(spark, tmp_path):
    inbox = tmp_path / "many"
    inbox.mkdir()
    for i in range(5):
        (inbox / f"{i}.csv").write_text(HEAD + f"E{i},INST-001,PRG-A,2023,1\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        n = land_new_files(spark, str(inbox), LANDING_SCHEMAS["enrollments"], str(tmp_path / "t5"), str(tmp_path / "c5"),
                           max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert n == 5 and spark.read.parquet(str(tmp_path / "t5")).count() == 5
