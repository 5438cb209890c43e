import datetime as dt

from pyspark.sql import functions as F

from fundlake.sources.snapshots import as_of, write_snapshot


def test_two_snapshots_read_each(spark, tmp_path):
    path = str(tmp_path / "snap")
    v1 = spark.createDataFrame([(1, "Pending"), (2, "Approved")], "id int, status string")
    v2 = v1.withColumn("status", F.lit("Approved"))
    write_snapshot(v1, path, "2024-01-01 00:00:00")
    write_snapshot(v2, path, "2024-01-01 01:00:00")
    early = {r.id: r.status for r in as_of(spark, path, "2024-01-01 00:30:00").collect()}
    late = {r.id: r.status for r in as_of(spark, path, dt.datetime(2024, 1, 2)).collect()}
    assert early == {1: "Pending", 2: "Approved"}
    assert late == {1: "Approved", 2: "Approved"}
    assert as_of(spark, path, "2023-12-31 00:00:00").count() == 0


def test_relative_offset(spark, tmp_path):
    from fundlake.sources.snapshots import at_offset
    path = str(tmp_path / "snap2")
    now = dt.datetime(2024, 6, 1, 12, 0, 0)
    write_snapshot(spark.createDataFrame([(1,)], "id int"), path, now - dt.timedelta(hours=2))
    write_snapshot(spark.createDataFrame([(1,), (2,)], "id int"), path, now - dt.timedelta(minutes=5))
    assert at_offset(spark, path, 3600, now=now).count() == 1
    assert at_offset(spark, path, 60, now=now).count() == 2


def test_a_repeated_write_replaces_its_own_snapshot_only(spark, tmp_path):
    path = str(tmp_path / "snap3")
    old = spark.createDataFrame([(9,)], "id int")
    new = spark.createDataFrame([(i,) for i in range(5)], "id int")
    write_snapshot(old, path, "2024-01-01 00:00:00")
    for _ in range(2):
        write_snapshot(new, path, "2024-01-01 01:00:00")
    assert as_of(spark, path, "2024-01-01 02:00:00").count() == 5
    assert [r.id for r in as_of(spark, path, "2024-01-01 00:10:00").collect()] == [9]


def test_finding_the_newest_snapshot_opens_no_file(spark, tmp_path):
    from fundlake.sources.snapshots import snapshot_times
    path = str(tmp_path / "snap4")
    write_snapshot(spark.createDataFrame([(1,)], "id int"), path, "2024-01-01 00:00:00")
    times = snapshot_times(spark, path)
    assert "FileScan" not in times._jdf.queryExecution().executedPlan().toString()
    assert [r.snapshot_ts for r in times.collect()] == [dt.datetime(2024, 1, 1)]
