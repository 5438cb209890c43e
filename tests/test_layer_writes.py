"""How the layers are written: no shuffle before a fact's folders, small files."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from fundlake.operators.lookup import flag_orphans
from fundlake.plans import pipeline

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def _facts(spark, years, rows=600, tasks=3):
    return spark.range(0, rows, 1, tasks).select(
        F.concat(F.lit("ENR-"), F.col("id").cast("string")).alias("enrollment_id"),
        F.when(F.col("id") % 7 != 0, F.col("id") % years + 1).alias("date_key"), (F.col("id") % 50).alias("headcount"))


def test_each_task_writes_its_own_rows_of_each_year(spark, tmp_path):
    df, before = _facts(spark, 2), spark.conf.get(OPEN_FILES, None)
    with pipeline._open_files(spark, 16):
        back = pipeline._write_read(spark, df, f"{tmp_path}/f", partition_by="date_key")
    assert spark.conf.get(OPEN_FILES, None) == before
    files = glob.glob(f"{tmp_path}/f/date_key=*/*.parquet")
    # three tasks, two years and the rows without one: nothing was dealt anew
    assert len(files) == 9
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    assert back.columns == df.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_more_years_than_open_files(spark, tmp_path):
    df = _facts(spark, 20)
    with pipeline._open_files(spark, 4):
        back = pipeline._write_read(spark, df, f"{tmp_path}/f", partition_by="date_key")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_orphan_join_shuffles_a_key_once(spark):
    child = spark.createDataFrame([("d1", "a"), ("d2", None), ("d3", "x"), ("d4", "a"), ("d5", None)], "id string, app string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "app string")
    out = flag_orphans(child, parent.hint("merge"), "app", "orphan", parent_unique=True)
    rows = sorted(map(tuple, out.collect()))
    assert rows == [("d1", "a", False), ("d2", None, True), ("d3", "x", True), ("d4", "a", False), ("d5", None, True)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_ckey" not in plan and plan.count("coalesce(") == 1
