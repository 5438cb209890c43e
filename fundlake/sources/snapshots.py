"""Point-in-time reads over full-refresh tables.

Each refresh is appended under its own ``snapshot_ts`` partition.  A read
"as of" a time resolves the newest snapshot not after it with a scalar
subquery over the partition column; the scan then prunes to that one
partition at run time.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_COL = "snapshot_ts"


def write_snapshot(df: DataFrame, path: str, ts) -> None:
    """Write ``df`` as the snapshot taken at ``ts`` (a timestamp literal string
    or datetime).  Writing the same ``ts`` again replaces that snapshot and no
    other, so a retried refresh counts once."""
    (df.withColumn(SNAPSHOT_COL, F.lit(ts).cast("timestamp"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(SNAPSHOT_COL).parquet(path))


def snapshot_times(spark: SparkSession, path: str) -> DataFrame:
    """The times a snapshot was taken at, from the folder names alone."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [f.getPath().getName() for f in found]
    times = [unquote(n.partition("=")[2]) for n in names if n.startswith(f"{SNAPSHOT_COL}=")]
    return spark.createDataFrame([(t,) for t in times], f"{SNAPSHOT_COL} string").select(
        F.col(SNAPSHOT_COL).cast("timestamp").alias(SNAPSHOT_COL))


def as_of(spark: SparkSession, path: str, ts) -> DataFrame:
    """The table as it was at ``ts`` (NULL-free: no snapshot yet -> no rows).

    The newest snapshot not after ``ts`` is found in the folder names, so no
    older snapshot's file is opened; the scan prunes to that one folder."""
    at: Column = F.lit(ts).cast("timestamp") if not isinstance(ts, Column) else ts
    pick = snapshot_times(spark, path).where(F.col(SNAPSHOT_COL) <= at).agg(
        F.max(SNAPSHOT_COL)).scalar()
    snaps = spark.read.parquet(path)
    return snaps.where(F.col(SNAPSHOT_COL) == pick).drop(SNAPSHOT_COL)


def at_offset(spark: SparkSession, path: str, seconds: int, now=None) -> DataFrame:
    """Relative time travel: the table ``seconds`` before ``now``."""
    base = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return as_of(spark, path, base - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                        F.lit(seconds)))
