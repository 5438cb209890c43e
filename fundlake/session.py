"""Session helpers: a tuned local session for tests/bench and the shared
scratch location used to cut lineage or stage files."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "fundlake", extra: dict | None = None) -> SparkSession:
    """Local session with the settings the test-suite and bench use.

    On a cluster, build the session with the cluster's own launcher; none
    of the library code depends on these values.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the
    session, or the checkpoint folder set on its context.

    Only a session in one process (master ``local``) may go without; it gets a
    private folder.  On a cluster each executor would write to its own disk,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base:
        return base
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="fundlake-ckpt-")
    sc.setCheckpointDir(base)
    return base


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable-checkpoint folder of the session's context."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_base(spark))
    return sc.getCheckpointDir()


_MADE: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared folder, remembered for
    ``clear_shared``."""
    path = os.path.join(shared_base(spark), f"{purpose}-{uuid.uuid4().hex[:12]}")
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_shared(spark: SparkSession) -> int:
    """Delete the folders this session got from ``shared_dir``; returns how
    many there were.  Frames that read them can't be used afterwards."""
    gone = 0
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return gone


# Target bytes of shuffle data per reduce task, and of input per scan task.
SHUFFLE_BYTES_PER_TASK = 256 * 1024 * 1024
SCAN_BYTES_PER_TASK = 512 * 1024 * 1024


def cluster_conf(input_bytes: int, total_cores: int) -> dict:
    """Settings for a run over ``input_bytes`` of parquet on ``total_cores``.

    * shuffle partitions: enough that one reduce task handles about
      256 MB (spill-free on a few-GB executor core), never fewer than two
      waves of cores; AQE then coalesces the small ones and splits skewed
      ones.
    * scan splits of 512 MB.
    * broadcast only small sides (64 MB measured size), skew-join on.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // SHUFFLE_BYTES_PER_TASK))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES_PER_TASK),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES_PER_TASK),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
