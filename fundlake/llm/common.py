"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.session import shared_dir

# What separates words in every contract here: space and \x09-\x0D.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A column used inside a lambda may be inlined by the optimizer and would
    then be evaluated for each array element; a lambda variable never is.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage on storage every executor reaches, so a lost executor
    costs a re-read and never a second fit or scan.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the folder of a frame that ``written`` gave, once nothing reads it."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        c = n
        while c.lower() in taken:
            c += "_"
        taken.add(c.lower())
        out.append(c)
    return out


def hashed_sample(df: DataFrame, h: Column, n: int, name: str = "h") -> DataFrame:
    """At most ``n`` rows: those with the smallest values of ``h``, one per
    value.  Only hashes are ordered; rows are picked by comparing with the
    ``n``-th, so no task sends more than its share of the sample.  Where
    values repeat among the smallest, distinct ones are ordered instead."""
    hashes = df.select(h.alias(name))
    last, rows, values = hashes.orderBy(name).limit(n).agg(
        F.max(name), F.count(name), F.countDistinct(name)).first()
    if rows == n > values:
        last = hashes.distinct().orderBy(name).limit(n).agg(F.max(name)).first()[0]
    found = df.withColumn(name, h)
    return found.where(F.lit(False) if last is None else F.col(name) <= last).dropDuplicates([name])


def held_out(id_col: Column) -> Column:
    """The fold kept away from learning: crc32 of the id's text mod 4 is 2.
    A null id is never held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


BATCH_ROWS = 1024


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with at most ``BATCH_ROWS`` of its rows sent to Python at once.

    Texts are long: Spark's 10,000 rows would be tens of MB on both sides of
    each pipe.  The session keeps the setting, as plans read it when they run.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


@contextmanager
def batch_rows(spark: SparkSession, rows: int = BATCH_ROWS):
    """Inside, writes send at most ``rows`` rows to Python at once; the session's
    own setting is back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Return freed memory of a Python worker to the system: workers stay for
    the next task, and several share an executor's memory."""
    import ctypes
    import sys

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def per_worker(key, make: Callable):
    """``make()`` once for each Python process: tables that tasks share.

    Functions arrive by value with every task, so a module variable would be
    built again each time.
    """
    import sys
    store = vars(sys).setdefault("_fundlake_tables", {})
    if key not in store:
        store[key] = make()
    return store[key]


def slices(batches, rows: int = 512, chars: int = 4_000_000):
    """Cut Arrow batches into pieces of bounded rows and text bytes, so that
    a task's memory does not follow the batch size or a run of long texts.
    Freed memory is given back when the task's rows end."""
    for batch in batches:
        start, size = 0, 0
        sizes = [0] * batch.num_rows
        for col in batch.columns:
            t = str(col.type)
            if t in ("string", "binary", "large_string", "large_binary"):
                import pyarrow.compute as pc
                for i, n in enumerate(pc.fill_null(pc.binary_length(col), 0).to_pylist()):
                    sizes[i] += n
        for i, n in enumerate(sizes):
            if i > start and (i - start >= rows or size + n > chars):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)
    give_back()


def matrix(column, dtype: str, width: int):
    """A binary column without nulls, whose values have equal lengths, as rows of numbers."""
    import numpy as np
    import pyarrow as pa
    if not len(column):
        return np.zeros((0, width), dtype)
    ends = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64)
    ends = ends[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(dtype).reshape(len(column), width)
