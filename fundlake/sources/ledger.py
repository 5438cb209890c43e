"""Bulk loads that take each file once, with an account of every file.

A load lists the landing files, takes those that the ledger does not hold (path,
size and modification time), writes their rows into a folder of its own and then
commits one ledger entry that names the folder and its files, with the rows
loaded, ragged and rejected of each.  ``rows`` and ``rejects`` read only folders that
the ledger names, so a load that fails, or runs twice, adds nothing.

Entries are numbered and put in place by one rename that fails if the number is
taken: of two loads at once one commits, the other starts anew from the new
ledger.  A changed file (other size or time) counts as a new one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.sources.landing import CORRUPT_COL, read_landing

ENTRY = T.StructType([T.StructField(c, t) for c, t in (
    ("path", T.StringType()), ("size", T.LongType()), ("modified", T.TimestampType()), ("loaded", T.LongType()),
    ("ragged", T.LongType()), ("rejected", T.LongType()), ("load", T.StringType()))])
FILE = "_landed_from"
ATTEMPTS = 5


@dataclass(frozen=True)
class Loaded:
    """What one load did.  The counts were observed while the rows were written."""

    load: str
    files: int
    loaded: int
    ragged: int
    rejected: int


class Ledger:
    """``root`` holds ``entries`` (the ledger) and ``data`` (a folder per load).

    ``key``: the column whose absence makes a row a reject.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _numbers(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/entries")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.split("-")[1]) for n in names if n.startswith("entry-"))

    def entries(self) -> DataFrame:
        """(path, size, modified, loaded, ragged, rejected, load): every file taken."""
        if not self._numbers():
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(f"{self.root}/entries/entry-*")

    def load(self, source, header: bool = True, multi_line: bool = False, glob: str | None = None) -> Loaded | None:
        """Take the files at ``source`` that were not taken yet; None if there are none."""
        for _ in range(ATTEMPTS):
            number = (self._numbers() or [-1])[-1] + 1
            done = self._load(source, header, multi_line, glob, number)
            if done != "taken":
                return done
        raise RuntimeError(f"{ATTEMPTS} other loads came first at {self.root}")

    def _load(self, source, header, multi_line, glob, number):
        reader = self.spark.read.format("binaryFile")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        listed = reader.load(source).select(              # listing only: no file is opened
            F.col("path").alias("_open"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"))
        known = self.entries().select("path", "size", "modified")
        new = listed.join(known, ["path", "size", "modified"], "left_anti").collect()     # file names, as Spark's own listing holds
        if not new:
            return None
        landed = read_landing(self.spark, [r._open for r in new], self.schema, keep_raw_line=True, header=header,
                              multi_line=multi_line, file_col=FILE)
        rows = landed.withColumns({"ragged": F.col(CORRUPT_COL).isNotNull(), "rejected": F.col(self.key).isNull()}).drop(CORRUPT_COL)
        name, seen = f"{number:08d}-{uuid.uuid4().hex[:12]}", Observation()
        counts = {"loaded": F.count_if(~F.col("rejected")), "ragged": F.count_if("ragged"), "rejected": F.count_if("rejected")}
        rows.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.partitionBy("rejected").parquet(f"{self.root}/data/load={name}")
        per_file = (self._data().where(F.col("load") == name).groupBy(F.col(FILE).alias("path"))
                    .agg(*[c.alias(n) for n, c in counts.items()]))
        files = self.spark.createDataFrame([(r.path, r.size, r.modified) for r in new], T.StructType(ENTRY.fields[:3]))
        entry = files.join(per_file, "path", "left").select(
            "path", "size", "modified", *[F.coalesce(n, F.lit(0)).alias(n) for n in counts], F.lit(name).alias("load"))
        told = {n: int(v) for n, v in seen.get.items()}
        fs, aside = self._fs(f"{self.root}/entries/_{name}")
        entry.coalesce(1).write.parquet(aside.toString())
        sums = self.spark.read.schema(ENTRY).parquet(aside.toString()).agg(*[F.sum(n) for n in counts]).first()
        if tuple(sums) != tuple(told[n] for n in counts):
            raise RuntimeError(f"load {name}: counted {told} while writing, found {tuple(sums)} in the files")
        if not self._commit(aside, f"{self.root}/entries/entry-{number:08d}"):
            fs.delete(aside, True)
            fs.delete(self._fs(f"{self.root}/data/load={name}")[1], True)
            return "taken"
        return Loaded(name, len(new), **told)

    def _commit(self, aside, to: str) -> bool:
        """One rename; False if another load has the number."""
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        fs, at = self._fs(to)
        if fs.exists(at):
            return False
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(at), options)
        except Exception as e:  # noqa: BLE001
            if fs.exists(at):
                return False
            raise e
        return True

    def _data(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(FILE, T.StringType()), T.StructField("ragged", T.BooleanType()),
                               T.StructField("load", T.StringType()), T.StructField("rejected", T.BooleanType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/data")

    def _committed(self) -> DataFrame:
        if not self._numbers():
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("ragged", T.BooleanType()),
                                                                T.StructField("rejected", T.BooleanType())]))
        return self._data().join(self.entries().select("load").distinct(), "load", "left_semi").drop("load", FILE)

    def rows(self) -> DataFrame:
        """All rows loaded, with their ``ragged`` flag."""
        return self._committed().where("NOT rejected").drop("rejected")

    def rejects(self) -> DataFrame:
        return self._committed().where("rejected").drop("rejected")
