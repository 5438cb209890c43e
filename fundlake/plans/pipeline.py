"""End-to-end assembly: landed RAW -> SILVER -> STAR (lazy or written)."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager
from zlib import crc32
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators.governance import Registry, standard_registry
from fundlake.plans.silver import build_silver
from fundlake.plans.star import build_star
from fundlake.sources import testdata

# The demo entitlement - the restricted role sees one
# institution.
RESTRICTED_ROLE = "INSTITUTION_USER"
ENTITLEMENTS = ((RESTRICTED_ROLE, "INST-002"),)
ENTITLEMENT_SCHEMA = "role_name string, institution_id string"


@dataclass
class Layers:
    raw: dict
    silver: dict
    star: dict

    def tables(self) -> dict:
        return dict(self.star)


def from_raw(spark: SparkSession, raw: dict, master_rows: int | None = None,
             dim_bounds: dict | None = None) -> Layers:
    silver = build_silver(raw, master_rows=master_rows)
    star = build_star(spark, silver, dim_bounds)
    return Layers(raw, silver, star)


def from_driver_tables(spark: SparkSession, sf_dir: str) -> Layers:
    """The funding pipeline over the driver's tables.  Institutions come
    from ``nation`` (a fixed 25 rows) and programs from the five market
    segments, so both dimensions have proven small bounds."""
    raw = testdata.raw_tables(spark, sf_dir)
    return from_raw(spark, raw, master_rows=testdata.N_INSTITUTIONS, dim_bounds=testdata.DIM_BOUNDS)


def entitlements(spark: SparkSession, rows=ENTITLEMENTS) -> DataFrame:
    return spark.createDataFrame(list(rows), ENTITLEMENT_SCHEMA)


def registry_for(spark: SparkSession, layers: Layers, ent: DataFrame | None = None,
                 dim_rows: int | None = None) -> Registry:
    return standard_registry(ent if ent is not None else entitlements(spark),
                             layers.star["dim_institution"], dim_rows=dim_rows)


# --------------------------------------------------------------------------
# Written layers: each layer is computed from the *written* layer below it,
# exactly like a create-or-replace-table-as-select ELT, and read back from
# the shared folder.  Reports then start from parquet scans (lineage cut,
# real file sizes for the planner, nothing recomputed per report).
# --------------------------------------------------------------------------

_WRITTEN: dict = {}
_WRITTEN_LOCK = threading.Lock()


FACTS = ("fact_applications", "fact_disbursements", "fact_enrollments")

# Ids are long and alike: zstd files take well under half of snappy's bytes and
# no more time to write.
CODEC = "zstd"
# A fact's task keeps a file open for each fiscal year it meets, up to this many;
# it sorts what is left by year if it meets more.
YEARS_AT_ONCE = 16


@contextmanager
def _open_files(spark: SparkSession, n: int):
    """Writes into folders keep up to ``n`` files of a task open instead of sorting
    its rows; the session's own setting holds again afterwards."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, n)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _write_read(spark: SparkSession, df: DataFrame, path: str,
                bucket: tuple | None = None, table: str | None = None,
                partition_by: str | None = None) -> DataFrame:
    if bucket and table:
        n, col = bucket
        # Hash-partition on the bucket column first: each task then holds
        # exactly one bucket and writes one file for it.
        (df.repartition(n, col).write.mode("overwrite").format("parquet").option("path", path)
           .option("compression", CODEC)
           .bucketBy(n, col).sortBy(col).saveAsTable(table))
        return spark.table(table)
    if partition_by:
        # Straight from the scan into the years' folders: no shuffle and no
        # sort, a file for each task and year it holds.
        df.write.mode("overwrite").option("compression", CODEC).partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    # Read back with the written schema (partition columns keep their type)
    # and the original column order.
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def assert_unique(*checks: tuple[DataFrame, str]) -> None:
    """Fail when a key repeats in any (small dimension, key) pair; all
    pairs are checked in one job."""
    parts = [df.where(F.col(key).isNotNull()).groupBy(key).count()
             .where(F.col("count") > 1)
             .select(F.lit(key).alias("key"), F.col(key).cast("string").alias("value"))
             for df, key in checks]
    dup = parts[0]
    for p in parts[1:]:
        dup = dup.unionByName(p)
    found = dup.limit(3).collect()
    if found:
        key = found[0]["key"]
        raise ValueError(f"{key} is not unique: {[r['value'] for r in found]} repeat; "
                         "fix the master extract before building facts")


class Written:
    """RAW, SILVER and STAR written under ``root`` (full refresh).

    ``landed``: the five landed RAW extracts (lazy frames, e.g. from
    ``read_landing``).  ``raw``/``silver``/``star`` are dicts of DataFrames
    that scan the written tables.  ``silver_stage()``/``star_stage()``
    rebuild one layer lazily from the written tables it depends on (what
    one ELT step computes), so a stage query measures exactly that step.

    ``master_rows`` / ``dim_bounds``: proven row bounds that allow
    broadcasting the institution master and the dimensions; unknown bounds
    leave the join strategy to the planner (which sees the written sizes).
    """

    def __init__(self, spark: SparkSession, landed: dict, root: str,
                 bucket_facts: int | bool | None = None, master_rows: int | None = None,
                 dim_bounds: dict | None = None):
        self.spark, self.root = spark, root
        self.bucket_facts = bucket_facts
        self.master_rows = master_rows
        self.bounds = dict(dim_bounds or {})
        self.raw, self.silver, self.star = {}, {}, {}
        silver_steps, star_steps = self._silver_steps(), self._star_steps()
        # Independent writes of one wave are submitted together (Spark runs
        # jobs from several threads concurrently); a wave starts when the
        # tables it reads are written.
        waves = [
            [("raw", n, (lambda df=df: df)) for n, df in landed.items()],
            [("silver", n, silver_steps[n]) for n in
             ("institutions", "enrollments", "funding_decisions")],
            [("silver", "applications", silver_steps["applications"])],
            [("silver", "disbursements", silver_steps["disbursements"])]
            + [("star", n, star_steps[n]) for n in
               ("dim_institution", "dim_program", "dim_funding_type", "dim_date")],
            [("star", n, star_steps[n]) for n in
             ("fact_applications", "fact_disbursements", "fact_enrollments")],
        ]
        for i, wave in enumerate(waves):
            if i == len(waves) - 1:
                # Facts look dimensions up by natural key: a repeated key
                # would multiply fact rows, so refuse to go on.  Programs are
                # unique by their groupBy; the master is not.
                assert_unique((self.star["dim_institution"], "institution_id"))
                if self.bucket_facts is True:
                    self.bucket_facts = bucket_count(spark, f"{root}/silver/disbursements")
                with _open_files(spark, YEARS_AT_ONCE):
                    self._run_wave(wave)
            else:
                self._run_wave(wave)

    def _run_wave(self, wave) -> None:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=len(wave)) as pool:
            futures = {(layer, name): pool.submit(lambda l=layer, n=name, m=make:
                                                  self._write(l, n, m()))
                       for layer, name, make in wave}
        for (layer, name), fut in futures.items():
            getattr(self, layer)[name] = fut.result()

    def _write(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        bucket = table = part = None
        if self.bucket_facts and name in ("fact_applications", "fact_disbursements"):
            tag = crc32(self.root.encode())
            bucket, table = (self.bucket_facts, "application_id"), f"fl{tag}_{name}"
        elif layer == "star" and name in FACTS:
            # One folder per fiscal year: a report filtered by year (through
            # the date dimension) prunes fact folders at run time (dynamic
            # partition pruning).  Tens of folders, not thousands.
            part = "date_key"
        return _write_read(self.spark, df, f"{self.root}/{layer}/{name}", bucket, table, part)

    def _silver_steps(self) -> dict:
        from fundlake.plans import silver as sv
        raw, done, m = self.raw, self.silver, self.master_rows
        return {
            "institutions": lambda: sv.silver_institutions(raw["institutions"]),
            "applications": lambda: sv.silver_applications(raw["applications"],
                                                           done["institutions"], m),
            "enrollments": lambda: sv.silver_enrollments(raw["enrollments"]),
            "funding_decisions": lambda: sv.silver_funding_decisions(raw["funding_decisions"]),
            "disbursements": lambda: sv.silver_disbursements(raw["disbursements"],
                                                             done["applications"]),
        }

    def _star_steps(self) -> dict:
        from fundlake.plans import star as st
        s, done, b = self.silver, self.star, self.bounds
        return {
            "dim_institution": lambda: st.dim_institution(s["institutions"], b.get("dim_institution")),
            "dim_program": lambda: st.dim_program(s["applications"], b.get("dim_program")),
            "dim_funding_type": lambda: st.dim_funding_type(self.spark),
            "dim_date": lambda: st.dim_date(s["applications"], b.get("dim_date")),
            "fact_applications": lambda: st.fact_applications(s["applications"], done, b),
            "fact_disbursements": lambda: st.fact_disbursements(s["disbursements"], done, b),
            "fact_enrollments": lambda: st.fact_enrollments(s["enrollments"], done, b),
        }

    def silver_stage(self, name: str) -> DataFrame:
        """One silver table recomputed from the written tables below it."""
        return self._silver_steps()[name]()

    def star_stage(self, name: str) -> DataFrame:
        return self._star_steps()[name]()

    def layers(self) -> Layers:
        return Layers(self.raw, self.silver, self.star)

    def register(self, spark: SparkSession | None = None, role: str | None = None,
                 registry: Registry | None = None) -> list[str]:
        """Expose the written layers to SQL users.

        Without ``role``: ``raw.*``, ``silver.*`` and ``star.*`` (external
        tables over the written files - no copy) and the three report views.
        With ``role``: governed objects only - temp views ``secured_<table>``
        of the star tables as the role sees them, and the report views built
        on those.  The open tables that an earlier call made are dropped from
        the catalog then (their files stay); a table of the same name that is
        not one of these is never dropped: the call fails instead.
        """
        from fundlake.plans import reports
        spark = spark or self.spark
        names = []
        for layer in ("raw", "silver", "star"):
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
            for name in getattr(self, layer):
                table = f"{layer}.{name}"
                drop_exposed(spark, table)
                if role is not None:
                    continue
                spark.sql(f"CREATE TABLE {table} USING parquet OPTIONS (path '{self.root}/{layer}/{name}') "
                          f"TBLPROPERTIES ('{EXPOSED}' = 'true')")
                if layer == "star" and name in FACTS and not self.bucket_facts:
                    spark.catalog.recoverPartitions(table)   # date_key folders
                names.append(table)
        tables = dict(self.star)
        if role is not None:
            reg = registry or registry_for(spark, self.layers())
            tables = reg.secured_tables(tables, role)
            for n, df in tables.items():
                df.createOrReplaceTempView(f"secured_{n}")
                names.append(f"secured_{n}")
        reports.register_views(spark, tables)
        return names + list(reports.views(tables))


def session_views(w: Written, ent: DataFrame | None = None, registry: Registry | None = None) -> list[str]:
    """Views ``session_<table>`` of the star, for every role of an SQL session
    (see ``governance.session_views``).  They read the written files by path, so
    no open table needs to be in the catalog."""
    from fundlake.operators.governance import session_views as make
    ent = ent if ent is not None else entitlements(w.spark)
    reg = registry or registry_for(w.spark, w.layers(), ent)
    return make(w.spark, reg, {n: (f"parquet.`{w.root}/star/{n}`", df.schema) for n, df in w.star.items()}, ent)


# Marks the external tables that ``register`` made.
EXPOSED = "fundlake.exposed"


def drop_exposed(spark: SparkSession, table: str) -> None:
    """Drop ``table`` from the catalog if ``register`` made it; refuse if it is
    someone else's."""
    if not spark.catalog.tableExists(table):
        return
    found = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if f"{EXPOSED}=true" not in found.get("Table Properties", "") or found.get("Type") != "EXTERNAL":
        raise ValueError(f"{table} exists and was not made by register(); rename one of the two")
    spark.sql(f"DROP TABLE {table}")


# Aim for about this much of the larger fact per bucket.
TARGET_BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(spark: SparkSession, path: str, target: int = TARGET_BUCKET_BYTES) -> int:
    """Buckets for a table of the size written at ``path``: one per
    ``target`` bytes, at least the cluster's default parallelism.  The size
    comes from a distributed listing (``binaryFile`` with the content column
    pruned, so no file is opened)."""
    total = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .load(path).agg(F.sum("length")).first()[0]) or 0
    return max(spark.sparkContext.defaultParallelism, -(-int(total) // target))


def written(spark: SparkSession, sf_dir: str, bucket_facts: int | None | bool = None) -> Written:
    """The written layers for ``sf_dir`` in this session (built on first use).

    ``bucket_facts=True`` buckets fact_applications and fact_disbursements on
    application_id, with the bucket count sized from the written silver
    disbursements (``bucket_count``): lag reports then join the two facts
    without shuffling either.  Off by default: one application may own a
    large share of all payments, and a bucket can neither be split by AQE
    nor written by more than one task.  Use it where the key is known to
    be spread; an int fixes the count.
    """
    from fundlake.session import shared_dir
    key = (spark.sparkContext.applicationId, sf_dir, bucket_facts)
    with _WRITTEN_LOCK:      # concurrent callers share one build
        w = _WRITTEN.get(key)
        if w is None:
            w = Written(spark, testdata.raw_tables(spark, sf_dir), shared_dir(spark, "layers"),
                        bucket_facts, master_rows=testdata.N_INSTITUTIONS, dim_bounds=testdata.DIM_BOUNDS)
            _WRITTEN[key] = w
    return w


def from_landing_folder(spark: SparkSession, landing: str, out: str | None = None,
                        bucket_facts: int | bool | None = None,
                        min_partitions: int | None = None) -> Written:
    """Run the whole ELT from a folder holding the five extracts, one
    sub-folder (or file glob) per extract named like its table
    (``institutions``, ``applications``, ...; plain or ``.gz`` CSV).
    Layers are written under ``out`` (default: a fresh folder in the shared
    checkpoint location), every run into a folder of its own; ``out/CURRENT``
    names the newest complete one, so a run that fails changes nothing."""
    from fundlake.session import shared_dir
    from fundlake.sources.landing import LANDING_SCHEMAS, read_landing
    landed = {name: read_landing(spark, f"{landing.rstrip('/')}/{name}*", schema,
                                 min_partitions=min_partitions)
              for name, schema in LANDING_SCHEMAS.items()}
    if out is None:
        return Written(spark, landed, shared_dir(spark, "layers"), bucket_facts)
    run = f"run-{uuid.uuid4().hex[:12]}"
    made = Written(spark, landed, f"{out.rstrip('/')}/{run}", bucket_facts)
    _switch(spark, out, run)
    return made


def _path(spark: SparkSession, *parts: str):
    p = spark._jvm.org.apache.hadoop.fs.Path("/".join(x.rstrip("/") for x in parts))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _switch(spark: SparkSession, out: str, run: str) -> None:
    """Let ``out/CURRENT`` name ``run``: written beside it, then renamed."""
    fs, new = _path(spark, out, f"CURRENT-{run}")
    stream = fs.create(new, True)
    stream.write(bytearray(run.encode()))
    stream.close()
    _, at = _path(spark, out, "CURRENT")
    # One rename that replaces: a reader finds the old run or the new one.
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(at), options)


def current_run(spark: SparkSession, out: str) -> str | None:
    """The folder of the newest complete run under ``out``."""
    fs, at = _path(spark, out, "CURRENT")
    if not fs.exists(at):
        return None
    return f"{out.rstrip('/')}/{spark.read.text(at.toString(), wholetext=True).first()[0].strip()}"


def forget_written() -> None:
    _WRITTEN.clear()
