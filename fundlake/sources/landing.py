"""Tolerant landing of CSV extracts into all-text RAW tables.

The extracts arrive with a header row, optional double-quoting (money such
as "$1,250,000" contains commas), stray blanks, several spellings of "no
value" and the odd ragged line.  Everything lands as text; typing happens
in the silver layer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.functions.text import NULL_TOKENS, null_if_tokens
from fundlake.sources.records import read_records

CORRUPT_COL = "_raw_line"


def _text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# The five landing layouts, columns in file order.
LANDING_SCHEMAS: dict[str, T.StructType] = {
    "institutions": _text_schema(
        "institution_id", "institution_name", "institution_type", "region",
        "size_category"),
    "applications": _text_schema(
        "application_id", "institution_id", "institution_name", "program_code",
        "program_name", "funding_type_code", "fiscal_year", "amount_requested",
        "submission_date", "status"),
    "enrollments": _text_schema(
        "enrollment_id", "institution_id", "program_code", "fiscal_year",
        "headcount"),
    "funding_decisions": _text_schema(
        "decision_id", "application_id", "institution_id", "funding_type_code",
        "fiscal_year", "approved_amount", "decision_date", "decision"),
    "disbursements": _text_schema(
        "disbursement_id", "application_id", "institution_id", "fiscal_year",
        "disbursed_amount", "disbursement_date"),
}

# The column whose absence makes a landed row unusable (the natural id).
LANDING_KEYS = {
    "institutions": "institution_id",
    "applications": "application_id",
    "enrollments": "enrollment_id",
    "funding_decisions": "decision_id",
    "disbursements": "disbursement_id",
}


def null_tokens(df: DataFrame, cols=None, tokens=NULL_TOKENS) -> DataFrame:
    """Turn every token in ``tokens`` into NULL in the given text columns
    (all string columns by default).  The CSV reader's ``nullValue`` takes a
    single token, so this is applied as one projection after the scan."""
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, T.StringType) and f.name != CORRUPT_COL]
    wanted = set(cols)
    return df.select(*[null_if_tokens(c, tokens).alias(c) if c in wanted else F.col(c)
                       for c in df.columns])


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Re-spread a scan that yields fewer splits than the cluster has cores
    (one unsplittable row group or gzip file would otherwise put all the
    work that follows on one task).  The split count is known at planning
    time, so wide inputs pass through untouched - no extra shuffle."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    return df.repartition(want) if have < want else df


def read_landing(spark: SparkSession, path, schema: T.StructType,
                 keep_raw_line: bool = False, min_partitions: int | None = None,
                 header: bool = True, multi_line: bool = False, file_col: str | None = None) -> DataFrame:
    """Scan CSV file(s) at ``path`` (gzip chosen by suffix) with ``schema``.

    * header line skipped, ``"`` quoting with doubled-quote escapes;
    * leading/trailing blanks trimmed;
    * ragged lines kept (PERMISSIVE): short lines get a NULL tail, extra
      fields are dropped; the original line is kept in ``_raw_line`` when
      ``keep_raw_line`` so rejects can be accounted for;
    * null tokens applied to every column.

    ``multi_line``: quoted fields may hold line breaks.  A plain file is still
    read by many tasks: the parity of the quotes before each split tells where
    its records begin (``sources.records``); quotes must be balanced.

    ``file_col``: a column with the file each row came from.

    Gzip files are not splittable: one task per file.  ``min_partitions``
    re-spreads such input before the (wide) cleansing work when the scan
    has fewer splits than that (decided at planning time).
    """
    fields = list(schema.fields)
    if keep_raw_line:
        fields.append(T.StructField(CORRUPT_COL, T.StringType(), True))
    if multi_line:
        df = read_records(spark, path, schema, header, CORRUPT_COL if keep_raw_line else None, file_col)
        if min_partitions:
            df = spread(df, min_partitions)
        return null_tokens(df, [f.name for f in schema.fields])
    reader = (spark.read.schema(T.StructType(fields))
              .option("header", header)
              .option("quote", '"')
              .option("escape", '"')
              .option("ignoreLeadingWhiteSpace", True)
              .option("ignoreTrailingWhiteSpace", True)
              .option("mode", "PERMISSIVE")
              .option("enforceSchema", True))
    if keep_raw_line:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    df = reader.csv(path)
    if file_col:
        df = df.select("*", F.col("_metadata.file_path").alias(file_col))
    if min_partitions:
        df = spread(df, min_partitions)
    return null_tokens(df, [f.name for f in schema.fields])


def split_rejects(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Continue-on-error accounting: rows without their key are rejects;
    everything else (ragged rows included) is loaded.  Both outputs are
    lazy projections of one scan, so no row is lost between them."""
    bad: Column = F.col(key).isNull()
    return df.filter(~bad), df.filter(bad)


def with_ragged_flag(df: DataFrame, name: str = "ragged") -> DataFrame:
    """Flag rows whose line did not have the expected field count and drop
    the raw-line column."""
    return df.withColumn(name, F.col(CORRUPT_COL).isNotNull()).drop(CORRUPT_COL)


def list_files(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """One row per staged file (name, size, modification time).  The
    ``binaryFile`` source lists files in a distributed way and, with the
    content column pruned, never opens them."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    return df.select(F.element_at(F.split(F.col("path"), "/"), -1).alias("file_name"),
                     F.col("length").alias("file_size"),
                     F.col("modificationTime").alias("last_modified"))


def write_landing_csv(df: DataFrame, path: str, compression: str = "gzip",
                      files: int | None = None) -> str:
    """Write a text frame as header-ed, quoted CSV (one extract)."""
    out = df.coalesce(files) if files else df
    (out.write.mode("overwrite")
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("compression", compression)
        .csv(path))
    return path


def create_layers(spark: SparkSession, layers=("raw", "silver", "star")) -> None:
    """Create the layer namespaces (idempotent)."""
    for layer in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def load(df: DataFrame, table: str, partition_by=None, path: str | None = None) -> None:
    """Bulk load: append rows into a table (created on first load, at ``path``
    as an external table when one is given)."""
    w = df.write.mode("append")
    if path:
        w = w.format("parquet").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def refresh(df: DataFrame, table: str, root: str) -> str:
    """Replace a table's rows without a gap: write aside, then move the table's
    location in one catalog call.

    A reader sees the old rows or the new ones, never none and never a mixture; one
    that began before goes on with the old files, which stay until they are
    deleted by hand.  Returns the new location.  The table is created on the
    first call; its columns can't change afterwards.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex[:12]}"
    if spark.catalog.tableExists(table):
        have, found = df.schema.simpleString(), spark.table(table).schema.simpleString()
        if have != found:
            raise ValueError(f"{table} has {found}, not {have}")
        df.write.parquet(path)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        df.write.parquet(path)
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    return path


def save(df: DataFrame, table: str, partition_by=None, bucket_by=None) -> None:
    """Create-or-replace a table from a query (full refresh).

    ``bucket_by=(n, col)`` pre-partitions a big fact on its join key so
    later fact-to-fact joins on that key avoid re-shuffling it.
    """
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, col = bucket_by
        w = w.bucketBy(n, col).sortBy(col)
    w.saveAsTable(table)


def insert_rows(spark: SparkSession, table: str, rows, schema) -> None:
    """Append literal rows to a table (entitlements and the like)."""
    spark.createDataFrame(rows, schema).write.insertInto(table)


def count_rows_by_table(named: dict[str, DataFrame], label: str = "tbl",
                        value: str = "row_count") -> DataFrame:
    """Tagged row counts, one global aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias(value)).select(F.lit(name).alias(label), value)
             for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
