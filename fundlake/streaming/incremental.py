"""Incremental landing: pick up new extract files exactly once.

A file-source stream over the landing folder with the landing schema, the
same trimming/null-token rules as the batch reader, and an
``availableNow`` trigger: each run lands every file that arrived since the
previous run and stops.  The checkpoint (in the shared folder) records
which files were taken, so re-running never loads a file twice and a lost
executor only replays its own micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fundlake.sources.landing import CORRUPT_COL, null_tokens, split_rejects, with_ragged_flag
from fundlake.sources.records import parse, physical_lines, records


def landing_stream(spark: SparkSession, folder: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None, keep_raw_line: bool = False,
                   header: bool = True) -> DataFrame:
    """The batch reader's rules on a file stream, ragged lines included."""
    fields = list(schema.fields)
    if keep_raw_line:
        fields.append(T.StructField(CORRUPT_COL, T.StringType(), True))
    reader = (spark.readStream.schema(T.StructType(fields))
              .option("header", header).option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", True)
              .option("ignoreTrailingWhiteSpace", True)
              .option("mode", "PERMISSIVE"))
    if keep_raw_line:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return null_tokens(reader.csv(folder), [f.name for f in schema.fields])


def land_new_files(spark: SparkSession, folder: str, schema: T.StructType, table_path: str,
                   checkpoint: str, key: str | None = None, rejects_path: str | None = None,
                   header: bool = True, max_files_per_trigger: int | None = None,
                   multi_line: bool = False) -> int:
    """Land every not-yet-landed file in ``folder`` in the parquet table at
    ``table_path``; returns the number of micro-batches run.

    With ``key``: rows without it are rejects and go to ``rejects_path``, and
    both tables carry a ``ragged`` flag, as in the batch reader.  With
    ``multi_line``: quoted fields may hold line breaks, and files are still read
    by many tasks.  In both cases each micro-batch writes the folder
    ``batch=<id>`` of a table, in overwrite mode, so a replayed batch replaces
    itself.
    """
    raw_line = key is not None

    def land(batch: DataFrame, batch_id: int) -> None:
        if multi_line:
            fields = parse(records(batch, header), schema, CORRUPT_COL if raw_line else None)
            batch = null_tokens(fields, [f.name for f in schema.fields])
        parts = [(batch, table_path)] if key is None else [
            (with_ragged_flag(part), path) for part, path in zip(split_rejects(batch, key), (table_path, rejects_path))]
        for part, path in parts:
            if path is not None:
                part.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    if multi_line:
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        stream = physical_lines(reader, folder)
    else:
        stream = landing_stream(spark, folder, schema, max_files_per_trigger, keep_raw_line=raw_line, header=header)
    if key is None and not multi_line:
        writer = stream.writeStream.format("parquet").option("path", table_path).outputMode("append")
    else:
        writer = stream.writeStream.foreachBatch(land)
    before = _batches(spark, checkpoint)
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return _batches(spark, checkpoint) - before


def _batches(spark: SparkSession, checkpoint: str) -> int:
    """Committed micro-batches of a checkpoint, all of them: batch ids count
    from 0, and the commit log keeps the newest."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return 0
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return 1 + max([int(n) for n in names if n.isdigit()], default=-1)
