"""CSV records with quoted line breaks, read by many tasks.

A line break inside quotes doesn't end a record, so a reader that starts in the
middle of a file can't tell what it sees.  The number of quotes before it can:
an odd number means inside quotes.  Files are read as lines, split by split, as
any text; the odd lines (with an odd number of quotes) of each split are counted;
running totals over a file's splits are carried to each split's lines.  A
line with an even number before it that is even itself is a record.  All other
lines belong to the record that the last unmatched odd line opened, and only
those are brought together.

Quotes must be balanced, as the writers of such extracts do it (a quote inside a
quoted field is doubled).  A file with an odd number of odd lines is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
FILE, BLOCK, POS, ODD = "_file", "_block", "_pos", "_odd"


def physical_lines(reader, path) -> DataFrame:
    """Lines with their file and the start of their split.  ``reader``:
    ``spark.read`` or ``spark.readStream``."""
    lines = reader.option("lineSep", "\n").text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def records(lines: DataFrame, header: bool = True) -> DataFrame:
    """(record, file): one row per CSV record of ``physical_lines``."""
    odd = (F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))) % 2
    # A task reads the lines of a split in order, so a running id gives their order.
    lines = lines.withColumns({ODD: odd.cast("long"), POS: F.monotonically_increasing_id()})

    # One row per split; a file's splits are its size over the split size.
    splits = lines.groupBy(FILE, BLOCK).agg(F.sum(ODD).alias("_n"))
    file = Window.partitionBy(FILE)
    before = file.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = splits.select(
        FILE, BLOCK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"),
        F.when(F.sum("_n").over(file) % 2 == 1, F.raise_error(F.concat(
            F.lit("unbalanced quotes in "), F.col(FILE)))).alias("_fault"))

    place = Window.partitionBy(FILE, BLOCK).orderBy(POS)
    seen = F.coalesce(F.sum(ODD).over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = lines.withColumns({"_seen": seen, "_first": (F.row_number().over(place) == 1) & (F.col(BLOCK) == 0)})
    # Both sides are dealt by (file, split); a split that one side lacks would be
    # lost lines, so it is an error.
    placed = local.join(carry, [FILE, BLOCK], "left").withColumn(
        "_before", F.coalesce(F.col("_fault").cast("long"), F.col("_carry"), F.raise_error(F.lit("a split was read differently")).cast("long"))
        + F.col("_seen"))
    alone = (F.col("_before") % 2 == 0) & (F.col(ODD) == 0)

    single = placed.where(alone).select(F.col("value").alias("record"), FILE, "_first")
    pieces = F.transform(F.sort_array(F.collect_list(F.struct(BLOCK, POS, "value"))), lambda x: x["value"])
    joined = (placed.where(~alone).groupBy(FILE, F.shiftright("_before", 1).alias("_record"))
              .agg(F.array_join(pieces, "\n").alias("record"), F.max("_first").alias("_first")))
    out = single.unionByName(joined.select("record", FILE, "_first"))
    if header:
        out = out.where(~F.col("_first"))
    # A carriage return before the break belongs to the line end; blank lines are no records.
    return out.select(F.regexp_replace("record", "\r$", "").alias("record"), FILE).where(F.trim("record") != "")


def parse(found: DataFrame, schema: T.StructType, corrupt: str | None = None, file_col: str | None = None) -> DataFrame:
    """Fields of each record, by the rules of the line reader, and on request its file."""
    fields = T.StructType([*schema.fields, *([T.StructField(corrupt, T.StringType())] if corrupt else [])])
    options = {"quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE", "multiLine": "true",
               "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    row = F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), options)
    return found.select(row.alias("_r"), FILE).select("_r.*", *([F.col(FILE).alias(file_col)] if file_col else []))


def read_records(spark: SparkSession, path, schema: T.StructType, header: bool = True, corrupt: str | None = None,
                 file_col: str | None = None) -> DataFrame:
    return parse(records(physical_lines(spark.read, path), header), schema, corrupt, file_col)
