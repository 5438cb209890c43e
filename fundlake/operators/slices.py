"""Ordered slices of a table: the base of prefix sums and row numbers.

A global order does not need one task.  Rows are range-partitioned into ``n``
ordered slices and written once; everything that depends on the order then takes
two small steps: a figure per slice, and a running total over the slices that is
carried to each slice's rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.session import shared_dir

SLICE, PLACE = "_slice", "_place"


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns (maps, which can't be hashed, as text)."""
    return F.xxhash64(*[F.to_json(f.name) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
                        for f in df.schema.fields])


@dataclass
class Slices:
    """``rows``: the written copy, with each row's slice and place in it (from 1)."""

    rows: DataFrame
    n: int


def sliced(df: DataFrame, order: list[Column], n: int | None = None, purpose: str = "slices") -> Slices:
    """``df`` written in ``n`` slices (default: the session's shuffle
    partitions) by ``order``.

    Bounds are taken over the order and then a hash of the row, so rows that tie
    in the order spread over several slices; only rows equal in every column
    stay together.  Each slice is a folder of its own: a later read of some
    slices opens no others.  All figures must come from this copy, as a range
    exchange samples its bounds anew each time it runs.
    """
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, purpose)
    spec = [*order, row_hash(df)]
    # monotonically_increasing_id counts a partition's rows in order in its
    # low 33 bits, so the place in the slice needs no second shuffle.
    (df.repartitionByRange(n, *spec).sortWithinPartitions(*spec)
       .select("*", F.spark_partition_id().alias(SLICE),
               (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(PLACE))
       .write.partitionBy(SLICE).parquet(path))
    schema = T.StructType([*df.schema.fields, T.StructField(PLACE, T.LongType()), T.StructField(SLICE, T.IntegerType())])
    return Slices(spark.read.schema(schema).parquet(path), n)


def carried(totals: DataFrame, value: str, name: str, within: list[str] = ()) -> DataFrame:
    """``totals`` (a row per slice, of each ``within``) with ``name``: the sum of
    ``value`` over all earlier slices, 0 for the first."""
    before = Window.partitionBy(*within).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0).cast(totals.schema[value].dataType)))
