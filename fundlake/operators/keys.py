"""Dense surrogate keys 1..n in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators.slices import PLACE, SLICE, carried, sliced


def surrogate_key(df: DataFrame, order, name: str, ranged_partitions: int | None = None
                  ) -> DataFrame:
    """Prepend ``name`` = row_number() over ``order`` (ascending, NULLs last).

    Default: one global window.  That is a single-task exchange, the right
    plan for a dimension (a few rows per institution, program or year).

    ``ranged_partitions=n``: the scalable form for large or unknown inputs.
    Rows are range-partitioned on the key into ``n`` ordered slices and
    written once, each with its slice and its place in it, into the shared
    folder; sizes and keys are then both taken from that one copy, so the
    numbering cannot depend on how a range exchange sampled its bounds.  No
    task holds more than one slice, and only the ``n`` slice sizes meet.
    Rows that tie in ``order`` get neighbouring keys in any order.
    """
    order = [order] if isinstance(order, str) else list(order)
    spec = [F.col(c).asc_nulls_last() for c in order]
    if not ranged_partitions:
        w = Window.orderBy(*spec)
        return df.select(F.row_number().over(w).cast("bigint").alias(name), *df.columns)

    parts = sliced(df, spec, ranged_partitions, "surrogate-key")
    sizes = parts.rows.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_n"))
    offsets = carried(sizes, "_n", "_offset").drop("_n")
    out = parts.rows.join(F.broadcast(offsets), SLICE)  # n rows: bounded by n
    return out.select((F.col("_offset") + F.col(PLACE)).cast("bigint").alias(name), *df.columns)
