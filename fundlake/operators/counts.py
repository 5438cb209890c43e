"""Tagged count reports (UNION ALL of counts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_counts(df: DataFrame, metrics: dict[str, Column | None]) -> DataFrame:
    """Several (conditional) counts over ONE scan of ``df``.

    ``metrics`` maps a label to a predicate (``None`` = count every row).
    One global aggregate computes them all, then the single row is
    unpivoted to ``(metric, n)`` rows.
    """
    aggs = [(F.count(F.lit(1)) if p is None else F.count_if(p)).alias(f"_m{i}")
            for i, p in enumerate(metrics.values())]
    one = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(label).alias("metric"), F.col(f"_m{i}").alias("n"))
                      for i, label in enumerate(metrics)])
    return one.select(F.inline(pairs))


def count_report(parts, as_text: bool = True, label: str = "metric",
                 value: str = "value") -> DataFrame:
    """Union of per-table metric counts, in the given order.

    ``parts``: iterable of ``(df, {label: predicate_or_None})``.  Each table
    is scanned once however many metrics it contributes.
    """
    frames = []
    pos = 0
    for df, metrics in parts:
        m = metric_counts(df, metrics)
        labels = list(metrics)
        order = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("metric"))
        frames.append(m.select(F.col("metric").alias(label),
                               (F.col("n").cast("string") if as_text else F.col("n")).alias(value),
                               (order + pos).cast("int").alias("ordinal")))
        pos += len(labels)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
