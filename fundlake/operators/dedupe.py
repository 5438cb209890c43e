"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _asc_last(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def dedupe_first(df: DataFrame, keys, order, tie_break: bool = True) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``order`` items are column names (ascending, NULLs last) or sort
    Columns.  Ties are broken on every remaining column so the survivor is
    deterministic.  NULL keys form one group, like ``PARTITION BY``.

    Plan: ``row_number() = 1`` becomes a WindowGroupLimit that already keeps
    only the best row per key *before* the shuffle (partial), so a hot key
    sends at most one row per input partition across the network.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    spec = [_asc_last(o) if isinstance(o, str) else o for o in order]
    if tie_break:
        named = {o for o in order if isinstance(o, str)}
        spec += [_asc_last(c) for c in df.columns if c not in keys and c not in named]
    w = Window.partitionBy(*keys).orderBy(*spec)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))
