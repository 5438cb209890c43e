"""Ordering helpers with explicit NULL placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_key(col, descending: bool, nulls_last: bool) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if descending:
        return c.desc_nulls_last() if nulls_last else c.desc_nulls_first()
    return c.asc_nulls_last() if nulls_last else c.asc_nulls_first()


def ordered(df: DataFrame, cols, descending: bool = False, nulls_last: bool | None = None,
            tie_break=()) -> DataFrame:
    """ORDER BY with the warehouse NULL convention by default: NULLs last
    ascending, first descending."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    nl = (not descending) if nulls_last is None else nulls_last
    keys = [sort_key(c, descending, nl) for c in cols]
    keys += [sort_key(c, False, True) for c in tie_break]
    return df.orderBy(*keys)


def top_k(df: DataFrame, col, k: int, descending: bool = True, nulls_last: bool = True,
          tie_break=()) -> DataFrame:
    """The ``k`` first rows under an order: planned as
    TakeOrderedAndProject (each task keeps its own k best; k rows per task
    reach the final merge).  ``tie_break`` columns make the cut stable."""
    return ordered(df, col, descending, nulls_last, tie_break).limit(k)
