"""Joins against master data and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when its row count is known to be at most
# this many rows (about a few MB for a narrow dimension).
BROADCAST_MAX_ROWS = 1_000_000
# Tasks that share one hot key when the parent's keys are not known unique.
ORPHAN_SALTS = 16


def bounded(dim: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast-hint ``dim`` when a caller-proven row bound fits the
    broadcast budget; otherwise leave the choice to the planner / AQE,
    which measure the real size at run time."""
    if max_rows is not None and max_rows <= BROADCAST_MAX_ROWS:
        return F.broadcast(dim)
    return dim


def conform(df: DataFrame, master: DataFrame, key: str, take: dict[str, str],
            master_rows: int | None = None) -> DataFrame:
    """LEFT join to a master on ``key`` and replace/add columns from it.

    ``take`` maps master column -> output name.  Rows whose key is unknown
    (or NULL) are kept with NULLs in the taken columns.
    """
    m = master.select(F.col(key).alias("_mkey"),
                      *[F.col(src).alias(f"_m_{dst}") for src, dst in take.items()])
    joined = df.join(bounded(m, master_rows), df[key] == F.col("_mkey"), "left")
    cols = []
    for c in df.columns:
        if c in take.values():
            cols.append(F.col(f"_m_{c}").alias(c))
        else:
            cols.append(df[c])
    for dst in take.values():
        if dst not in df.columns:
            cols.append(F.col(f"_m_{dst}").alias(dst))
    return joined.select(*cols)


def flag_orphans(child: DataFrame, parent: DataFrame, key: str, flag: str,
                 parent_key: str | None = None, parent_unique: bool = False,
                 salts: int = ORPHAN_SALTS) -> DataFrame:
    """Add ``flag`` = TRUE where the child's ``key`` has no parent row.

    Rows are never dropped and never multiplied.

    ``parent_unique=True`` (the parent has one row per key by construction,
    like the de-duplicated applications): the parent is joined as it is, so
    both sides of the join are plain shuffles and AQE splits a hot key's
    partition.  Otherwise the parent is reduced to its distinct keys first;
    that aggregate would keep AQE from splitting the join, so the child is
    salted over ``salts`` values and each distinct key is repeated once for
    each: a hot key meets its parent in ``salts`` tasks.

    Child rows with a NULL key can never match, but would all hash to the
    same shuffle partition; their join key is replaced by a per-row text
    (guarded so it can never match), which spreads them evenly.
    """
    pk = parent_key or key
    keys = parent.select(F.col(pk).alias("_pkey")).where(F.col("_pkey").isNotNull())
    own = F.xxhash64(*[F.col(c) for c in child.columns])
    c = child
    # The key is computed where the join needs it: no second text per row to shuffle.
    spread_key = F.coalesce(F.col(key), F.concat(F.lit("\u0000"), own.cast("string")))
    on = (spread_key == F.col("_pkey")) & F.col(key).isNotNull()
    if not parent_unique:
        c = c.withColumn("_csalt", F.pmod(own, F.lit(salts)).cast("int"))
        keys = keys.distinct().withColumn("_psalt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("_csalt") == F.col("_psalt"))
    joined = c.join(keys, on, "left")
    return joined.select(*[F.col(x) for x in child.columns],
                         F.col("_pkey").isNull().alias(flag))


def lookup_keys(fact: DataFrame, lookups) -> DataFrame:
    """Attach surrogate keys by LEFT joins to several dimensions.

    ``lookups``: iterable of ``(dim, fact_col, dim_col, key_col, max_rows)``.
    Unmatched (or NULL) natural keys give a NULL surrogate key; rows are
    kept.  Dimension natural keys must be unique (they are, by
    construction), so no lookup multiplies fact rows.
    """
    out = fact
    base_cols = list(fact.columns)
    added = []
    for i, (dim, fact_col, dim_col, key_col, max_rows) in enumerate(lookups):
        d = dim.select(F.col(dim_col).alias(f"_d{i}"), F.col(key_col).alias(key_col))
        out = out.join(bounded(d, max_rows), out[fact_col] == F.col(f"_d{i}"), "left")
        added.append(key_col)
    return out.select(*[F.col(c) for c in base_cols], *[F.col(k) for k in added])
