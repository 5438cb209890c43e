"""Embedding near-duplicates through a pivot-permutation index.

Equal vectors of a label are folded to one node first, so a large group of copies
is one entry of each list; its copies' links follow from its size.

Pivots are vectors drawn from a bounded sample, for each vector length apart.  Every
vector is described by its ``nearest`` closest pivots, in order.  An inverted list
is kept for each (label, pivot): it holds the vectors that have the pivot among
their ``nearest``.  Two vectors are candidates when they meet in a list and share
at least ``shared`` pivots, or all where there are fewer; candidates are verified
by cosine in double precision.  All vectors of a label that have a length without
pivots (rare ones, as the sample has none of them) form one list.

A pair may meet in several lists; it is counted only in the list of the
smallest pivot that both vectors hold, which either side can tell by itself.
Lists are walked in blocks: a list over ``block`` vectors is dealt into blocks
by hash and compared block by block, so no task holds more than two blocks and
no pair becomes a row.  Each walk returns the number of links of each vector
and a spanning forest of the links.

The number of pivots follows the square root of the number of vectors, from
``min_pivots`` to ``max_pivots`` (a bound on what is broadcast:
``max_pivots`` vectors).  Pivots closer than ``MAX_PIVOT_COSINE`` are thinned
out, so vectors that share a direction may leave few.  With up to
2 x ``nearest`` - ``shared`` pivots every two vectors of a label are
candidates: no link is missed, but the work grows with the square of a label.

Defined cases: a vector that is null, empty, zero, or that holds a null, NaN or
infinite component links with nothing; so does a null label.  Vectors link only
with vectors of their length.  Repeated rows (equal vectors) link with each
other.  A null id is linked and counted but names no component.  An empty table
gives no rows.  Only the id, vector and label columns are read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import hashed_sample, matrix, table, written
from fundlake.llm.graph import components
from fundlake.llm.simhash import runs_of

MIN_COSINE = 0.93
NEAREST = 6
SHARED = 2
MAX_PIVOT_COSINE = 0.7
MIN_PIVOTS = 64
MAX_PIVOTS = 4096
BLOCK = 4096


def unit_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors as float64, which rows are usable) of rows of numbers."""
    x = x.astype(np.float64)
    top = np.abs(x).max(axis=1, initial=0)
    ok = np.isfinite(top) & (top > 0)
    x[~ok] = 0
    x[ok] /= top[ok, None]
    x[ok] /= np.sqrt(np.einsum("ij,ij->i", x[ok], x[ok]))[:, None]
    return x, ok


def fit_pivots(vectors: DataFrame, vec_col: str, n_rows: int, min_pivots: int = MIN_PIVOTS,
               max_pivots: int = MAX_PIVOTS) -> np.ndarray:
    """The pivots of the commonest length (see ``pivots_by_length``)."""
    found = pivots_by_length(vectors, vec_col, n_rows, min_pivots, max_pivots)
    return max(found.values(), key=len, default=np.zeros((0, 1)))


def pivots_by_length(vectors: DataFrame, vec_col: str, n_rows: int, min_pivots: int = MIN_PIVOTS,
                     max_pivots: int = MAX_PIVOTS) -> dict[int, np.ndarray]:
    """Length -> unit pivots: the usable sampled vectors with the smallest hashes,
    no two equal, at most ``max_pivots`` rows on the driver."""
    n = min(max_pivots, max(min_pivots, int(4 * math.sqrt(max(n_rows, 1)))))
    known = vectors.select(F.col(vec_col).alias("v")).where(
        F.forall("v", lambda c: F.abs(c.cast("double")) < float("inf")) & F.exists("v", lambda c: c != 0))
    rows = hashed_sample(known, F.xxhash64("v", F.lit(7)), n).orderBy("h").collect()
    out = {}
    for dim in sorted({len(r.v) for r in rows}):
        unit, ok = unit_rows(np.array([r.v for r in rows if len(r.v) == dim], np.float64))
        out[dim] = spread_out(np.unique(unit[ok], axis=0))
    return out


def spread_out(unit: np.ndarray, max_cosine: float = MAX_PIVOT_COSINE) -> np.ndarray:
    """Pivots with no two closer than ``max_cosine``: among near copies of one
    vector the order of nearest pivots would be chance."""
    kept: list[int] = []
    free = np.ones(len(unit), bool)
    for i in range(len(unit)):
        if free[i]:
            kept.append(i)
            free &= unit @ unit[i] < max_cosine
    return unit[kept]


def stored_as(vectors: DataFrame, vec_col: str) -> str:
    """The numpy type that holds the column's components exactly."""
    return "<f4" if vectors.schema[vec_col].dataType.elementType.typeName() == "float" else "<f8"


def permutations(vectors: DataFrame, pivots: dict[int, np.ndarray], id_col: str, vec_col: str, label_col: str,
                 nearest: int = NEAREST) -> DataFrame:
    """(row, id, label, x, near): a key for the row, the vector's bytes as it
    was given and the numbers of its nearest pivots; both null where the row can't
    link.  Pivots of all lengths are numbered in one row; a length without any
    has the negative length as its only one."""
    kind = vectors.schema[id_col].dataType.simpleString()
    label = vectors.schema[label_col].dataType.simpleString()
    dtype = stored_as(vectors, vec_col)
    base, n = {}, 0
    for dim, rows in pivots.items():
        base[dim], n = n, n + len(rows)

    def described(unit: np.ndarray, dim: int) -> np.ndarray:
        own = pivots.get(dim, ())
        k = min(nearest, len(own))
        if not k:
            return np.full((len(unit), 1), -dim, np.int32)
        near = np.zeros((len(unit), k), np.int32)
        for a in range(0, len(unit), 2048):
            d = unit[a:a + 2048] @ own.T
            top = np.argpartition(-d, k - 1, axis=1)[:, :k]
            order = np.argsort(-np.take_along_axis(d, top, 1), axis=1, kind="stable")
            near[a:a + 2048] = np.take_along_axis(top, order, 1)
        return near + base[dim]

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            sizes = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
            flat = b.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)     # null: NaN
            starts = np.cumsum(sizes) - sizes
            labelled = b.column(2).is_valid().to_numpy(zero_copy_only=False)
            left = np.ones(b.num_rows, bool)
            for dim in np.unique(sizes[(sizes > 0) & labelled]).tolist():
                at = np.flatnonzero((sizes == dim) & labelled)
                x = flat[starts[at, None] + np.arange(dim)]
                unit, ok = unit_rows(x)
                at, near = at[ok], described(unit[ok], dim)
                left[at] = False
                raw = x[ok].astype(dtype)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(at)), b.column(2).take(pa.array(at)),
                    pa.array([v.tobytes() for v in raw], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * near.shape[1]),
                                             pa.array(near.reshape(-1)))], ["id", "label", "x", "near"])
            at = np.flatnonzero(left)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(at)), b.column(2).take(pa.array(at)), pa.nulls(len(at), pa.binary()),
                pa.nulls(len(at), pa.list_(pa.int32()))], ["id", "label", "x", "near"])

    found = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"), F.col(label_col).alias("label")) \
        .mapInArrow(run, f"id {kind}, label {label}, x binary, near array<int>")
    return found.select(F.monotonically_increasing_id().alias("row"), "*")


def folded(index: DataFrame) -> DataFrame:
    """(row, label, x, near, weight): one node for all equal vectors of a label;
    ``row`` is the smallest of its rows, ``weight`` their number."""
    return index.where("x is not null").groupBy("label", "x").agg(
        F.min("row").alias("row"), F.first("near").alias("near"), F.count(F.lit(1)).alias("weight"))


def walk(x: np.ndarray, near: np.ndarray, pivot: int, side: np.ndarray | None, min_cosine: float,
         shared: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Link counts (by ``weight``) of the rows of one list and a spanning forest.

    ``side``: with two blocks, only pairs across them are counted (a block's
    own pairs are counted where it is compared with itself).
    """
    n = len(x)
    known, near = np.unique(near, return_inverse=True)          # only the pivots met here
    near, pivot = near.reshape(n, -1), int(np.searchsorted(known, pivot))
    held, shared = len(known), min(shared, near.shape[1])
    links = np.zeros(n, np.int64)
    left, right = [], []
    parent = np.arange(n)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    member = np.zeros((n, held), np.float32)
    np.put_along_axis(member, near, 1.0, axis=1)
    before = member[:, :pivot]
    for a in range(0, n, 512):
        z = min(n, a + 512)
        own = member[a:z] @ member[a:].T
        cand = own >= shared
        if pivot:
            cand &= (before[a:z] @ before[a:].T) == 0
        cand &= np.arange(a, n)[None, :] > np.arange(a, z)[:, None]
        if side is not None:
            cand &= side[a:z, None] != side[None, a:]
        i, j = np.nonzero(cand)
        for c in range(0, len(i), 1 << 16):
            p, q = i[c:c + (1 << 16)] + a, j[c:c + (1 << 16)] + a
            hit = np.einsum("ij,ij->i", x[p], x[q]) >= min_cosine
            p, q = p[hit], q[hit]
            np.add.at(links, p, weight[q])
            np.add.at(links, q, weight[p])
            for u, v in zip(p.tolist(), q.tolist()):
                ru, rv = root(u), root(v)
                if ru != rv:
                    parent[ru] = rv
                    left.append(u)
                    right.append(v)
    return links, np.array(left, np.int64), np.array(right, np.int64)


def whole(column):
    """A table's column as one array."""
    import pyarrow as pa
    one = column.combine_chunks()
    return one.chunk(0) if isinstance(one, pa.ChunkedArray) else one


def compare(index: DataFrame, dtype: str, min_cosine: float = MIN_COSINE, shared: int = SHARED,
            block: int = BLOCK) -> DataFrame:
    """(row, n, other): link counts (other is null) and spanning links (n is 0).

    ``index``: the written nodes of ``folded``.  Only the lists over
    ``block`` vectors are joined back (they are few, and written, so the
    planner knows their size); every vector travels once for each of its lists.
    """
    lists = index.where("x is not null").select("label", F.explode("near").alias("pivot"))
    large = written(lists.groupBy("label", "pivot").agg(F.count("*").alias("size")).where(F.col("size") > block),
                    "pivot-large-lists")
    keyed = index.where("x is not null").select("row", "label", "x", "near", "weight", F.explode("near").alias("pivot"))
    dealt = keyed.join(large, ["label", "pivot"], "left").withColumn(
        "parts", F.coalesce(F.ceil(F.col("size") / block).cast("int"), F.lit(1)))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "label", "pivot", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
        "mine", "row", "x", "near", "weight")

    def run(batches):
        import pyarrow as pa
        for group in runs_of(batches, ["label", "pivot", "a", "b"]):
            group = group.combine_chunks()
            rows = group.column("row").to_numpy()
            raw, lists = whole(group.column("x")), whole(group.column("near"))
            width = len(raw[0].as_py()) // np.dtype(dtype).itemsize         # lists hold one length
            x, _ = unit_rows(matrix(raw, dtype, width))
            near = lists.flatten().to_numpy().reshape(len(rows), -1).astype(np.int64)
            weight = group.column("weight").to_numpy()
            a, b = group.column("a")[0].as_py(), group.column("b")[0].as_py()
            side = None if a == b else group.column("mine").to_numpy()
            n, u, v = walk(x, near, group.column("pivot")[0].as_py(), side, min_cosine, shared, weight)
            own = np.flatnonzero(n)
            if len(own):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([rows[own], rows[u]])),
                    pa.array(np.concatenate([n[own], np.zeros(len(u), np.int64)])),
                    pa.array([None] * len(own) + rows[v].tolist(), pa.int64())], ["row", "n", "other"])

    by = ["label", "pivot", "a", "b"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "row long, n long, other long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", min_cosine: float = MIN_COSINE, nearest: int = NEAREST,
                    shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept): one row per input row."""
    pivots = pivots_by_length(vectors, vec_col, vectors.count())
    index = written(permutations(vectors, pivots, id_col, vec_col, label_col, nearest), "pivot-index")
    nodes = written(folded(index), "pivot-nodes")
    found = written(compare(nodes, stored_as(vectors, vec_col), min_cosine, shared, block), "pivot-links")
    counts = found.where("other is null").groupBy("row").agg(F.sum("n").alias("n"))
    roots = components(found.where("other is not null").select(F.col("row").alias("u"), F.col("other").alias("v")))
    # One row per node, written: joins on a large group of copies or a large
    # component's root can then be split.
    told = written(nodes.join(counts, "row", "left").join(roots, F.col("row") == F.col("node"), "left").select(
        "label", "x", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "row").alias("root")), "pivot-told")
    named = written(index.where("x is not null").join(told, ["label", "x"]).select("row", "id", "root", "n_links"), "pivot-named")
    lows = written(named.groupBy("root").agg(F.min("id").alias("low")), "pivot-lows")
    linked = named.join(lows, "root").select("id", "n_links", "low")
    alone = index.where("x is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("low"))
    return linked.unionByName(alone).select(
        "id", "n_links", F.col("low").alias("component_id"),
        F.coalesce(F.col("id") == F.col("low"), F.lit(False)).alias("kept"))


def op5_embedding_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES = {"op5_embedding_pivots": op5_embedding_pivots}

# Every pair by brute force; the index reaches all of them on the test tables.
_ORACLE = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_has_any([true], list_transform(embedding, lambda c: c <> 0))
    AND NOT list_has_any([true], list_transform(embedding, lambda c: c IS NULL OR NOT isfinite(c)))),
link AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r
         WHERE list_cosine_similarity(a.x, b.x) >= {MIN_COSINE}),
reach(u, w) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.u, link.w FROM reach JOIN link ON reach.w = link.u),
root AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM link GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN root ON root.u = vec_id LEFT JOIN n ON n.u = vec_id
"""
ORACLES = {"op5_embedding_pivots": _ORACLE}
