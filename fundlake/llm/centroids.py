"""Centroid clustering in integers, with PCA-rotated filtering.

Vectors become integers, floor(1024 x).  Each one is stored with its ``leading``
coordinates in a rotated frame and the norm of what those leave over.  With
the same figures of a centroid, the squared distance of the leading parts plus
the squared difference of the two norms is a lower bound of the squared
distance.  The centroid of the lowest bound is measured exactly; only centroids whose
bound does not exceed that distance are measured too.  Bounds are floats and
are lowered by more than their rounding; every distance that decides is an
integer, so the result is exact and the same in any order of the rows.

The rotation comes from the principal axes of all vectors: a 64 x 64 matrix of
sums, summed by partition.  A round sums each cluster by partition too, and
Spark adds the few rows; the driver holds ``k`` centroids and nothing else.  The
stored table is written once and read in each round.

Sums are exact at any size: partition sums are 64-bit, of vectors below
``NARROW``, and are added as decimals.  Vectors with a component beyond that are
taken by Python's integers, in pieces of 26 bits, and compared with every centroid.

Defined cases: a vector that is null, has another number of components than
``dim``, or holds a null or non-finite one is left out.  Repeated rows count as
often as they occur, ties go to the smaller cluster number, a null id starts
like an empty one; equal starting hashes are ordered by the vector.  With fewer
than ``k`` vectors there are fewer clusters; an empty table gives an empty one.
A squared distance or a sum of them beyond a long is null.  A component whose
1024-fold is beyond a double is still taken exactly.  Only the id and vector
columns are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import matrix, table, written

SCALE = 1024
DIM = 64
K = 8
ROUNDS = 10
LEADING = 16
SEED = 3
NARROW = 1 << 27             # components below it: 64 squared differences fit a long
PIECE = 26
LONG_MAX = (1 << 63) - 1


def whole(x: float) -> int:
    """floor(SCALE * x), exact also where the product is no double."""
    n, d = float(x).as_integer_ratio()
    return SCALE * n // d


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dim: int = DIM) -> DataFrame:
    """(id, q, big): the kept vectors; ``q`` holds int32 components, or is null where
    one is beyond them and ``big`` lists decimals."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            b = b.filter(pc.fill_null(pc.equal(pc.list_value_length(b.column(1)), dim), False))
            flat = b.column(1).flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)   # null: NaN
            x = flat.reshape(-1, dim)
            ok = np.isfinite(x).all(axis=1)
            x, ids = x[ok], b.column(0).filter(pa.array(ok))
            with np.errstate(over="ignore"):
                scaled = np.floor(SCALE * x)
            narrow = (np.abs(scaled) < NARROW).all(axis=1)
            q = np.where(narrow[:, None], scaled, 0).astype("<i4")
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([r.tobytes() if n else None for r, n in zip(q, narrow)], pa.binary()),
                pa.array([None if n else [str(whole(c)) for c in r] for r, n in zip(x, narrow)], pa.list_(pa.string()))],
                ["id", "q", "big"])

    return vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).mapInArrow(
        run, f"id {kind}, q binary, big array<string>")


def principal_axes(kept: DataFrame, dim: int, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, leading x dim orthonormal axes) of the narrow vectors, from sums
    over all of them.  Any axes give right bounds; these give close ones."""
    def run(batches):
        import pyarrow as pa
        n, s, m = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            x = matrix(b.column(0).drop_null(), "<i4", dim).astype(np.float64)
            n, s, m = n + len(x), s + x.sum(axis=0), m + x.T @ x
        yield pa.RecordBatch.from_pydict({"i": np.arange(dim + 1, dtype=np.int32), "s": [[float(n), *s], *([v, *r] for v, r in zip(s, m))]})

    sums = kept.select("q").mapInArrow(run, "i int, s array<double>")
    rows = sums.groupBy("i").agg(*[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(dim + 1)]).orderBy("i").collect()
    total = np.array([r[1:] for r in rows]) if rows else np.zeros((dim + 1, dim + 1))
    n = max(total[0, 0], 1.0)
    mean = total[0, 1:] / n
    spread = total[1:, 1:] / n - np.outer(mean, mean)
    _, axes = np.linalg.eigh((spread + spread.T) / 2)
    return mean, np.ascontiguousarray(axes[:, ::-1][:, :leading].T)


def rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leading coordinates, norm of the rest) of rows of numbers."""
    x = x.astype(np.float64) - mean
    lead = x @ axes.T
    rest = x - lead @ axes
    return lead, np.sqrt(np.einsum("ij,ij->i", rest, rest))


def store(kept: DataFrame, mean: np.ndarray, axes: np.ndarray) -> DataFrame:
    """(id, q, big, lead, rest): the vectors with what the filter needs."""
    kind = kept.schema["id"].dataType.simpleString()
    dim = len(mean)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ok = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            lead, rest = rotated(matrix(b.column(1).drop_null(), "<i4", dim), mean, axes)
            rows, at = [None] * len(ok), np.flatnonzero(ok)
            for i, y in zip(at.tolist(), lead):
                rows[i] = y.tobytes()
            left = np.full(len(ok), np.nan)
            left[at] = rest
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.binary()), pa.array(left)],
                                             ["id", "q", "big", "lead", "rest"])

    return kept.mapInArrow(run, f"id {kind}, q binary, big array<string>, lead binary, rest double")


def nearest(q: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: list[list[int]], mean, axes,
            seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of narrow vectors, exactly.  ``seen`` gets
    the number of exact distances."""
    c = np.array(centroids, np.int64)              # narrow too, as means of narrow vectors, else not called
    c_lead, c_rest = rotated(c, mean, axes)
    low = ((lead[:, None, :] - c_lead[None]) ** 2).sum(axis=2) + (rest[:, None] - c_rest[None]) ** 2
    # Rounding: all terms are sums over at most 64 products of numbers below this.
    top = max(float(np.abs(mean).max(initial=0)), float(np.abs(c).max(initial=0)), float(np.abs(q).max(initial=0))) + 1
    low = low * (1 - 1e-9) - 1e-9 * top * (np.sqrt(np.maximum(low, 0)) + 1e-6 * top)
    q = q.astype(np.int64)

    def distance(rows, clusters):
        d = q[rows] - c[clusters]
        return np.einsum("ij,ij->i", d, d)

    every = np.arange(len(q))
    cluster = low.argmin(axis=1)
    best = distance(every, cluster)
    open_ = low <= best[:, None]
    open_[every, cluster] = False
    n = len(q)
    for k in range(len(c)):
        rows = np.flatnonzero(open_[:, k])
        if len(rows):
            d = distance(rows, np.full(len(rows), k))
            n += len(rows)
            wins = (d < best[rows]) | ((d == best[rows]) & (k < cluster[rows]))
            best[rows[wins]], cluster[rows[wins]] = d[wins], k
    if seen is not None:
        seen.append(n)
    return cluster, best


def nearest_whole(vector: list[int], centroids: list[list[int]]) -> tuple[int, int]:
    """The same in Python's integers, against every centroid."""
    d = [sum((a - b) ** 2 for a, b in zip(vector, c)) for c in centroids]
    k = min(range(len(d)), key=lambda i: (d[i], i))
    return k, d[k]


def assigned(batch, centroids, mean, axes):
    """(clusters, squared distances as Python or numpy integers, integer rows) of a stored batch."""
    dim, n = len(mean), batch.num_rows
    names = batch.schema.names
    q_col = batch.column(names.index("q"))
    narrow = q_col.is_valid().to_numpy(zero_copy_only=False)
    q = matrix(q_col.drop_null(), "<i4", dim).astype(np.int64)
    big = {i: [int(c) for c in batch.column(names.index("big"))[i].as_py()] for i in np.flatnonzero(~narrow).tolist()}
    cluster, dist = np.zeros(n, np.int64), np.zeros(n, object if big else np.int64)
    if all(abs(v) < NARROW for c in centroids for v in c):
        lead = matrix(batch.column(names.index("lead")).drop_null(), "<f8", len(axes))
        rest = batch.column(names.index("rest")).to_numpy(zero_copy_only=False)[narrow]
        at = np.flatnonzero(narrow)
        cluster[at], dist[at] = nearest(q, lead, rest, centroids, mean, axes)
    else:
        dist = dist.astype(object)
        for i, v in zip(np.flatnonzero(narrow).tolist(), q.tolist()):
            cluster[i], dist[i] = nearest_whole(v, centroids)
    for i, v in big.items():
        cluster[i], dist[i] = nearest_whole(v, centroids)
    return cluster, dist, q, narrow, big


def cluster_sums(stored: DataFrame, centroids: list[list[int]], mean, axes) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (vectors, exact sum of each component)."""
    dim = len(mean)

    def run(batches):
        import pyarrow as pa
        sums: dict[tuple, np.ndarray] = {}          # (cluster, piece) -> [count, sums]

        def add(k, piece, n, values):
            sums.setdefault((k, piece), np.zeros(dim + 1, np.int64))[:] += np.r_[n, values]

        for b in batches:
            cluster, _, q, narrow, big = assigned(b, centroids, mean, axes)
            for k in np.unique(cluster[narrow]).tolist():
                mine = q[cluster[narrow] == k]
                add(k, 0, len(mine), mine.sum(axis=0))
            for i, v in big.items():
                piece, n = 0, 1
                while any(abs(c) >= NARROW for c in v):
                    add(int(cluster[i]), piece, n, [c & ((1 << PIECE) - 1) for c in v])
                    v, piece, n = [c >> PIECE for c in v], piece + 1, 0
                add(int(cluster[i]), piece, n, v)
        if sums:
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in sums], pa.int32()), pa.array([p for _, p in sums], pa.int32()),
                pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], ["cluster", "piece", "s"])

    rows = stored.drop("id").mapInArrow(run, "cluster int, piece int, s array<bigint>").groupBy("cluster", "piece").agg(
        *[F.sum(F.col("s")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(dim + 1)]).collect()
    out = {r.cluster: [0] * (dim + 1) for r in rows}
    for r in rows:
        out[r.cluster] = [a + (int(v) << (PIECE * r.piece)) for a, v in zip(out[r.cluster], r[2:])]
    return {k: (v[0], v[1:]) for k, v in out.items()}


def start(kept: DataFrame, k: int, dim: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of seed:id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "q", "big").orderBy("key", "q", F.col("big").cast("string")).limit(k).collect()
    return [np.frombuffer(r.q, "<i4").tolist() if r.q is not None else [int(c) for c in r.big] for r in rows]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dim: int = DIM, leading: int = LEADING, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) of each kept vector, final centroids)."""
    kept = written(integer_vectors(vectors, id_col, vec_col, dim), "centroid-vectors")
    kind = kept.schema["id"].dataType.simpleString()
    centroids = start(kept, k, dim, seed)
    mean, axes = principal_axes(kept, dim, min(leading, dim))
    stored = written(store(kept, mean, axes), "centroid-rotated") if centroids else kept.withColumns(
        {"lead": F.lit(None).cast("binary"), "rest": F.lit(None).cast("double")})
    for _ in range(rounds if centroids else 0):
        sums = cluster_sums(stored, centroids, mean, axes)
        new = [[s // sums[c][0] for s in sums[c][1]] if c in sums else old for c, old in enumerate(centroids)]
        if new == centroids:
            break                                   # further rounds would change nothing
        centroids = new

    def run(batches):
        import pyarrow as pa
        for b in batches:
            found, dist, *_ = assigned(b, centroids, mean, axes)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(found, pa.int32()),
                pa.array([d if d <= LONG_MAX else None for d in dist.tolist()], pa.int64())], ["id", "cluster", "distance"])

    return written(stored.mapInArrow(run, f"id {kind}, cluster int, distance bigint"), "centroid-clusters"), centroids


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    sums = {r.cluster: r for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("unknown")).collect()}
    one = [None if c in sums and sums[c].unknown else int(sums[c].s) if c in sums else 0 for c in range(len(centroids))]
    fits = [v if v is not None and v <= LONG_MAX else None for v in one]
    total = None if None in one or sum(one) > LONG_MAX else sum(one)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values, kind):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]), F.col("cluster"))

    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", of_cluster(fits, "long").alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256"))


QUERIES = {"op11_centroids": op11_centroids}


def _oracle() -> str:
    """Every vector against every centroid, round by round."""
    steps = [f"""
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, x FROM (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {DIM})),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, x AS c FROM (
  SELECT x, sha256('{SEED}:' || vec_id) AS h FROM v ORDER BY h LIMIT {K}))"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, k := cluster)) AS m FROM (
  SELECT r, cluster, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{i}) GROUP BY r)""")
        if i < ROUNDS:
            steps.append(f"""
s{i} AS (SELECT m.k AS cluster, j, sum(x[j]) AS s, count(*) AS n FROM a{i} JOIN v USING (r), range(1, {DIM + 1}) AS t(j) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(g.c, o.c) AS c FROM c{i} o LEFT JOIN (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM s{i} GROUP BY cluster) g USING (cluster))""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, CAST(m.k AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
       CAST(sum(m.d) OVER (PARTITION BY m.k) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} ON cluster = m.k
"""


ORACLES = {"op11_centroids": _oracle()}
