"""Quality classifier: random Fourier features over document statistics.

1. Every whole text becomes ``STATS`` statistics (lengths, character classes,
   word and line ratios), standardised by means and deviations that are summed
   over all documents.
2. Random Fourier features approximate a Gaussian kernel on them.
3. Ridge scores come from normal equations: each partition sums its own
   matrix, the matrices are summed in ``FAN_IN`` groups, and one matrix of
   fixed size reaches the driver.
4. Isotonic calibration turns scores into probabilities: labels are summed in
   a fixed number of score bins, and pool-adjacent-violators runs on the bins.

Ridge learns from the ids with crc32 mod 4 of 0 or 1, calibration from 3; the
remainder 2 is never learnt from.  Labels, language, source and id are not
inputs of a score.

Defined cases: a null text counts as empty and gets the score of an empty
text; rows without an id are scored and never learnt from; rows with a null
label are not learnt from; without any labelled row every score is 0.5.
Repeated rows are scored row by row.  Very long texts are measured whole; an
empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import held_out, slices, small_batches, table, written

N_FEATURES = 192
RIDGE = 1e-3
BANDWIDTH = 4.0
BINS = 2000
FAN_IN = 16
ACCEPT = 0.7
SEED = 11

# Character classes of UTF-8 bytes, in the order of their statistics.
_CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "newline": (10,),
            "space": (32, 9, 11, 12, 13), "stop": b".,;:", "shout": b"!?", "symbol": b"#*$%&|<>",
            "quote": b"\"'()[]{}", "accent": range(128, 256)}
STATS = ("log_chars", "log_words", "log_lines", "mean_word", "long_words", "distinct_words",
         "repeated_triples", "repeated_lines", "words_per_line", "capital_words", *_CLASSES)


def _byte_class() -> np.ndarray:
    out = np.full(256, len(_CLASSES), np.uint8)
    for i, chars in enumerate(_CLASSES.values()):
        out[list(chars)] = i
    return out


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of ``STATS`` for each text."""
    kinds = _byte_class()
    out = np.zeros((len(texts), len(STATS)))
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        words = raw.split()
        lines = [x for x in raw.split(b"\n") if x.strip()]
        n, m = len(words), max(len(words), 1)
        counts = np.bincount(kinds[np.frombuffer(raw, np.uint8)], minlength=len(_CLASSES) + 1)[:-1]
        sizes = np.fromiter(map(len, words), np.int64, n)
        triples = len(set(zip(words, words[1:], words[2:])))
        out[i, :10] = (
            np.log1p(len(raw)), np.log1p(n), np.log1p(len(lines)), sizes.sum() / m, (sizes > 12).sum() / m,
            len(set(words)) / m, 1 - triples / max(n - 2, 1) if n > 2 else 0,
            1 - len(set(lines)) / max(len(lines), 1) if lines else 0, np.log1p(n / max(len(lines), 1)),
            sum(map(bytes.isupper, words)) / m)
        out[i, 10:] = counts / max(len(raw), 1)
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None          # None: nothing was learnt
    edges: np.ndarray                   # calibration: raw score -> probability
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        raw = self.raw(stats)
        steps = np.interp(raw, self.edges, self.values)
        # A trace of the raw score keeps the order inside a calibrated step.
        return np.clip(0.998 * steps + 0.002 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def fourier(x: np.ndarray, n: int = N_FEATURES, bandwidth: float = BANDWIDTH) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, 1 / bandwidth, (x.shape[1], n))
    phase = rng.uniform(0, 2 * np.pi, n)
    return np.hstack([np.sqrt(2 / n) * np.cos(np.clip(x, -12, 12) @ w + phase), np.ones((len(x), 1))])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats): the statistics of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in slices(batches):
            s = statistics(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(s), pa.list_(pa.float64()))],
                                             ["id", "stats"])

    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"id {kind}, stats array<double>")


def summed(rows: DataFrame, part, size: int) -> np.ndarray:
    """Sum of ``part(record batch)`` (vectors of ``size``) over all partitions."""
    def each(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        total = np.zeros(size)
        for b in batches:
            for a in range(0, b.num_rows, 4096):
                total += part(b.slice(a, 4096))
        if total.any():
            yield pa.RecordBatch.from_pydict({"g": pa.array([TaskContext.get().partitionId() % FAN_IN], pa.int32()),
                                              "m": pa.array([total.tobytes()], pa.binary())})

    def gather(batches):
        import pyarrow as pa
        total = np.zeros(size)
        for b in batches:
            for m in b.column("m").to_pylist():
                total += np.frombuffer(m)
        if total.any():
            yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(each, "g int, m binary").repartition(FAN_IN, "g").mapInArrow(gather, "m binary")
    return sum((np.frombuffer(r.m) for r in parts.collect()), np.zeros(size))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, len(STATS)))


def pool_adjacent(total: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Nondecreasing weighted means: the isotonic fit of total / weight."""
    blocks: list[list[float]] = []
    for t, w in zip(total, weight):
        blocks.append([t, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t2, w2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t2, blocks[-1][1] + w2, blocks[-1][2] + n2]
    return np.concatenate([np.full(n, t / w) for t, w, n in blocks]) if blocks else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame, label_col: str, label_id: str = "doc_id",
        ridge: float = RIDGE) -> Model:
    """``stats``: rows of ``features`` (read several times: write them first)."""
    f = len(STATS)

    def moments(b):
        x = _matrix(b.column("stats"))
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    m = summed(stats.select("stats"), moments, 1 + 2 * f)
    n = max(m[0], 1)
    mean = m[1:1 + f] / n
    var = np.maximum(m[1 + f:] / n - mean ** 2, 0)
    scale = np.where(var > 1e-12, np.sqrt(var), 1)
    model = Model(mean, scale, None, np.zeros(1), np.zeros(1))

    known = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(label_id).alias("id"), F.col(label_col).cast("double").alias("y")).where(~held_out(F.col("id")))
    rows = stats.join(known, "id").withColumn("fold", F.crc32(F.col("id").cast("string").cast("binary")) % 4)
    d = N_FEATURES + 1

    def normal(b):
        z = fourier((_matrix(b.column("stats")) - mean) / scale)
        y = b.column("y").to_numpy()
        return np.concatenate([(z.T @ z).ravel(), z.T @ y, [len(y)]])

    s = summed(rows.where("fold in (0, 1)").select("stats", "y"), normal, d * d + d + 1)
    if s[-1] == 0:
        return model
    gram = s[:d * d].reshape(d, d) / s[-1]
    pull = ridge * np.eye(d)
    pull[-1, -1] = 0
    model.weights = np.linalg.solve(gram + pull + 1e-10 * np.eye(d), s[d * d:-1] / s[-1])

    def bins(b):
        at = np.clip(((model.raw(_matrix(b.column("stats"))) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        y = b.column("y").to_numpy()
        return np.concatenate([np.bincount(at, y, BINS), np.bincount(at, minlength=BINS)])

    c = summed(rows.where("fold = 3").select("stats", "y"), bins, 2 * BINS)
    hit = np.flatnonzero(c[BINS:])
    if len(hit):
        model.edges = (hit + 0.5) / BINS * 2 - 0.5
        model.values = pool_adjacent(c[:BINS][hit], c[BINS:][hit])
    else:
        model.edges, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score(stats: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """(id, held_out, score, predicted) of ``features``' rows."""
    kind = stats.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(model.score(_matrix(b.column(1))))], ["id", "score"])

    return stats.select("id", "stats").mapInArrow(run, f"id {kind}, score double").select(
        "id", held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= accept).cast("int").alias("predicted"))


def score_column(text: Column, model: Model) -> Column:
    """The score of a text column, for frames that keep their other columns."""
    @F.pandas_udf("double")
    def of(texts):
        import pandas as pd
        t = texts.tolist()
        return pd.Series(np.concatenate([model.score(statistics(t[a:a + 512])) for a in range(0, len(t), 512)])
                         if t else [], dtype=float)
    return of(text.cast("string"))


def op6_quality_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(features(table(spark, sf_dir, "documents")), "quality-stats")
    model = fit(stats, table(spark, sf_dir, "labels"), "quality")
    return score(stats, model).withColumnRenamed("id", "doc_id")


QUERIES = {"op6_quality_kernel": op6_quality_kernel}
ORACLES: dict[str, str] = {}
