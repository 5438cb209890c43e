"""Soft-membership mixing of sources to target weights.

1. A softmax classifier on byte-pair frequencies learns the domains of a
   labelled table (a bounded sample: ``SAMPLE`` rows with the smallest hashes)
   and gives every whole text its domain posteriors.
2. Every document has a rate, the expected number of times it is used.  The
   expected tokens of domain k are the sum of rate x tokens x posterior k.
   Nonnegative rates are moved by projected gradient on the squared misses of the
   targets (plus a tiny pull towards 1, which picks the rates closest to it).  A
   step is scaled by the inverse of the misses' second derivative over the
   documents in use, a k x k Gram matrix, and leaves documents alone that are at
   zero and would go below (two-metric projection); it is halved while it does not
   lower the sum.  So few steps reach the targets to ``TOLERANCE`` whatever the
   domains' shares.  A step is k + k numbers; each document's rate follows from its
   posteriors and the steps so far, so a step costs two distributed aggregates
   (totals, Gram matrix) and no rate is ever kept on the driver.
   Targets that no rates reach are reported by a warning and ``Mixer.missed``;
   rates are then the least squares ones with ``PULL`` towards 1.
3. ``mix`` uses a document floor(rate) times, and once more with the rest as
   probability, by a hash of its id and text.

Totals are shares of the tokens, so nothing depends on the corpus size.  A
share of 1e-6 or less counts as no tokens of the domain: its target is missed,
and reported.  A solve takes at most ``MAX_SOLVE`` aggregates; one that ends there
is reported with the totals reached.

Defined cases: a null or empty text has no tokens, uniform posteriors and the
rate that follows from them; without labelled rows all posteriors are uniform
and rates only match the total; very long texts are read whole, like any other; a domain without labelled rows gets no
posterior; null ids and repeated rows are rated row by row, equal rows alike;
an empty table gives no rows.  ``mix`` keeps all columns.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import fresh, slices, small_batches, table, written

SAMPLE = 4000
TOLERANCE = 1e-3                 # of the expected tokens, for every domain's total
PULL = 1e-3
EXACT_PULL = 1e-9                # too small to move a total by the tolerance at rates under a million
MAX_SOLVE = 100                  # aggregates of a solve; a solve that needs more is reported
NO_SHARE = 1e-6
REWRITE = 12                     # steps folded into one expression before rates are written
HEADROOM = 1.01                  # over the smallest budget, so that no rate falls below 1 by tolerance
KINDS = 40
# The weights of the query and the pipeline: shares of the expected tokens.
TARGETS = {"en": 0.5, "de": 1 / 6, "fr": 1 / 6, "es": 1 / 6}


def _byte_kinds() -> np.ndarray:
    out = np.full(256, 26, np.int64)
    out[97:123] = np.arange(26)
    out[65:91] = np.arange(26)
    out[[32, 9, 10, 11, 12, 13]] = 27
    out[48:58] = 28
    out[128:] = 29 + np.arange(128) % 11
    return out


def byte_pairs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(square roots of byte-pair shares, words) of each text."""
    kinds = _byte_kinds()
    x = np.zeros((len(texts), KINDS * KINDS), np.float32)
    words = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        words[i] = len(raw.split())
        if len(raw) > 1:
            k = kinds[np.frombuffer(raw, np.uint8)]
            x[i] = np.bincount(k[:-1] * KINDS + k[1:], minlength=KINDS * KINDS)
            x[i] = np.sqrt(x[i] / (len(raw) - 1))
    return x, words


@dataclass
class Mixer:
    domains: tuple[str, ...]
    weights: np.ndarray | None                   # (pairs + 1, domains); None: uniform
    step: float = 0.0
    pull: float = PULL
    residuals: list = field(default_factory=list)
    steps: list = field(default_factory=list)    # (length, misses, scaled step) of each scaled step
    missed: float = 0.0                          # largest miss of a total, as a share of the expected tokens

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        k = len(self.domains)
        if self.weights is None:
            return np.full((len(x), k), 1 / k)
        z = x @ self.weights[:-1] + self.weights[-1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[~x.any(axis=1)] = 1 / k
        return p

    def rates(self, p: np.ndarray) -> np.ndarray:
        """The fitted rates of rows with posteriors ``p``."""
        r = np.ones(len(p))
        for e in self.residuals:
            r = np.maximum(0, r - self.step * (p @ np.asarray(e) + self.pull * (r - 1)))
        for length, e, v in self.steps:
            rest = (r <= 0) & (p @ e >= 0)
            r = np.where(rest, 0.0, np.maximum(0, (1 - length) * r + length * (1 - p @ v)))
        return r


def softmax_fit(x: np.ndarray, y: np.ndarray, k: int, rounds: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Weights of a softmax regression, by accelerated gradient."""
    z = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    gold = np.eye(k)[y]
    w = np.zeros((z.shape[1], k))
    look, rate = w.copy(), 1.0 / (0.5 * np.linalg.norm(z, 2) ** 2 / len(z) + decay)
    for i in range(rounds):
        s = z @ look
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        new = look - rate * (z.T @ (p - gold) / len(z) + decay * look)
        look = new + i / (i + 3) * (new - w)
        w = new
    return w


def learn(docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...], id_col: str, text_col: str,
          sample: int = SAMPLE) -> np.ndarray | None:
    """Classifier weights from the labelled table (id, domain)."""
    picked = (labelled.where(F.col("domain").isin(*domains) & F.col("id").isNotNull()).groupBy("id")
              .agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa
        for b in slices(batches):
            x, _ = byte_pairs(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary()),
                                              b.column(1)], ["x", "domain"])

    # One text of each picked id, the one with the least hash: an id that many rows share is one row.
    chosen = (texts.join(F.broadcast(picked), "id").withColumn("h", F.struct(F.xxhash64("text").alias("h"), "text"))
              .groupBy("id", "domain").agg(F.min("h")["text"].alias("text")))
    rows = chosen.select("text", "domain").mapInArrow(run, "x binary, domain string").collect()
    if not rows:
        return None
    x = np.stack([np.frombuffer(r.x, np.float32) for r in rows])
    y = np.array([domains.index(r.domain) for r in rows])
    w = softmax_fit(x, y, len(domains))
    w[-1, [k for k in range(len(domains)) if not (y == k).any()]] = -50.0
    return w


def posteriors(docs: DataFrame, mixer: Mixer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens, p): words and domain posteriors of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in slices(batches):
            x, words = byte_pairs(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words), pa.array(list(mixer.posteriors(x)), pa.list_(pa.float64()))],
                ["id", "tokens", "p"])

    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"id {kind}, tokens long, p array<double>")


def _stepped(rate: Column, residual: np.ndarray, step: float, pull: float) -> Column:
    drift = sum((F.col("p")[k] * float(e) for k, e in enumerate(residual)), F.lit(0.0))
    return F.greatest(F.lit(0.0), rate - step * (drift + pull * (rate - 1.0)))


def _along(numbers, k: int) -> Column:
    """The posteriors times ``numbers`` (a Column of an array, or numbers)."""
    return sum((F.col("p")[i] * (numbers[i] if isinstance(numbers, Column) else float(numbers[i])) for i in range(k)),
               F.lit(0.0))


def _rate(steps: list, k: int) -> Column:
    """The rate of a row after ``steps``, folded over them (``Mixer.rates`` in Spark)."""
    if not steps:
        return F.lit(1.0)
    rows = F.array(*[F.struct(F.lit(float(n)).alias("n"), F.array(*[F.lit(float(x)) for x in e]).alias("e"),
                              F.array(*[F.lit(float(x)) for x in v]).alias("v")) for n, e, v in steps])

    def moved(r, s):
        there = F.greatest(F.lit(0.0), (1 - s["n"]) * r + s["n"] * (1 - _along(s["v"], k)))
        return F.when((r <= 0) & (_along(s["e"], k) >= 0), F.lit(0.0)).otherwise(there)

    return F.aggregate(rows, F.lit(1.0), moved)


def _totals(known: DataFrame, k: int, rate: Column) -> tuple[float, np.ndarray, float]:
    """(tokens, domain totals, token-weighted mean of (rate - 1)^2) in one aggregate."""
    t = F.col("tokens").cast("double")
    row = known.withColumn("rate", rate).agg(
        F.sum(t).alias("n"), F.sum(t * (F.col("rate") - 1) ** 2).alias("q"),
        *[F.sum(F.col("rate") * t * F.col("p")[i]).alias(f"s{i}") for i in range(k)]).first()
    if not row.n:
        return 0.0, np.zeros(k), 0.0
    return row.n, np.array([row[f"s{i}"] for i in range(k)]) / row.n, row.q / row.n


def _in_use(known: DataFrame, k: int, rate: Column, misses: np.ndarray, n: float) -> tuple[np.ndarray, np.ndarray]:
    """(Gram matrix, totals of rate - 1) of the documents in use: all but those at
    zero that the gradient pushes below it."""
    p, t = [F.col("p")[i] for i in range(k)], F.col("tokens").cast("double")
    used = known.withColumn("rate", rate).where((F.col("rate") > 0) | (_along(misses, k) < 0))
    row = used.agg(*[F.sum(t * (F.col("rate") - 1) * p[i]).alias(f"a{i}") for i in range(k)],
                   *[F.sum(t * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    return (np.array([[row[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]) / n,
            np.array([row[f"a{i}"] or 0.0 for i in range(k)]) / n)


def solve(known: DataFrame, start: tuple, want: np.ndarray, live: np.ndarray, pull: float,
          close: float) -> tuple[list, np.ndarray]:
    """(steps, totals) of the scaled projected gradient; ends when the totals of the
    ``live`` domains are within ``close``, or no step lowers the sum any more.
    ``start``: ``_totals`` at rate 1."""
    k, (n, now, off) = len(want), start
    steps: list = []
    spent = 0

    def value(now, off):
        return (np.where(live, now - want, 0.0) ** 2).sum() / 2 + pull / 2 * off

    while spent < MAX_SOLVE:
        misses = np.where(live, now - want, 0.0)
        if np.abs(misses).max(initial=0.0) <= close:
            break
        gram, moved = _in_use(known, k, _rate(steps, k), misses, n)
        spent += 1
        step = np.zeros(k)
        step[live] = np.linalg.solve(gram[np.ix_(live, live)] + pull * np.eye(live.sum()), (misses - moved)[live])
        length, before = 1.0, value(now, off)
        while spent < MAX_SOLVE:
            trial = [*steps, (length, misses, step)]
            _, there, away = _totals(known, k, _rate(trial, k))
            spent += 1
            if value(there, away) < before * (1 - 1e-4 * length):
                steps, now, off = trial, there, away
                break
            length /= 2
            if length < 1e-6:
                return steps, now
    return steps, now


def fit_rates(known: DataFrame, mixer: Mixer, targets: dict[str, float], budget: float | None = None,
              max_steps: int | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """Fit the rates; fills ``mixer`` and returns (id, tokens, p, rate).

    ``budget``: expected tokens in all.  Without one it is the smallest total
    for which no domain's documents need to be used less than once.
    ``max_steps`` asks for at most so many unscaled projected gradient steps
    instead.  A total off by more than ``tolerance`` is reported.
    """
    k = len(mixer.domains)
    p = [F.col("p")[i] for i in range(k)]
    rated = known.withColumn("rate", F.lit(1.0))
    start = _totals(known, k, F.lit(1.0))
    n, share, _ = start
    if not n:
        return rated
    want = np.array([targets.get(d, 0.0) for d in mixer.domains])
    want = want / want.sum()
    live = share > NO_SHARE
    scale = budget / n if budget is not None else HEADROOM * max(
        [1.0, *(s / w for s, w, on in zip(share, want, live) if w > 0 and on)])
    want = want * scale
    if max_steps is None:
        mixer.steps, now = solve(known, start, want, live, EXACT_PULL, tolerance * scale)
        if np.abs(now - want)[live].max(initial=0.0) > tolerance * scale:
            mixer.steps, now = solve(known, start, want, live, mixer.pull, tolerance * scale)
        rated = known.withColumn("rate", _rate(mixer.steps, k))
    else:
        gram, _ = _in_use(known, k, F.lit(1.0), np.zeros(k), n)
        mixer.step = 1.0 / (np.linalg.eigvalsh(gram)[-1] + mixer.pull)
        now, pending = share, 0
        for _ in range(max_steps):
            residual = now - want
            if np.abs(residual).max() <= tolerance * scale:
                break
            mixer.residuals.append([float(e) for e in residual])
            rated = rated.withColumn("rate", _stepped(F.col("rate"), residual, mixer.step, mixer.pull))
            pending += 1
            if pending == REWRITE:
                rated, pending = written(rated, "mixing-rates"), 0
            row = rated.agg(*[F.sum(F.col("rate") * F.col("tokens") * p[i]).alias(f"s{i}") for i in range(k)]).first()
            now = np.array([row[f"s{i}"] for i in range(k)]) / n
    mixer.missed = float(np.abs(now - want).max() / scale)
    if mixer.missed > tolerance:
        told = ", ".join(f"{d} {a:.4f} for {b:.4f}" for d, a, b in zip(mixer.domains, now / scale, want / scale))
        warnings.warn(f"soft mixing misses its targets by up to {mixer.missed:.4f} of the expected tokens: {told}",
                      stacklevel=2)
    return rated


def fit(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id",
        text_col: str = "text", budget: float | None = None) -> tuple[Mixer, DataFrame]:
    """(mixer, rated documents); ``labelled`` has columns id and domain."""
    domains = tuple(targets)
    mixer = Mixer(domains, learn(docs, labelled, domains, id_col, text_col))
    known = written(posteriors(docs, mixer, id_col, text_col), "mixing-posteriors")
    return mixer, fit_rates(known, mixer, targets, budget)


def copies(rate: Column, *keys: Column) -> Column:
    """floor(rate), and one more with the rest as probability."""
    draw = F.pmod(F.xxhash64(*keys, F.lit(20260103)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def mix(docs: DataFrame, mixer: Mixer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its rate says."""
    @F.pandas_udf("double")
    def rate(texts):
        import pandas as pd
        t = texts.tolist()
        return pd.Series(np.concatenate([mixer.rates(mixer.posteriors(byte_pairs(t[a:a + 512])[0]))
                                         for a in range(0, len(t), 512)]) if t else [], dtype=float)

    n, i = fresh(docs, "copies", "copy")
    counted = docs.withColumn(n, copies(rate(F.col(text_col).cast("string")), F.col(id_col), F.col(text_col)))
    return (counted.where(F.col(n) > 0).withColumn(i, F.explode(F.sequence(F.lit(1), F.col(n))))
            .select(*docs.columns))


def language_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, domain): the languages of the documents in the labelled table."""
    return docs.join(labels.select("doc_id").distinct(), "doc_id").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("domain"))


def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixer, rated = fit(docs, language_labels(docs, table(spark, sf_dir, "labels")), TARGETS)
    return rated.select(F.col("id").alias("doc_id"), "tokens",
                        *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(mixer.domains)], "rate")


QUERIES = {"op4_soft_mixing": op4_soft_mixing}
ORACLES: dict[str, str] = {}
