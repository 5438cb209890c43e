"""Toxicity by a weighted finite-state pattern grammar.

A sentence is read as a string of token classes: insult, threat, target,
negation, reporting verb, pause (``, ; :``), other.  Small weighted transducers
look at one thing each - a run of insults, a threat with its object, a target
before an insult, a negation before either, speech reported before or after -
and copy their input with the rules that apply.  ``compose`` joins them into
one machine.  What a token's weight depends on may stand behind it (the object
of a threat, ``..., he said``), so there are two machines: one walks the
sentence forwards, one backwards, and a token gets the rules of both.  Reports
and negations reach over pauses; nothing reaches over the end of a sentence.

A clause (what stands between two marks) scores the sum of its tokens' lexicon
weights times the factors of their rules, so the clause counts and not the word
alone.  A sentence without an insult or threat scores zero by construction and
is not walked.

The lexicon joins fixed words with stems learnt from the labelled table: of the
``20 * MAX_STEMS`` stems in most toxic texts, the ``MAX_STEMS`` with the most
evidence.  The rules' factors are fitted to the labels by projected gradient,
drawn to the fixed ones where the labels say little, and never turn a rule
round.  The document's clause scores become a probability by logistic
regression.  All of it learns from a bounded sample: ``SAMPLE_TOXIC`` toxic and
``SAMPLE_CLEAN`` other labelled ids, those with the smallest hashes, none of
them held out; of an id that many rows share, the text with the smallest hash.
Labels, language, source and id are not inputs of a score.

Defined cases: null and empty texts have no clause and get the score of a text
without a match; very long texts are scored whole, each in one task; without
labelled rows of both kinds the fixed lexicon, factors and weights are used;
null ids are scored and never learnt from; repeated rows are scored row by row;
of an id labelled both ways the toxic label counts; an empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import held_out, slices, small_batches, table, written

SAMPLE_TOXIC, SAMPLE_CLEAN = 8000, 16000
MAX_STEMS = 4000
MIN_LOG_ODDS = 2.5
ACCEPT = 0.3
STEM_SIZES = (4, 5, 6, 8)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, PAUSE = range(7)
CLASSES = 7
# Rule -> its factor before fitting.  A factor above 1 stays at 1 or more, one below 1 at 1 or less.
RULES = {"run": 1.25, "object": 1.5, "aimed": 1.1, "denied insult": 0.4, "denied threat": 0.2, "reported": 0.6,
         "told after": 0.6}
FACTOR_LIMIT, FACTOR_PULL = 20.0, 0.003
NONE: frozenset = frozenset()
# The grammar's closed word lists.
INSULTS = ("idiot", "moron", "stupid", "scum", "pathetic", "worthless", "disgusting", "loser", "trash", "clown",
           "imbecile", "bastard", "dummkopf", "trottel", "abschaum", "crétin", "imbécile", "salaud", "connard",
           "imbécil", "estúpido", "idiota", "basura", "asqueroso")
THREATS = ("kill", "murder", "strangle", "shoot", "stab", "umbringen", "töten", "tuer", "frapper", "matar", "golpear")
TARGETS = ("you", "your", "he", "she", "him", "her", "they", "them", "du", "dich", "ihr", "sie", "er",
           "tu", "vous", "toi", "il", "elle", "tú", "usted", "él", "ella")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "wasn't", "nicht", "kein", "nie", "pas", "jamais", "nunca", "ni")
REPORTS = ("said", "says", "called", "quoted", "wrote", "sagte", "nannte", "schrieb", "dit", "écrit", "dijo", "llamó",
           "escribió")


@dataclass(frozen=True)
class Transducer:
    """Copies its input; ``arcs[state][class]`` is (next state, output).  An
    output is a factor, or the set of the rules that apply."""
    arcs: tuple

    @staticmethod
    def of(states: dict, default: tuple) -> Transducer:
        """``states``: state -> {class: (next state, output)}; other classes
        take ``default[state]``."""
        return Transducer(tuple(tuple(states[s].get(c, default[s]) for c in range(CLASSES))
                                for s in range(len(states))))


def union(sets: list) -> frozenset:
    return NONE.union(*sets)


def compose(*machines: Transducer, times=math.prod) -> Transducer:
    """One machine whose states are the reachable tuples of states and whose
    outputs are the products (``union`` for sets of rules)."""
    start = (0,) * len(machines)
    index, todo, arcs = {start: 0}, [start], []
    for state in todo:
        row = []
        for c in range(CLASSES):
            steps = [m.arcs[s][c] for m, s in zip(machines, state)]
            to = tuple(n for n, _ in steps)
            if to not in index:
                index[to] = len(index)
                todo.append(to)
            row.append((index[to], times([f for _, f in steps])))
        arcs.append(tuple(row))
    return Transducer(tuple(arcs))


def window(trigger: int, length: int, classes: dict, one=1.0, ends: tuple = (), free: tuple = ()) -> Transducer:
    """For ``length`` tokens behind a ``trigger``, outputs for ``classes``.  A
    class of ``ends`` closes the window, one of ``free`` behind its first token
    takes no room."""
    states = {0: {trigger: (1, one)}}
    default = [(0, one)]
    for s in range(1, length + 1):
        after = s + 1 if s < length else 0
        states[s] = ({c: (after, f) for c, f in classes.items()} | {trigger: (1, classes.get(trigger, one))}
                     | {c: (0, one) for c in ends} | {c: (s if s > 1 else 0, one) for c in free})
        default.append((after, one))
    return Transducer.of(states, tuple(default))


def build() -> tuple[Transducer, Transducer]:
    """The machines that walk a sentence forwards and backwards."""
    def rule(name):
        return frozenset([name])

    insults = Transducer.of({0: {INSULT: (1, NONE)}, 1: {INSULT: (1, rule("run")), PAUSE: (0, NONE)}},
                            ((0, NONE), (1, NONE)))
    target = window(TARGET, 4, {INSULT: rule("aimed")}, NONE)
    # "not a liar, a clown" denies both; "no, you clown" denies nothing.
    negation = window(NEGATION, 4, {INSULT: rule("denied insult"), THREAT: rule("denied threat")}, NONE, free=(PAUSE,))
    told = {INSULT: (1, rule("reported")), THREAT: (1, rule("reported"))}
    report = Transducer.of({0: {REPORT: (1, NONE)}, 1: told}, ((0, NONE), (1, NONE)))
    threat = window(TARGET, 3, {THREAT: rule("object")}, NONE, ends=(PAUSE,))
    # Backwards: a reporting verb, at most two words, a pause, and then all that stands before it.
    after = {INSULT: (4, rule("told after")), THREAT: (4, rule("told after"))}
    wait = {s: {REPORT: (1, NONE), PAUSE: (4, NONE)} for s in (1, 2, 3)}
    follows = Transducer.of({0: {REPORT: (1, NONE)}, **wait, 4: after},
                            ((0, NONE), (2, NONE), (3, NONE), (0, NONE), (4, NONE)))
    return compose(insults, target, negation, report, times=union), compose(threat, follows, times=union)


_STRIP = {ord(c): None for c in "\"'()[]{}*_«»“”„"}
_STOP = re.compile(r"[.!?\n]+")
_PAUSE = re.compile(r"[,;:]+")
# The mark inside a quotation that goes on: "You clown!" he said.
_QUOTED = re.compile(r"[!?]+[\"'”»]+(?=[ \t]+[a-zß-ÿ])")


def sentences(text: str | None):
    """Each sentence as the word lists of its clauses."""
    for s in _STOP.split(_QUOTED.sub(",", text or "").lower().translate(_STRIP)):
        yield [c.split() for c in _PAUSE.split(s)]


@dataclass
class Grammar:
    weights: dict[str, float] = field(default_factory=dict)       # whole word or stem -> weight
    logit: np.ndarray = field(default_factory=lambda: np.array([-4.0, 2.0, 1.0, 1.0, 0.5]))
    center: np.ndarray = field(default_factory=lambda: np.zeros(4))
    spread: np.ndarray = field(default_factory=lambda: np.ones(4))
    factors: dict[str, float] = field(default_factory=lambda: dict(RULES))

    def __post_init__(self):
        self.exact = {w: (THREAT, 3.0) for w in THREATS} | {w: (INSULT, 3.0) for w in INSULTS}
        self.closed = ({w: (TARGET, 0.0) for w in TARGETS} | {w: (NEGATION, 0.0) for w in NEGATIONS}
                       | {w: (REPORT, 0.0) for w in REPORTS})
        # A learnt stem of a threat's word is a threat, any other an insult.
        self.learnt = {s: (THREAT if any(t.startswith(s) or s.startswith(t) for t in THREATS) else INSULT, w)
                       for s, w in self.weights.items()}
        self.heads = {w[:4] for w in (*self.exact, *self.weights)}
        self.forward, self.backward = (m.arcs for m in build())

    def token(self, word: str) -> tuple[int, float]:
        """(class, weight): a fixed word, or the longest learnt stem."""
        if word in self.exact:
            kind, w = self.exact[word]
            return kind, max(w, self.weights.get(word, 0.0))
        for n in sorted({len(word), *STEM_SIZES}, reverse=True):
            if n <= len(word) and word[:n] in self.learnt:
                return self.learnt[word[:n]]
        return self.closed.get(word, (OTHER, 0.0))

    def matches(self, text: str | None) -> tuple[list[list[tuple[float, frozenset]]], int]:
        """((weight, rules) of the insults and threats of each matched clause, words of the text)."""
        heads, found, n_words = self.heads, [], 0
        for parts in sentences(text):
            n_words += sum(map(len, parts))
            if not any([w[:4] in heads for p in parts for w in p]):
                continue
            tokens = []
            for p in parts:
                tokens += map(self.token, p)
                tokens.append((PAUSE, 0.0))
            behind, state = [], 0
            for kind, _ in reversed(tokens[:-1]):
                state, rules = self.backward[state][kind]
                behind.append(rules)
            clause, state = [], 0
            for kind, weight in tokens:
                state, rules = self.forward[state][kind]
                own = behind.pop() if behind else NONE
                if weight > 0:
                    clause.append((weight, rules | own))
                elif kind == PAUSE and clause:
                    found.append(clause)
                    clause = []
        return found, n_words

    def factor(self, rules: frozenset) -> float:
        return math.prod(self.factors[r] for r in rules)

    def clauses(self, text: str | None) -> tuple[list[float], int]:
        """(scores of the matched clauses, words of the text)."""
        found, n_words = self.matches(text)
        return [sum(w * self.factor(rules) for w, rules in clause) for clause in found], n_words

    def measures(self, texts: list[str | None]) -> np.ndarray:
        """Per text: clause total, strongest clause, matched clauses, density."""
        out = np.zeros((len(texts), 4))
        for i, t in enumerate(texts):
            found, n = self.clauses(t)
            if found:
                out[i] = (math.log1p(sum(found)), math.log1p(max(found)), math.log1p(len(found)), min(1, 20 * len(found) / n))
        return out

    def score(self, measures: np.ndarray) -> np.ndarray:
        x = (measures - self.center) / self.spread
        return 1 / (1 + np.exp(-np.clip(self.logit[0] + x @ self.logit[1:], -30, 30)))


def stems(text: str | None) -> set[str]:
    """The words of a text and their leading stems, as the lexicon has them."""
    words = {w for parts in sentences(text) for p in parts for w in p if len(w) >= 4}
    return {w[:n] for w in words for n in STEM_SIZES if len(w) >= n} | words


def _stem_counts(rows: DataFrame, only: frozenset | None) -> DataFrame:
    """(stem, n): documents that hold each stem, counted per task first."""
    def run(batches):
        import pyarrow as pa
        seen: Counter = Counter()
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                own = stems(t)
                seen.update(own if only is None else own & only)
        if seen:
            yield pa.RecordBatch.from_pydict({"stem": pa.array(list(seen), pa.string()),
                                              "n": pa.array(list(seen.values()), pa.int64())})
    return rows.select("text").mapInArrow(run, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str) -> DataFrame:
    """(text, y) of the bounded sample, one row for each id; the sampled ids
    are at most ``SAMPLE_TOXIC + SAMPLE_CLEAN`` rows and are broadcast."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("id"))
    picked = None
    for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        part = known.where(F.col("y") == y).orderBy("h", "id").limit(n).select("id", "y")
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"]
    return texts.join(F.broadcast(picked), "id").groupBy("id", "y").agg(least.alias("text")).select("text", "y")


def fit_factors(sums: list[dict], y: np.ndarray, rounds: int = 400) -> dict[str, float]:
    """The rules' factors that best tell the labels ``y`` by a logistic on the
    log of the weighted sum.  ``sums``: per text, weight by set of rules.

    Projected gradient on the log factors, with halved steps until the loss
    falls; ``FACTOR_PULL`` draws each to its factor in ``RULES``."""
    names = list(RULES)
    seen = sorted({m for d in sums for m in d}, key=sorted)
    where = {m: i for i, m in enumerate(seen)}
    w = np.zeros((len(sums), len(seen)))
    for i, d in enumerate(sums):
        for m, v in d.items():
            w[i, where[m]] = v
    has = np.array([[r in m for r in names] for m in seen], float).reshape(len(seen), len(names))
    start = np.log([RULES[r] for r in names])
    low = np.where(start > 0, 0.0, -math.log(FACTOR_LIMIT))
    high = np.where(start > 0, math.log(FACTOR_LIMIT), 0.0)

    def loss(t):
        parts = w * np.exp(has @ t[2:])
        total = parts.sum(axis=1)
        z = np.log1p(total)
        s = np.clip(t[0] + t[1] * z, -30, 30)
        p = 1 / (1 + np.exp(-s))
        off = t[2:] - start
        value = np.mean(np.logaddexp(0, s) - y * s) + 1e-4 * t[1] ** 2 + FACTOR_PULL * off @ off
        e = (p - y) / len(y)
        grad = np.concatenate([[e.sum(), e @ z + 2e-4 * t[1]],
                               (e * t[1] / (1 + total)) @ parts @ has + 2 * FACTOR_PULL * off])
        return value, grad

    t, step = np.concatenate([[-1.0, 1.0], start]), 1.0
    value, grad = loss(t)
    for _ in range(rounds):
        new = t - step * grad
        new[2:] = np.clip(new[2:], low, high)
        v, g = loss(new)
        if v > value:
            step /= 2
            if step < 1e-9:
                break
            continue
        done = value - v < 1e-9 and np.abs(new - t).max() < 1e-6
        t, value, grad, step = new, v, g, step * 1.5
        if done:
            break
    return dict(zip(names, np.exp(t[2:]).tolist()))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text") -> Grammar:
    rows = written(sample(docs, labels, label_col, id_col, text_col), "toxicity-sample")
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Grammar()
    least = max(3, n_toxic // 200)
    toxic = {r.stem: r.n for r in _stem_counts(rows.where("y = 1"), None).where(F.col("n") >= least)
             .orderBy(F.desc("n"), "stem").limit(20 * MAX_STEMS).collect()}
    clean = {r.stem: r.n for r in _stem_counts(rows.where("y = 0"), frozenset(toxic)).collect()}
    odds = {s: math.log((n + 0.1) / n_toxic) - math.log((clean.get(s, 0) + 0.5) / n_clean) for s, n in toxic.items()}
    strong = sorted((s for s, o in odds.items() if o >= MIN_LOG_ODDS), key=lambda s: (-odds[s] * toxic[s], s))
    chosen: dict[str, float] = {}
    for s in strong[:MAX_STEMS]:
        chosen[s] = odds[s]
    g = Grammar(chosen)
    names = list(RULES)

    def parts(batches):
        import pyarrow as pa
        for b in slices(batches):
            out = []
            for t in b.column(0).to_pylist():
                sums: Counter = Counter()
                for clause in g.matches(t)[0]:
                    for w, rules in clause:
                        sums[sum(1 << names.index(r) for r in rules)] += w
                out.append(sums)
            yield pa.RecordBatch.from_arrays([pa.array([list(d) for d in out], pa.list_(pa.int32())),
                                              pa.array([list(d.values()) for d in out], pa.list_(pa.float64())),
                                              b.column(1)], ["rules", "w", "y"])

    seen = rows.select("text", "y").mapInArrow(parts, "rules array<int>, w array<double>, y int").collect()
    sums = [{frozenset(n for i, n in enumerate(names) if m >> i & 1): w for m, w in zip(r.rules, r.w)} for r in seen]
    g.factors = fit_factors(sums, np.array([r.y for r in seen], float))

    def run(batches):
        import pyarrow as pa
        for b in slices(batches):
            m = g.measures(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(m), pa.list_(pa.float64())), b.column(1)], ["m", "y"])

    seen = rows.select("text", "y").mapInArrow(run, "m array<double>, y int").collect()
    x = np.array([r.m for r in seen])
    y = np.array([r.y for r in seen], float)
    g.center, g.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.hstack([np.ones((len(x), 1)), (x - g.center) / g.spread])
    w = np.zeros(z.shape[1])
    for _ in range(50):                      # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) / len(y) + 1e-3 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    g.logit = w
    return g


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text",
          accept: float = ACCEPT) -> DataFrame:
    """(id, held_out, score, predicted, n_clauses) of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in slices(batches):
            m = grammar.measures(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(grammar.score(m)), pa.array(np.rint(np.expm1(m[:, 2])).astype(np.int64))],
                ["id", "score", "n_clauses"])

    return (small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, score double, n_clauses long")
            .select("id", held_out(F.col("id")).alias("held_out"), "score",
                    (F.col("score") >= accept).cast("int").alias("predicted"), "n_clauses"))


def op9_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, grammar).withColumnRenamed("id", "doc_id")


QUERIES = {"op9_toxicity_grammar": op9_toxicity_grammar}
ORACLES: dict[str, str] = {}
