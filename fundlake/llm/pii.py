"""Personal data: fixed patterns and a character LSTM with CRF transitions.

The base spans come from four patterns with their checks.  A character-level
bidirectional LSTM-CRF (``tagger``) adds spans the patterns can't describe,
such as numbers written without a plus sign or addresses spelt out.  It is
trained in numpy on labelled spans: windows of a bounded sample of documents
(``SAMPLE_DOCS`` rows with the smallest hashes), labelled with their base spans
and with spans written into them in many forms.

Whole texts are cut into overlapping windows; every window is decoded, and the
windows' spans are reconciled over the whole document: pieces of one span cut
by a window border are joined, and of spans that still overlap the set with the
largest total score stays.  Base spans always stay; added spans keep clear of
them and must pass their kind's plausibility test.

Defined cases: a null text counts as empty and has no span; rows with null ids
and repeated rows are searched row by row; an empty table gives no rows (the
tagger is then trained on written spans alone).  Only the id and text columns
are read; ``redact`` keeps all columns.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import hashed_sample, slices, small_batches, table
from fundlake.llm.tagger import KINDS, PAD, Tagger, codes, train

SAMPLE_DOCS = 2000
WINDOW, OVERLAP = 512, 48
BATCH_WINDOWS = 2048
TRAIN_WINDOW, TRAIN_WINDOWS = 64, 6000
MIN_MARGIN = 1.0

# Runs of digits are entered at their first digit only: a later start in the
# same run ends the same way, and long runs stay linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def by_place(span: tuple[int, int, int]) -> tuple[int, int]:
    """Spans are listed by start, then by kind."""
    return span[0], span[2]


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, kind index), by start, then kind; code points."""
    text = text or ""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end(), 0))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m.group().split(".")):
            found.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = digits_of(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                found.append((*m.span(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                found.append((*m.span(), 3))
    return sorted(found, key=by_place)


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, z, k in spans)


# ---------------------------------------------------------------- training

def _written(rng: np.random.Generator) -> tuple[str, int]:
    """(text, tag) of an invented span, or of a look-alike with tag 0."""
    def word(a, b):
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(a, b)))

    def number(n):
        return "".join(rng.choice(list("0123456789"), n))

    form = rng.integers(0, 13)
    host = f"{word(3, 9)}{rng.choice(['', number(1)])}.{rng.choice(['example.com', 'org', 'net', 'co.uk', 'de', 'com'])}"
    user = word(2, 9) + str(rng.choice(["", "." + number(2), "_" + word(2, 5), number(2), "." + word(3, 7)]))
    if form == 0:
        return f"{user}@{host}", 1
    if form == 1:
        at = rng.choice([" at ", "(at)", " (at) ", "[at]", " [at] ", " @ "])
        dot = rng.choice([" dot ", "[dot]", " [dot] ", "."])
        return f"{user}{at}{host.replace('.', str(dot))}", 1
    if form in (2, 3):
        return ".".join(str(rng.integers(1, 256)) for _ in range(4)), 2
    if form in (4, 5):
        d = str(rng.choice([3, 4, 5])) + number(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = str(rng.choice(["", "", " ", "-", "."]))
        return sep.join(d[i:i + 4] for i in range(0, 16, 4)), 3
    if form in (6, 7, 8):
        a, b, c = number(3), number(3), number(4)
        return str(rng.choice([f"+1 ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}",
                               f"+{number(2)} {a} {b}{c}", f"{a}.{b}.{c}", f"001 {a} {b} {c}"])), 4
    if form == 9:
        return "".join(rng.choice(list("0123456789abcdef"), rng.integers(12, 41))), 0
    if form == 10:
        return number(rng.integers(1, 7)), 0
    if form == 11:
        return str(rng.choice([f"20{number(2)}-{number(2)}-{number(2)}", f"{number(1)}.{number(1)}.{number(2)}",
                               f"{number(2)}:{number(2)}", f"{number(3)},{number(3)}", f"1{number(3)}-1{number(3)}"])), 0
    return f"{rng.choice(['password', 'token', 'key'])}={''.join(rng.choice(list('0123456789abcdef'), 18))}", 0


def training_windows(texts: list[str], n: int = TRAIN_WINDOWS, size: int = TRAIN_WINDOW,
                     seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """(n, size) character codes and tags."""
    rng = np.random.default_rng(seed)
    marked = [(t, base_spans(t)) for t in texts if t]
    marked = marked or [("the of and to in " * 40, [])]
    with_spans = [m for m in marked if m[1]] or marked
    chars = np.full((n, size), PAD, np.uint8)
    tags = np.zeros((n, size), np.uint8)
    for row in range(n):
        own = rng.random() < 0.25
        text, spans = (with_spans if own else marked)[rng.integers(0, len(with_spans if own else marked))]
        if own and spans:
            a, z, _ = spans[rng.integers(0, len(spans))]
            at = int(np.clip(rng.integers(a - size // 2, z + 8), 0, max(len(text) - 8, 0)))
        else:
            at = int(rng.integers(0, max(len(text) - size, 0) + 1))
        part = text[at:at + size]
        tag = np.zeros(len(part), np.uint8)
        for a, z, k in spans:
            if a < at + size and z > at:
                tag[max(a - at, 0):z - at] = k + 1
        if not own or rng.random() < 0.1:
            if rng.random() < 0.75:
                new, kind = _written(rng)
                free = [i for i, c in enumerate(part) if c in " \n" and not tag[i]]
                i = free[rng.integers(0, len(free))] if free else len(part)
                tag = np.concatenate([tag[:i], [0], np.full(len(new), kind), [0], tag[i + 1:]])[:size].astype(np.uint8)
                part = f"{part[:i]} {new} {part[i + 1:]}"[:size]
                tag = tag[:len(part)]
        c = codes(part)
        chars[row, :len(c)] = c
        tags[row, :len(tag)] = tag
    return chars, tags


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS,
        max_chars: int = 4000, steps: int = 300) -> Tagger:
    """Train on at most ``sample`` documents' texts (of a longer text, a piece
    of ``max_chars`` from a place given by its hash)."""
    texts = small_batches(docs).where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    h = F.xxhash64(F.col("id").cast("string"), F.length("t"))
    room = F.greatest(F.length("t") - max_chars, F.lit(0)) + 1
    rows = (hashed_sample(texts, h, sample)
            .select("h", F.substr("t", (F.pmod("h", room) + 1).cast("int"), F.lit(max_chars)).alias("t"))
            .orderBy("h").collect())
    chars, tags = training_windows([r.t for r in rows])
    return train(chars, tags, steps)


# ---------------------------------------------------------------- decoding

def plausible(text: str, kind: int) -> bool:
    """Whether a tagged stretch can be of its kind at all."""
    n = len(digits_of(text))
    if kind == 0:
        return bool(re.search(r"[A-Za-z0-9]\s*(@|[(\[ ]\s*at\s*[)\] ])\s*[A-Za-z0-9-]+\s*(\.|[(\[ ]\s*dot\s*[)\] ])\s*[A-Za-z]",
                              text))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", text))
    if kind == 2:
        return bool(re.fullmatch(r"[0-9]([ .-]?[0-9])+", text)) and 12 <= n <= 19 and luhn(digits_of(text))
    return 7 <= n <= 15 and bool(re.fullmatch(r"\+?[(0-9][ ().0-9-]+[0-9]", text)) and bool(re.search(r"[ ().-]", text))


def reconcile(spans: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int]]:
    """One document's spans out of its windows' spans.

    A span is (start, end, kind, score, cut at its left, cut at its right).
    Pieces that a window border cut are joined with touching spans of their
    kind; then the non-overlapping set of the largest total score is chosen.
    """
    joined: list[list] = []
    for s in sorted(spans):
        last = joined[-1] if joined else None
        if last and s[2] == last[2] and s[0] <= last[1] and (s[4] or last[5] or s[:2] == tuple(last[:2])):
            last[3] = max(last[3], s[3]) if s[1] <= last[1] else last[3] + s[3]
            last[5] = s[5] if s[1] >= last[1] else last[5]
            last[1] = max(last[1], s[1])
        else:
            joined.append(list(s))
    joined.sort(key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in joined]
    best = [(0.0, ())]
    for i, s in enumerate(joined):
        free = int(np.searchsorted(ends[:i], s[0], side="right"))
        take = best[free][0] + s[3]
        best.append((take, (i, free)) if take > best[i][0] else (best[i][0], None))
    out, i = [], len(joined)
    while i > 0:
        if best[i][1] is None:
            i -= 1
        else:
            j, i = best[i][1]
            out.append((joined[j][0], joined[j][1], joined[j][2]))
    return out[::-1]


def tagged_spans(texts: list[str], model: Tagger, window: int = WINDOW, overlap: int = OVERLAP,
                 min_margin: float = MIN_MARGIN) -> list[list[tuple[int, int, int]]]:
    """The tagger's reconciled spans of each whole text."""
    stride = window - overlap
    coded = [codes(t) for t in texts]
    owner, starts = [], []
    for i, c in enumerate(coded):
        if len(c):
            at = range(0, max(len(c) - overlap, 1), stride)
            owner += [i] * len(at)
            starts += at
    found: list[list] = [[] for _ in texts]
    for a in range(0, len(owner), BATCH_WINDOWS):
        own, at = owner[a:a + BATCH_WINDOWS], starts[a:a + BATCH_WINDOWS]
        chars = np.full((len(own), window), PAD, np.uint8)
        for r, (i, s) in enumerate(zip(own, at)):
            part = coded[i][s:s + window]
            chars[r, :len(part)] = part
        e = model.emissions(np.ascontiguousarray(chars.T))
        tags = model.decode(e).T
        for r in np.flatnonzero(tags.any(axis=1)):
            i, s, t = own[r], at[r], tags[r]
            size = min(window, len(coded[i]) - s)
            cuts = np.flatnonzero(np.diff(t[:size], prepend=0, append=0))
            for x, z in zip(cuts, cuts[1:]):
                k = int(t[x])
                if k:
                    margin = float((e[x:z, r, k] - e[x:z, r, 0]).mean())
                    if margin >= min_margin:
                        found[i].append((s + int(x), s + int(z), k - 1, margin * (z - x),
                                         bool(x == 0 and s > 0), bool(z == size and s + size < len(coded[i]))))
    return [reconcile(f) if f else [] for f in found]


def all_spans(texts: list[str | None], model: Tagger) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    texts = [t or "" for t in texts]
    out = []
    for text, more in zip(texts, tagged_spans(texts, model)):
        base = base_spans(text)
        held = list(base)
        for a, z, k in more:
            while a < z and text[a].isspace():
                a += 1
            while z > a and text[z - 1] in " \t\n.,;:":
                z -= 1
            if z > a and plausible(text[a:z], k) and all(z <= x or a >= y for x, y, _ in held):
                held.append((a, z, k))
        out.append((base, sorted(held, key=by_place)))
    return out


def find(docs: DataFrame, model: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (start, end, kind) of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for b in slices(batches, 2048):
            found = all_spans(b.column(1).to_pylist(), model)
            cols = [pa.array([[{"start": a, "end": z, "kind": KINDS[k]} for a, z, k in f[c]] for f in found], span)
                    for c in range(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["id", "base", "spans"])

    span = "array<struct<start:int,end:int,kind:string>>"
    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"id {kind}, base {span}, spans {span}")


def redacted(text: str | None, model: Tagger) -> str | None:
    return None if text is None else redact_texts([text], model)[0]


def redact_texts(texts: list[str | None], model: Tagger) -> list[str | None]:
    """Texts with every span replaced by its kind in brackets; overlapping
    spans become one replacement, named by the first."""
    out = []
    for text, (_, spans) in zip(texts, all_spans(texts, model)):
        if spans:
            parts, at, i = [], 0, 0
            while i < len(spans):
                a, z, k = spans[i]
                while i + 1 < len(spans) and spans[i + 1][0] < z:
                    i += 1
                    z = max(z, spans[i][1])
                parts += [text[at:a], f"[{KINDS[k].upper()}]"]
                at, i = z, i + 1
            text = "".join(parts) + text[at:]
        out.append(text)
    return out


def redact_column(text: Column, model: Tagger) -> Column:
    """The text column with personal data replaced; null stays null."""
    @F.pandas_udf("string")
    def of(texts):
        import pandas as pd
        t = [None if x is None else x for x in texts.tolist()]
        return pd.Series([r for a in range(0, len(t), 1024) for r in redact_texts(t[a:a + 1024], model)], dtype=object)
    return of(text.cast("string"))


def op1_pii_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, fit(docs))

    def named_column(c: str) -> Column:
        return F.array_join(F.transform(c, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in KINDS],
                        F.sha2(named_column("base"), 256).alias("base_sha256"), named_column("spans").alias("spans"))


QUERIES = {"op1_pii_lstm": op1_pii_lstm}
ORACLES: dict[str, str] = {}
