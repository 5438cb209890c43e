"""Quality rules: a threshold table compiled into one Spark projection.

Every figure is a built-in expression over the whole text; no user function
runs.  The table ``RULES`` names a ratio with its lowest and highest allowed
value; ``compile_rules`` turns it into one boolean column and one column that
names the failed rules.

Defined cases: a null text has no words, no lines and no symbols (0 in every
count) and fails on length; an empty or blank text likewise.  Rows are
independent, so repeated rows and null ids give the same figures again.  Very
long texts are measured whole; an empty table gives no rows.  Extra
columns of the input, whatever their names, are not read or returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import SPACE_CLASS, let, table

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with",
    "be", "by", "on", "are", "this", "at", "from", "or", "an", "not", "have",
    "der", "die", "das", "und", "von", "zu", "mit", "den", "ist", "für", "auf", "im",
    "nicht", "ein", "eine", "des", "dem", "sich",
    "le", "la", "les", "de", "et", "un", "une", "du", "que", "en", "est", "pour", "dans",
    "qui", "par", "sur", "pas", "avec", "au", "il",
    "el", "los", "las", "y", "se", "del", "con", "no", "es", "una", "su", "para", "lo", "al",
)

# Matched as written, so that no word is lower-cased in the hot loop.
STOP_FORMS = tuple(dict.fromkeys(f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())))
WORD_CHAR = "[^\\x20\\x09-\\x0D]"

# (ratio, lowest allowed, highest allowed); None: no limit on that side.
RULES = (
    ("n_words", 50, None),
    ("mean_word_chars", 2.0, 14.0),
    ("symbols_per_word", None, 0.25),
    ("stop_word_share", 0.06, None),
    ("dup_line_share", None, 0.5),
    ("mean_line_chars", 8.0, None),
)

BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PCT = 50


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_CLASS), "")


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur at least twice.

    The windows' 64-bit hashes are sorted with their positions; equal
    neighbours are repeats; the covered words are the union of [p, p + 3)
    over the repeats' positions.  O(n log n) in one row's words, so a very
    long text costs no more per word than a short one.  When no hash occurs
    twice, which a hash set tells, nothing is sorted.
    """
    n = F.size(words)
    hashes = let(words, lambda w: F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))

    def covered(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        places = let(order, lambda s: F.filter(
            F.transform(s, lambda e, i: F.when(
                (F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"]), e["p"])),
            lambda p: p.isNotNull()))
        return let(F.sort_array(places), lambda p: F.aggregate(
            p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"),
                                    x.alias("last")))["n"])

    return F.when(n < 4, F.lit(0)).otherwise(let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def measures(text: Column) -> dict[str, Column]:
    """Name -> expression of the counts taken from one text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR))
    n_symbols = F.length(F.regexp_replace(t, "[^#*$%&|<>]+", ""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.filter(w, lambda x: x.isin(*STOP_FORMS))).cast("long").alias("n_stop_words"),
            _repeat_words(w).cast("long").alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.length(F.array_join(x, "")).cast("long").alias("line_chars"))

    return {
        "_w": let(_words(t), of_words), "_l": let(lines, of_lines),
        "n_symbols": n_symbols.cast("long"),
    }


def ratios() -> dict[str, Column]:
    """Name -> expression of each ratio over the measured columns."""
    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "n_words": F.col("n_words"),
        "mean_word_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "stop_word_share": per("n_stop_words", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "mean_line_chars": per("line_chars", "n_lines"),
    }


def compile_rules(rules=RULES) -> tuple[Column, Column]:
    """(all rules hold, names of the failed rules) over the measured columns."""
    value = ratios()
    tests = []
    for name, low, high in rules:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (value[name] < low)
        if high is not None:
            bad = bad | (value[name] > high)
        tests.append((name, bad))
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in tests]))
    ok = F.lit(True)
    for _, bad in tests:
        ok = ok & ~bad
    return ok, failed


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rules=RULES) -> DataFrame:
    """One row per document: its id, the counts, ``base_failed``, ``kept`` and
    ``failed_rules``."""
    m = measures(F.col(text_col))
    counted = docs.select(F.col(id_col), *[c.alias(n) for n, c in m.items()]).select(
        F.col(id_col), "_w.*", "n_symbols", "_l.*")
    ok, failed = compile_rules(rules)
    base = ((F.col("n_words") < BASE_MIN_WORDS)
            | (100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PCT * F.col("n_words")))
    return counted.withColumn("base_failed", base).withColumns(
        {"kept": ~F.col("base_failed") & ok, "failed_rules": failed})


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept",
                      F.concat_ws(",", "failed_rules").alias("failed_rules"))


QUERIES = {"op10_quality_rules": op10_quality_rules}

_W = r"[^\x20\x09-\x0D]"
_SQL_RATIOS = {
    "n_words": "n_words", "mean_word_chars": "coalesce(word_chars / nullif(n_words, 0), 0)",
    "symbols_per_word": "coalesce(n_symbols / nullif(n_words, 0), 0)",
    "stop_word_share": "coalesce(n_stop / nullif(n_words, 0), 0)",
    "dup_line_share": "coalesce(n_dup_lines / nullif(n_lines, 0), 0)",
    "mean_line_chars": "coalesce(line_chars / nullif(n_lines, 0), 0)",
}
_SQL_FAILED = ", ".join(
    f"CASE WHEN {' OR '.join(t for t in (low is not None and f'{_SQL_RATIOS[n]} < {low}', high is not None and f'{_SQL_RATIOS[n]} > {high}') if t)} THEN '{n}' END"
    for n, low, high in RULES)
_STOPS = ", ".join(f"'{w}'" for w in STOP_FORMS)
_ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{_W}+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS l FROM d),
windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop, len(l) AS n_lines,
             len(array_to_string(l, '')) AS line_chars
      FROM w LEFT JOIN covered USING (rid)),
f AS (SELECT *, n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MAX_REPEAT_PCT} * n_words AS base_failed,
             concat_ws(',', {_SQL_FAILED}) AS failed_rules FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f
"""
ORACLES = {"op10_quality_rules": _ORACLE}
