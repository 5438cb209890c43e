import re
from collections import Counter

from fundlake.llm import rules
from tests.llm.helpers import SF, documents, sf


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = Counter(zip(w, w[1:], w[2:])), set()
    for k in range(len(w) - 2):
        if seen[tuple(w[k:k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in sf(spark, "documents").collect()}
    for r in rules.op10_quality_rules(spark, SF).collect():
        assert tuple(r[c] for c in COUNTS) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.failed_rules == "")


def test_odd_rows_and_clashing_columns(spark):
    df = documents(spark)
    got = rules.apply_rules(df).collect()
    want = sorted(brute(r.text) for r in df.collect())
    assert sorted(tuple(r[c] for c in COUNTS) for r in got) == want
    assert rules.apply_rules(df.limit(0)).count() == 0


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = rules.op10_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_thresholds_compile_to_named_failures(spark):
    df = spark.createDataFrame([(1, "## $$ %% " * 40)], "doc_id long, text string")
    r = rules.apply_rules(df).first()
    assert "symbols_per_word" in r.failed_rules and not r.kept


def test_clean_labelled_documents_stay(spark):
    r = rules.op10_quality_rules(spark, SF).join(sf(spark, "labels"), "doc_id").where("not base_failed")
    good, bad = r.where("quality = 1"), r.where("quality = 0")
    assert good.where("kept").count() >= 0.97 * good.count()
    assert bad.where("kept").count() <= 0.2 * max(bad.count(), 1)
