import numpy as np

from fundlake.llm import grammar as g
from tests.llm.helpers import documents, labels

SF1 = "/root/testdata/sf0.1"          # enough toxic documents of every language to learn from


def test_held_out_accuracy(spark):
    out = g.op9_toxicity_grammar(spark, SF1).join(spark.read.parquet(f"{SF1}/labels.parquet"), "doc_id").collect()
    test = [r for r in out if r.held_out]
    assert test and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    toxic = [r.predicted for r in test if r.toxic == 1]
    clean = [r.predicted for r in test if r.toxic == 0]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.02


def total(text):
    return sum(g.Grammar().clauses(text)[0])


def test_clauses_weigh_context():
    plain = total("that was a stupid plan")
    assert total("you are a stupid clown") > total("a stupid clown") > plain > 0
    assert total("that was not a stupid plan") < plain
    assert total("they said that was a stupid plan") < plain
    assert total("you will kill them") > 0
    assert total("never. that was a stupid plan") == plain          # clauses do not reach into each other
    assert total("the of and to in") == 0


def test_composition_equals_running_the_machines_side_by_side():
    rng = np.random.default_rng(0)
    a, b = g.window(g.TARGET, 4, {g.INSULT: 1.5}), g.window(g.NEGATION, 3, {g.INSULT: 0.2, g.THREAT: 0.3})
    both = g.compose(a, b)
    for _ in range(50):
        s = sa = sb = 0
        for c in rng.integers(0, g.CLASSES, 20):
            s, f = both.arcs[s][c]
            sa, fa = a.arcs[sa][c]
            sb, fb = b.arcs[sb][c]
            assert np.isclose(f, fa * fb)


def test_sentences_rank_as_a_reader_would():
    assert total("I will kill you") > total("you kill") == total("kill") > 0
    assert total("I will kill the time, you know") == total("kill")            # the object stands in the clause
    plain = total("you idiot")
    for told in ("He said: you idiot.", "She wrote, 'you idiot'", "you idiot, he said", '"You idiot!" he said.'):
        assert 0 < total(told) < plain, told
    assert total("you idiot. he said") == total("he said. you idiot") == plain  # no rule reaches over a full stop
    assert total("no, you idiot") == plain
    assert total("he is not a liar, a clown") < total("a clown")
    assert total("you, idiot") > total("sir, idiot")
    assert g.Grammar({"kill": 4.0}).token("killing") == (g.THREAT, 4.0)


def parse(kinds):
    """The rules of each token, read off a sentence's classes by their definitions."""
    out = []
    for i, k in enumerate(kinds):
        rules = set()
        if k in (g.INSULT, g.THREAT):
            before, behind = kinds[:i], kinds[i + 1:]
            clause = before[len(before) - before[::-1].index(g.PAUSE):] if g.PAUSE in before else before
            if k == g.INSULT and g.INSULT in clause:
                rules.add("run")
            if k == g.INSULT and g.TARGET in before[-4:]:
                rules.add("aimed")
            for j in range(i):
                inner = before[j + 1:]
                if (kinds[j] == g.NEGATION and inner[:1] != [g.PAUSE] and g.NEGATION not in inner
                        and len([x for x in inner if x != g.PAUSE]) < 4):
                    rules.add("denied insult" if k == g.INSULT else "denied threat")
            if g.REPORT in before:
                rules.add("reported")
            reach = behind[:behind.index(g.PAUSE)] if g.PAUSE in behind else behind
            if k == g.THREAT and g.TARGET in reach[:3]:
                rules.add("object")
            if any(p == g.PAUSE and g.REPORT in behind[j + 1:j + 4] and g.PAUSE not in
                   behind[j + 1:j + 1 + behind[j + 1:].index(g.REPORT)] for j, p in enumerate(behind)):
                rules.add("told after")
        out.append(frozenset(rules))
    return out


def test_machines_equal_a_brute_force_parser():
    rng = np.random.default_rng(1)
    word = {g.OTHER: "table", g.INSULT: "clown", g.THREAT: "kill", g.TARGET: "you", g.NEGATION: "not",
            g.REPORT: "said", g.PAUSE: ","}
    grammar, n = g.Grammar(), 0
    for _ in range(4000):
        kinds = rng.integers(0, g.CLASSES, rng.integers(1, 14)).tolist()
        if any(a == b == g.PAUSE for a, b in zip(kinds, kinds[1:])):       # marks in a row are one
            continue
        found, _ = grammar.matches(" ".join(word[k] for k in kinds))
        got = [(w, rules) for clause in found for w, rules in clause]
        want = [(3.0, r) for k, r in zip(kinds, parse(kinds)) if k in (g.INSULT, g.THREAT)]
        assert got == want, kinds
        n += len(got)
        score = sum(w * np.prod([g.RULES[r] for r in rules]) for w, rules in want)
        assert np.isclose(sum(grammar.clauses(" ".join(word[k] for k in kinds))[0]), score)
    assert n > 4000


def test_factors_follow_the_labels():
    rng = np.random.default_rng(2)
    told, aimed, bare = frozenset(["reported"]), frozenset(["aimed"]), frozenset()
    sums, y = [], []
    for _ in range(3000):
        rules = (told, aimed, bare)[rng.integers(3)]
        sums.append({rules: 3.0})
        y.append(float(rng.random() < {told: 0.02, aimed: 0.98, bare: 0.5}[rules]))
    f = g.fit_factors(sums, np.array(y))
    assert f["reported"] < 0.3 < 1 < 2 < f["aimed"]
    assert f["denied threat"] == g.RULES["denied threat"] or np.isclose(f["denied threat"], g.RULES["denied threat"])
    turned = g.fit_factors(sums, 1 - np.array(y))                          # labels against the rules
    assert turned["reported"] <= 1 <= turned["aimed"]
    kept = g.fit_factors([{}, {}], np.array([0.0, 1.0]))
    assert all(np.isclose(kept[r], v) for r, v in g.RULES.items())


def test_one_text_of_an_id_is_learnt_from(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other")], "doc_id long, text string")
    got = g.sample(docs, labels(spark, [(1, 1, 1), (2, 1, 0)]), "toxic", "doc_id", "text").collect()
    assert sorted(r.y for r in got) == [0, 1]


def test_learnt_stems_score(spark):
    rows = [(i, "the of and zorgalb zorgath to in. the end" if i % 2 else "the of and to in. the end") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = labels(spark, [(i, 1, i % 2) for i in range(60)])
    out = {r.id: r.score for r in g.score(docs, g.fit(docs, known)).collect()}
    assert min(out[i] for i in range(61, 80, 2)) > 0.7 > 0.2 > max(out[i] for i in range(60, 80, 2))


def test_odd_rows_no_labels_and_empty_table(spark):
    df = documents(spark)
    for known in (labels(spark), labels(spark, [(1, 1, None), (None, 1, 1), (1, 1, 1), (7, 1, 0), (1, 1, 0)])):
        fitted = g.fit(df, known)
        got = g.score(df, fitted).collect()
        assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    assert g.score(df.limit(0), g.fit(df.limit(0), labels(spark))).count() == 0
