import random
import re

import numpy as np
import pytest

from fundlake.llm import pii, tagger
from tests.llm.helpers import SF, documents, sf

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, text):
    d = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return 12 <= len(d) <= 19 and s % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    found = [(m.start(), m.end(), k) for k, p in enumerate(PATTERNS.values())
             for m in re.finditer(p, text or "") if good(tagger.KINDS[k], m.group())]
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_one_start_is_listed_by_kind():
    assert pii.named(pii.base_spans("4111111111111111@x.com")) == "email:0:22,card:0:16"


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(sf(spark, "documents"), steps=250)


def test_base_spans_equal_the_patterns():
    rnd = random.Random(6)
    parts = ["a", "@", ".", "b-c", "1", "23", "255", "256", "+", "-", " ", "(", ")", "4111111111111111", "x.y@z.co",
             "10.2.3.4", "+1 (244) 555-4688", "\n", "é", "0", "4111 1111-1111 1111", "%", "_", "00000001"]
    for _ in range(20_000):
        t = "".join(rnd.choices(parts, k=rnd.randint(0, 12)))
        assert pii.base_spans(t) == brute(t), t


def test_long_runs_stay_linear():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "a@" * 50_000, "+1" * 50_000, "- " * 90_000):
        pii.base_spans(t)


def test_gradient_is_right():
    rng = np.random.default_rng(0)
    m = tagger.Tagger.new(4)
    for k, v in list(vars(m).items()):
        setattr(m, k, v.astype(np.float64))
    chars, tags = rng.integers(0, 100, (6, 3)).astype(np.uint8), rng.integers(0, tagger.TAGS, (6, 3))
    _, grads = m.gradient(chars, tags)
    off = 0
    for p, g in zip(m.params(), grads):
        flat, at = p.reshape(-1), rng.integers(0, p.size, 12)
        for i in at:
            old, eps = flat[i], 1e-2
            flat[i] = old + eps
            up = m.gradient(chars, tags)[0]
            flat[i] = old - eps
            down = m.gradient(chars, tags)[0]
            flat[i] = old
            off += abs((up - down) / (2 * eps) - g.reshape(-1)[i]) > 0.02
    assert off <= 3                       # a clip may switch inside the step


def test_pruned_decoding_equals_full_search():
    rng = np.random.default_rng(1)
    m = tagger.Tagger.new(4)
    m.trans[:] = rng.normal(size=m.trans.shape)
    e = rng.normal(size=(7, 40, tagger.TAGS)).astype(np.float32) + 4 * (np.arange(tagger.TAGS) == 0)
    got = m.decode(e)

    def value(path, n):
        return m.first[path[0]] + sum(e[t, n, k] for t, k in enumerate(path)) + sum(
            m.trans[a, b] for a, b in zip(path, path[1:]))
    for n in range(40):
        best = e[0, n] + m.first
        for t in range(1, 7):
            best = (best[:, None] + m.trans).max(axis=0) + e[t, n]
        assert np.isclose(value(got[:, n], n), best.max(), atol=1e-3)


def test_whole_table(spark):
    out = {r.doc_id: r for r in pii.op1_pii_lstm(spark, SF).collect()}
    import hashlib
    for r in sf(spark, "documents").collect():
        base = brute(r.text)
        o = out[r.doc_id]
        assert [o[f"n_{k}"] for k in tagger.KINDS] == [sum(s[2] == k for s in base) for k in range(4)]
        assert o.base_sha256 == hashlib.sha256(pii.named(base).encode()).hexdigest()
        assert set(pii.named(base).split(",")) <= set(o.spans.split(","))


def test_tagger_adds_spans_the_patterns_miss(model):
    t = "the of and to (555) 234-9876 in thion er. write to joe.smith (at) example.com now and the of"
    assert pii.base_spans(t) == []
    found = [(t[a:z], tagger.KINDS[k]) for a, z, k in pii.all_spans([t], model)[0][1]]
    assert ("(555) 234-9876", "phone") in found and ("joe.smith (at) example.com", "email") in found


def test_windows_do_not_matter_to_spans(model):
    t = ("the of and to in " * 40 + "10.20.30.40 thion +1 (244) 555-4688 er ").strip() * 5
    whole = pii.all_spans([t], model)[0]
    assert whole[0] and pii.reconcile([]) == []
    for a, z, k in whole[0]:
        assert (a, z, k) in whole[1]


def test_reconcile_joins_cut_pieces_and_drops_overlaps():
    cut = [(90, 100, 0, 5.0, False, True), (96, 120, 0, 9.0, True, False)]
    assert pii.reconcile(cut) == [(90, 120, 0)]
    rival = [(0, 10, 1, 3.0, False, False), (5, 20, 3, 4.0, False, False), (20, 30, 2, 1.0, False, False)]
    assert pii.reconcile(rival) == [(5, 20, 3), (20, 30, 2)]


def test_odd_rows_redaction_and_empty_table(spark, model):
    df = documents(spark, [(1, "mail a.b@c.de and 10.2.3.4"), (1, "mail a.b@c.de and 10.2.3.4"), (2, None), (3, ""),
                           (None, "+1 (244) 555-4688"), (4, "x " * 40_000 + "a@b.co")])
    got = sorted(((r.id, len(r.base)) for r in pii.find(df, model).collect()), key=str)
    assert got == sorted([(1, 2), (1, 2), (2, 0), (3, 0), (None, 1), (4, 1)], key=str)
    red = df.withColumn("text", pii.redact_column(df.text, model)).collect()
    texts = {r.doc_id: r.text for r in red}
    assert texts[1] == "mail [EMAIL] and [IP]" and texts[2] is None and texts[3] == "" and texts[None] == "[PHONE]"
    assert texts[4].endswith("[EMAIL]")
    assert pii.find(df.limit(0), pii.fit(df.limit(0), steps=2)).count() == 0
