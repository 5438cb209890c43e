"""The pipeline against a brute-force version on the smallest tables: each
stage's decisions are taken again from its own input, row by row."""

import numpy as np

import corpus_pipeline
from fundlake.llm import bpe, kernel, mixing, pii
from fundlake.llm.common import written
from tests.llm.helpers import SF, labels, sf
from tests.llm.test_bpe import reference
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages_against_brute_force(spark):
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_kernel", "simhash_near_dedup", "pii_lstm", "soft_mixing", "bpe_encode"]
    docs = sf(spark, "documents")
    known = sf(spark, "labels")

    def go(name, df):
        out = written(steps[name](spark, df, SF), f"test-{name}")
        if name != "bpe_encode":
            assert out.columns == docs.columns
        return out, sorted(out.collect(), key=lambda r: (r.doc_id, str(r)))

    before = sorted(docs.collect(), key=lambda r: r.doc_id)
    good, rows = go("quality_kernel", docs)
    model = kernel.fit(written(kernel.features(docs), "t"), known, "quality")
    score = model.score(kernel.statistics([r.text for r in before]))
    assert [r.doc_id for r in rows] == [r.doc_id for r, s in zip(before, score) if s >= kernel.ACCEPT]
    quality = {r.doc_id: r.quality for r in known.collect()}
    clean = [r.doc_id for r in before if quality.get(r.doc_id) == 1]
    assert np.mean([i in {r.doc_id for r in rows} for i in clean]) >= 0.95

    single, kept = go("simhash_near_dedup", good)
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    assert [r.doc_id for r in kept] == sorted(set(brute_components(fps)))

    safe, red = go("pii_lstm", single)
    tagger = pii.fit(single)
    assert [r.text for r in red] == pii.redact_texts([r.text for r in kept], tagger)
    assert all(r.n_chars == len(r.text) for r in red)

    mixed, used = go("soft_mixing", safe)
    mixer, _ = mixing.fit(safe, mixing.language_labels(safe, known), mixing.TARGETS)
    x, _ = mixing.byte_pairs([r.text for r in red])
    rate = dict(zip((r.doc_id for r in red), mixer.rates(mixer.posteriors(x))))
    times = {i: sum(r.doc_id == i for r in used) for i in rate}
    assert all(np.floor(rate[i]) <= times[i] <= np.floor(rate[i]) + 1 for i in rate)

    _, coded = go("bpe_encode", mixed)
    assert [(r.doc_id, list(r.ids)) for r in coded] == sorted((r.doc_id, reference(r.text)[0]) for r in used)
    assert all(r.n_tokens == len(r.ids) for r in coded)


def test_empty_documents_pass_through(spark):
    docs = sf(spark, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0
    assert docs.columns == ["doc_id", "n_tokens", "ids"]
