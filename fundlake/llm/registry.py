"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from fundlake.llm import bpe, centroids, chat, grammar, kernel, mixing, periodic, pii, pivots, rollup, rules, simhash, warc

MODULES = (pii, simhash, chat, mixing, pivots, kernel, rollup, bpe, grammar, rules, centroids, warc, periodic)

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
