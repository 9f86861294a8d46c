"""Every operator of this subpackage as a query over whole tables, with the SQL that checks it."""

from __future__ import annotations

from reviewmill.llm import (
    bpe,
    class_lm,
    debruijn,
    exact_dedup,
    fill_middle,
    html_text,
    line_dedup,
    minhash,
    mixing,
    quality,
    spelling,
    token_counts,
    url_reputation,
)

MODULES = [
    line_dedup, bpe, mixing, quality, minhash, url_reputation, html_text, token_counts, class_lm,
    exact_dedup, debruijn, fill_middle, spelling,
]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
