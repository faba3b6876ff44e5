"""Registered queries of the subpackage and their SQL, collected from the query modules."""

from __future__ import annotations

from scoreloom.llm import queries_chat, queries_pairs, queries_records, queries_text

MODULES = (queries_chat, queries_text, queries_pairs, queries_records)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
