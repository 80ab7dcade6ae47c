"""Queries of the corpus operators, by name, and their DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ["quality_rules", "line_dedup", "mixing", "ngram_join", "packing", "chat", "pii", "language", "media", "classifier"]

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"tidemark.llm.{_name}")
    QUERIES[_module.QUERY] = _module.query
    if _module.ORACLE_SQL:
        ORACLE[_module.QUERY] = _module.ORACLE_SQL
