"""The ``opN_*`` queries and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import importlib

MODULES = [
    "mixing",
    "automaton",
    "toxicity",
    "warc",
    "hostgraph",
    "syncmers",
    "embeddings",
    "suffixes",
    "pii",
    "simhash",
    "byte_bpe",
    "divergence",
    "spelling",
]


def _modules():
    return [importlib.import_module(f"weavemine.llm.{m}") for m in MODULES]


def queries() -> dict:
    return {m.NAME: m.query for m in _modules()}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.SQL for m in _modules() if getattr(m, "SQL", None)}
