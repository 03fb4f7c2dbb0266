"""Registered queries of the reference's own operators and their SQL."""

from __future__ import annotations

MODULES = ("search_queries", "table_queries", "more_queries", "text_queries", "state_queries", "measure_queries", "split_queries")
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) function, with the DuckDB SQL for the same rows where there is one."""

    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def _load() -> None:
    import importlib

    for name in MODULES:
        importlib.import_module(f"weavemine.plans.{name}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
