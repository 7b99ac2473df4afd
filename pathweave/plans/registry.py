"""Registry of the named queries run by ``__spark_entry__`` and the bench.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables; the
optional oracle is DuckDB SQL over the same tables returning the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from . import tree_queries, text_queries, dataset_queries, prediction_queries, cursor_queries  # noqa: F401
