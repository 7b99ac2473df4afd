"""Queries and oracles of this package; filled by the modules that load_all imports."""

from __future__ import annotations

import functools
from collections.abc import Callable

from .common import ship_code

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def query(spark, sf_dir):
            ship_code(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    from . import queries  # noqa: F401
