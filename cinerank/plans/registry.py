"""Registry of named queries: Spark builder + optional oracle SQL.

A query takes (spark, sf_dir) and returns a DataFrame; its oracle is SQL
that DuckDB runs over the raw tables (views inlined with ``with_views``).
Queries without an oracle are checked by row count and by own tests.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from cinerank.plans import (  # noqa: F401
        q_cf, q_stats, q_prep, q_content, q_text, q_binary, q_split, q_factor, q_io, q_parts)
