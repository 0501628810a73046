"""Registered queries over the driver's tables.

Each key runs a library operator over whole tables (no id subsets, no row
caps; three keys of conversations read turns 0 to 4, see the README) and, where SQL can express it, carries an independent DuckDB oracle
computed from the base rows.  Output columns are aliased identically on
both sides and cast to bigint/double/string/boolean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[Query, str | None]] = {}


def scenario(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if key in _REGISTRY:
            raise ValueError(f"duplicate scenario {key}")
        _REGISTRY[key] = (fn, sql)
        return fn

    return deco


def _load() -> None:
    from atelier.scenarios import chat, models, plans, repair, reports, retrieval, runs, storage, text  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1]}


def sql_literal(s: str) -> str:
    """A SQL string literal (single quotes doubled)."""
    return "'" + s.replace("'", "''") + "'"
