"""Query registry: one ``(spark, sf_dir) -> DataFrame`` callable per operator,
plus the equivalent DuckDB SQL when the result is expressible in SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco
