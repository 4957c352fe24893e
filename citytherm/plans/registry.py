"""Name -> query callable, and name -> DuckDB SQL of the same query."""

from __future__ import annotations

REGISTRY: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its SQL."""
    def deco(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
