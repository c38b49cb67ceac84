"""Query registry: name -> Spark builder ``(spark, sf_dir) -> DataFrame`` and its DuckDB oracle."""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}   # query name -> SURVEY §2 ids it exercises


def register(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        OPERATORS[name] = ops
        return fn
    return deco
