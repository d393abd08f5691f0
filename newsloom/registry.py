"""Registered queries and their DuckDB oracle SQL.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, sql | None)``.
Every query reads the landed tables (or data Spark derives from them) in
whole; results are passed through :func:`newsloom.checkout.comparable`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsloom.checkout import comparable, sql_arr, sql_day, sql_ts

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = (run, sql)
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}


_loaded = False


def _load() -> None:
    global _loaded
    if _loaded:
        return
    _loaded = True
    from newsloom import registered  # noqa: F401  (registers on import)


__all__ = ["register", "queries", "oracle_sql", "sql_arr", "sql_day", "sql_ts"]
