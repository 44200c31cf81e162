"""Query catalogue: key -> (Spark query, DuckDB oracle SQL or None).

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame that reads
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, Callable[[], str]] = {}


def register(key: str, sql: Callable[[], str] | str | None = None):
    """Register a query; ``sql`` is its DuckDB twin (omit for rows-only checks)."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql if callable(sql) else (lambda s=sql: s)
        return fn
    return deco


def load_all() -> None:
    """Import every query module so its ``register`` calls run."""
    from homeledger.plans import (  # noqa: F401
        q_clean,
        q_quality,
        q_features,
        q_model,
        q_score,
        q_review,
        q_sources,
    )


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return {k: f() for k, f in ORACLE.items()}
