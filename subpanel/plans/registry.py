"""Name → (Spark query, DuckDB oracle) registry used by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all():
    """Import every plan module so its registrations run."""
    from . import (  # noqa: F401
        q_churn, q_cluster, q_density, q_extra, q_fitted, q_models, q_quality, q_revenue, q_scores, q_stats,
        q_store,
    )
    return QUERIES, ORACLES
