"""Registry of all queries (Spark callables) and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pawprint.plans import queries as _q


def _load() -> None:
    # Importing the modules registers their queries.
    from pawprint.plans import learn_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_q.REGISTRY)


def oracle_sql() -> dict[str, str]:
    from pawprint.plans.oracle import positive_zero
    _load()
    return {name: positive_zero(sql) for name, sql in _q.ORACLE.items()}
