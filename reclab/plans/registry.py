"""The registered query set: Spark builders and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None):
    """Decorator: register ``fn`` under its name, with oracle SQL if SQL can
    express the result (else the driver checks rows only)."""
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


def load_all():
    from reclab.plans import catalog, contracts, extensions, indexed, logs, oracle, updates  # noqa: F401

    for name, sql in oracle.ORACLE.items():
        ORACLE.setdefault(name, sql)
    return QUERIES, ORACLE
