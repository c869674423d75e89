"""Registration of check queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import Tables
from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None, wrap: Callable[[str], str] = with_views):
    """Register a query over ``Tables`` and, where SQL can say it, the same result in SQL."""
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, root: build(Tables(spark, root))
        if sql is not None:
            ORACLES[name] = wrap(sql)
        return build
    return register
