"""Queries of the corpus operators and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; it runs with the library's session settings."""

    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return fn

    return wrap
