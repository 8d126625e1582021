"""Query registry: one Spark builder and, where SQL can say it, one DuckDB text per operator.

``out`` declares the result columns of both sides as ``"name:kind"`` words. Kinds: ``i`` BIGINT,
``s`` VARCHAR, ``b`` BOOLEAN, a digit = DOUBLE rounded to that many places. The same casts are put
on both sides, so the comparison sees equal types.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import tune

from . import views

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


QUERIES: dict[str, Query] = {}

# Nudge (as a share of the last kept digit) that moves exact decimal ties off the rounding edge,
# so both engines round the same way.
NUDGE = 0.0137


def _columns(out: str) -> list[tuple[str, str]]:
    return [tuple(word.rsplit(":", 1)) for word in out.split()]


def shape(df: DataFrame, out: str) -> DataFrame:
    """Select and cast the declared columns."""
    picked = []
    for name, kind in _columns(out):
        c = F.col(name)
        if kind == "i":
            c = c.cast("bigint")
        elif kind == "s":
            c = c.cast("string")
        elif kind == "b":
            c = c.cast("boolean")
        else:
            d = int(kind)
            c = F.round(c.cast("double") + F.lit(NUDGE * 10.0**-d), d)
        picked.append(c.alias(name))
    return df.select(*picked)


def shape_sql(sql: str, out: str) -> str:
    picked = []
    for name, kind in _columns(out):
        if kind == "i":
            e = f"CAST(\"{name}\" AS BIGINT)"
        elif kind == "s":
            e = f"CAST(\"{name}\" AS VARCHAR)"
        elif kind == "b":
            e = f"CAST(\"{name}\" AS BOOLEAN)"
        else:
            d = int(kind)
            e = f"round(CAST(\"{name}\" AS DOUBLE) + CAST({NUDGE * 10.0**-d!r} AS DOUBLE), {d}) + CAST(0.0 AS DOUBLE)"
        picked.append(f'{e} AS "{name}"')
    return f"SELECT {', '.join(picked)} FROM ({with_views(sql)}) AS result"


def with_views(sql: str) -> str:
    """Put the shared view definitions a text mentions in front of it."""
    body = sql.strip()
    needed: list[str] = []

    def need(text: str) -> None:
        for name, definition in views.SQL.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(definition)
                if name not in needed:
                    needed.append(name)

    need(body)
    if not needed:
        return body
    head = ", ".join(f"{name} AS ({views.SQL[name]})" for name in needed)
    if body[:4].upper() == "WITH":
        return f"WITH {head}, {body[4:]}"
    return f"WITH {head} {body}"


def query(name: str, out: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under ``name``."""

    def wrap(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shape(fn(tune(spark), sf_dir), out)

        QUERIES[name] = Query(name, run, shape_sql(sql, out) if sql else None)
        return fn

    return wrap
