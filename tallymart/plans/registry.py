"""Name -> (Spark query, equivalent SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query under its function's name."""

    def register(fn: QueryFn) -> QueryFn:
        key = name or fn.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key!r} is registered twice")
        REGISTRY[key] = Query(key, fn, sql)
        return fn

    return register
