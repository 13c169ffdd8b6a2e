"""Queries by name, each with the SQL it must agree with (where SQL can say it)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from wayloom.session import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _shipped(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf)

    return run


def query(name: str, *parts: str):
    """Register a query; ``parts`` are common table expressions followed by the SELECT."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = _shipped(fn)
        if parts:
            *ctes, body = parts
            ORACLES[name] = ("WITH RECURSIVE " if "RECURSIVE" in body[:12] else "WITH ") * bool(ctes) + ", ".join(
                ctes) + " " + body.replace("/*RECURSIVE*/", "")
        return fn
    return deco
