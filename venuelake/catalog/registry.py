"""Collects the named queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from ..stand_ins import Tables
from .oracle_tables import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with the SQL that must agree with it."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(tune(spark), sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql:
            ORACLES[name] = with_tables(sql)
        return fn

    return wrap
