"""Registered queries and the SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame with its SQL, if there is one."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def r6(c: str | Column) -> Column:
    """Six decimals, as sums of doubles depend on the order of rows; the small addend keeps exact halves from falling either way."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 6)
