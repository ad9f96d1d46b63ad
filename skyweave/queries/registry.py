"""Registered queries and their SQL twins."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with the DuckDB text it is compared against."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def minute_text(column: Column | str) -> Column:
    return F.date_format(column, "yyyyMMddHHmm")
