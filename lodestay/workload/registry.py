"""The registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``function(spark, sf_dir)``; without ``sql`` only its rows can be checked."""

    def register(function):
        @wraps(function)
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        QUERIES[name] = tuned
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register


def rounded(column: str | Column, name: str | None = None, digits: int = 6) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value.cast("double"), digits).alias(name or column)
