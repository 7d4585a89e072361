"""Query catalogue: a Spark callable per key and, where one exists, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return add


def r6(column: Column | str) -> Column:
    """Six decimals, the precision at which results are compared."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: r6(name) for name in names})
