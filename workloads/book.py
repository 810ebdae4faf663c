"""The list of checked queries."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = (), money: tuple[str, ...] = ()):
    """Register a query; ``sql`` (after ``ctes``) is its DuckDB text, if SQL can say it.

    ``money`` columns are decimals inside the query, for their exact text, and doubles in its
    result, as in the source table.
    """

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = _with_doubles(fn, money) if money else fn
        if sql is not None:
            text = sql.strip()
            if money:
                casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money)
                text = f"SELECT * REPLACE ({casts}) FROM ({text})"
            ORACLES[name] = ("WITH " + ",".join(ctes) + "\n" if ctes else "") + text
        return fn

    return register


def _with_doubles(fn: Query, columns: tuple[str, ...]) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in columns})

    return run
