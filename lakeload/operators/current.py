"""Current state of a table from its load history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOAD_COLUMN = "_bronze_load_ts"


def loads_until(history: DataFrame, run_ts: str | None, after: str | None = None,
                load_column: str = LOAD_COLUMN) -> DataFrame:
    """Loads up to and including ``run_ts`` (and later than ``after``). On a table partitioned
    by the load stamp this prunes partitions."""
    if run_ts is not None:
        history = history.where(F.col(load_column) <= run_ts)
    if after is not None:
        history = history.where(F.col(load_column) > after)
    return history


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                rank_column: str | None = None) -> DataFrame:
    """The first ``n`` rows per key in the given order.

    Written as a filtered ``row_number`` because Spark then ranks twice: each map task keeps
    only its own best ``n`` rows per key before the shuffle. A key that holds a third of the
    table so reaches its reducer as (map tasks x n) rows, not as the whole group.
    """
    rank = rank_column or "_rank"
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
    return ranked if rank_column else ranked.drop(rank)


def latest_versions(history: DataFrame, keys: Sequence[str], run_ts: str | None = None,
                    tie_breakers: Sequence[Column] = (), load_column: str = LOAD_COLUMN) -> DataFrame:
    """One row per business key: its newest load, optionally as of ``run_ts``.

    ``tie_breakers`` decide between versions of one load; without them the choice is arbitrary,
    so callers should pass the incremental column and a row hash.
    """
    order = [F.col(load_column).desc(), *tie_breakers]
    return latest_rows(loads_until(history, run_ts, load_column=load_column), keys, order)
