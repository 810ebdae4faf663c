"""Rewrite data with a row hash added."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakeload.operators.rowhash import add_row_hash
from lakeload.sources import bronze
from lakeload.sources.tables import quoted


def hash_parquet(spark: SparkSession, source_path: str, target_path: str, mode: str = "overwrite", **options) -> None:
    """Read parquet files, add a row hash, write them to another path. One narrow pass."""
    if source_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("the hashed copy needs a path of its own")
    add_row_hash(spark.read.parquet(source_path), **options).write.mode(mode).parquet(target_path)


def hash_table(spark: SparkSession, table: str, run_ts: str, target: str | None = None, **options) -> int:
    """Add a row hash to a table (or to a copy of it); returns its rows. The table becomes a
    view on its hashed version."""
    hashed = add_row_hash(spark.table(quoted(table)), **options)
    return bronze.write_snapshot(spark, target or table, hashed, run_ts)
