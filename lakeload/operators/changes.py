"""Change detection between two states of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE, UNCHANGED = "INSERT", "UPDATE", "DELETE", "UNCHANGED"


def active_rows(silver: DataFrame, flag: str = "is_deleted") -> DataFrame:
    return silver.where(~F.coalesce(F.col(flag), F.lit(False)))


def insert_keys(new: DataFrame, old: DataFrame, keys: Sequence[str], hash_column: str = "row_hash") -> DataFrame:
    """Keys (and hash) that only the new state has."""
    return new.select(*keys, hash_column).join(old.select(*keys), list(keys), "left_anti")


def delete_keys(new: DataFrame, silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are active in silver and absent from the new state."""
    return active_rows(silver).select(*keys).join(new.select(*keys), list(keys), "left_anti")


def matched_hashes(new: DataFrame, old: DataFrame, keys: Sequence[str], hash_column: str = "row_hash") -> DataFrame:
    """Keys of both states with ``new_hash`` and ``old_hash``."""
    left = new.select(*keys, F.col(hash_column).alias("new_hash"))
    right = old.select(*keys, F.col(hash_column).alias("old_hash"))
    return left.join(right, list(keys), "inner")


def update_keys(new: DataFrame, old: DataFrame, keys: Sequence[str], hash_column: str = "row_hash") -> DataFrame:
    pairs = matched_hashes(new, old, keys, hash_column)
    return pairs.where(~F.col("new_hash").eqNullSafe(F.col("old_hash"))).select(*keys)


def unchanged_keys(new: DataFrame, old: DataFrame, keys: Sequence[str], hash_column: str = "row_hash") -> DataFrame:
    pairs = matched_hashes(new, old, keys, hash_column)
    return pairs.where(F.col("new_hash").eqNullSafe(F.col("old_hash"))).select(*keys)


def classify_changes(new: DataFrame, old: DataFrame, keys: Sequence[str],
                     hash_column: str = "row_hash") -> DataFrame:
    """Every key of either state with its ``change_type``.

    One full outer join over keys and hashes replaces the separate anti and inner joins. Which
    side is missing is told by presence flags, so rows without a hash are classified right.
    """
    for df in (new, old):
        if hash_column not in df.columns:
            raise ValueError(f"both states need the hash column {hash_column!r}")
    left = new.select(*keys, F.col(hash_column).alias("new_hash"), F.lit(True).alias("in_new"))
    right = old.select(*keys, F.col(hash_column).alias("old_hash"), F.lit(True).alias("in_old"))
    joined = left.join(right, list(keys), "full_outer")
    kind = (F.when(F.col("in_old").isNull(), INSERT)
            .when(F.col("in_new").isNull(), DELETE)
            .when(~F.col("new_hash").eqNullSafe(F.col("old_hash")), UPDATE)
            .otherwise(UNCHANGED))
    return joined.select(*keys, kind.alias("change_type"))


def change_count_columns(change_type: Column) -> list[Column]:
    return [F.count_if(change_type == kind).alias(name) for kind, name in (
        (INSERT, "inserts"), (UPDATE, "updates"), (DELETE, "deletes"), (UNCHANGED, "unchanged"))]


def change_counts(new: DataFrame, old: DataFrame, keys: Sequence[str],
                  hash_column: str = "row_hash") -> DataFrame:
    """One row: inserts, updates, deletes, unchanged."""
    changes = classify_changes(new, old, keys, hash_column)
    return changes.agg(*change_count_columns(F.col("change_type")))


def cdc_statistics(counts: DataFrame) -> DataFrame:
    """Totals and change rate for rows holding the four counts."""
    changed = F.col("inserts") + F.col("updates") + F.col("deletes")
    total = changed + F.col("unchanged")
    return counts.select(
        total.alias("total_rows"), changed.alias("total_changes"),
        "inserts", "updates", "deletes", "unchanged",
        F.when(total > 0, changed / total * 100).otherwise(F.lit(0.0)).alias("change_rate_pct"))
