"""Row hashing over a chosen set of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.functions import hashing

# Names that mark load metadata.
BUSINESS_EXCLUDED_PREFIXES = ("_bronze_", "_silver_", "_metadata_")
HASH_EXCLUDED_PREFIXES = ("_bronze_", "_silver_", "_load_", "_metadata_")
DATE_TYPES = ("date", "timestamp", "timestamp_ntz")


def business_columns(df: DataFrame) -> list[str]:
    """Columns that carry business data, in table order."""
    return [c for c in df.columns if not c.startswith(BUSINESS_EXCLUDED_PREFIXES)]


def choose_hash_columns(columns: Sequence[str], include: Sequence[str] | None = None,
                        exclude: Sequence[str] | None = None) -> list[str]:
    """Sorted hash columns: ``include`` (default all) without ``exclude``."""
    for role, names in (("include", include), ("exclude", exclude)):
        unknown = sorted(set(names or ()) - set(columns))
        if unknown:
            raise ValueError(f"{role} names unknown columns: {unknown}")
    chosen = sorted(set(columns if include is None else include) - set(exclude or ()))
    if not chosen:
        raise ValueError("no column is left to hash")
    return chosen


def add_row_hash(df: DataFrame, hash_column: str = "row_hash", include_cols: Sequence[str] | None = None,
                 exclude_cols: Sequence[str] | None = None, null_token: str = hashing.NULL_TOKEN,
                 separator: str = hashing.SEPARATOR, hash_algorithm: str = "sha256") -> DataFrame:
    """Add the hex digest of the chosen columns. A narrow, code-generated projection."""
    if hash_column in df.columns:
        raise ValueError(f"column {hash_column!r} exists already")
    columns = choose_hash_columns(df.columns, include_cols, exclude_cols)
    return df.withColumn(hash_column, hashing.row_hash(columns, null_token, separator, hash_algorithm))


def add_row_hash_partitioned(df: DataFrame, business_keys: Sequence[str], **options) -> DataFrame:
    """Row hash on data laid out by business key.

    Rows of a key come together as far as partitions of a sensible size allow: one key with a
    third of the rows is spread over several.
    """
    return add_row_hash(df.hint("rebalance", *[F.col(k) for k in business_keys]), **options)


def add_business_hash(df: DataFrame, hash_column: str = "row_hash", **options) -> DataFrame:
    """Row hash without load metadata; business keys stay part of it."""
    exclude = [c for c in df.columns if c.startswith(HASH_EXCLUDED_PREFIXES)]
    return add_row_hash(df, hash_column, exclude_cols=exclude, **options)


def add_incremental_hash(df: DataFrame, exclude_timestamp_cols: bool = True,
                         hash_column: str = "row_hash", **options) -> DataFrame:
    """Row hash that can ignore audit dates, so a touched date alone is no update."""
    exclude = [c for c, t in df.dtypes if exclude_timestamp_cols and t in DATE_TYPES]
    return add_row_hash(df, hash_column, exclude_cols=exclude, **options)


def hash_quality(df: DataFrame, hash_column: str = "row_hash") -> DataFrame:
    """One row describing a hash column: rows, NULLs, and hashes of an impossible length."""
    length = F.length(hash_column)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(hash_column).isNull()).alias("null_hashes"),
        F.count_if(~length.isin(*hashing.HASH_LENGTHS)).alias("bad_lengths"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
    )


def hash_sample(df: DataFrame, rows: int, hash_column: str = "row_hash") -> DataFrame:
    """The ``rows`` rows of smallest hash: a bounded look that is the same on every run. Rows without a hash come first."""
    return df.orderBy(F.col(hash_column).asc_nulls_first()).limit(rows)


def validate_hash_columns(df: DataFrame, hash_column: str = "row_hash",
                          expected_columns: Sequence[str] | None = None,
                          max_rows: int | None = None) -> bool:
    """True when the hash column is sound, otherwise ValueError. One aggregate over all rows
    (or over the ``max_rows`` of smallest hash, when a bounded look is asked for)."""
    missing = [c for c in [hash_column, *(expected_columns or ())] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    kind = dict(df.dtypes)[hash_column]
    if kind != "string":
        raise ValueError(f"hash column {hash_column!r} is {kind}, not string")
    facts = hash_quality(hash_sample(df, max_rows, hash_column) if max_rows is not None else df, hash_column).first()
    if facts.total_rows == 0:
        raise ValueError("nothing to validate: no rows")
    if facts.null_hashes:
        raise ValueError(f"{facts.null_hashes} rows have no hash")
    if facts.bad_lengths:
        raise ValueError(f"{facts.bad_lengths} hashes are not {hashing.HASH_LENGTHS} characters long")
    return True
