"""Row-hash expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hashes must be comparable with tables hashed elsewhere.
NULL_TOKEN = "∅"
SEPARATOR = "|"
# Recommended for new tables: cannot occur in ordinary text, so ('a|b','c') <> ('a','b|c').
UNIT_SEPARATOR = "\x1f"
ALGORITHMS = ("sha256", "md5")
HASH_LENGTHS = (32, 64)


def hash_text(columns: Iterable[str], null_token: str = NULL_TOKEN, separator: str = SEPARATOR) -> Column:
    """The text a row hash is computed over; columns in the order given."""
    parts = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(null_token)) for name in columns]
    return F.concat_ws(separator, *parts)


def row_hash(columns: Iterable[str], null_token: str = NULL_TOKEN, separator: str = SEPARATOR,
             algorithm: str = "sha256") -> Column:
    """Hex digest of the given columns."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown hash algorithm {algorithm!r}; choose one of {ALGORITHMS}")
    text = hash_text(columns, null_token, separator)
    return F.md5(text) if algorithm == "md5" else F.sha2(text, 256)
