"""A key that sorts rows along a space-filling curve, so that files hold narrow ranges of several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The key is one long.
KEY_BITS = 60
MOST_BITS = 8


def _number(df: DataFrame, name: str) -> Column:
    """A column as a number that sorts alike; of text and binary the first seven bytes count, other types go by hash."""
    kind, column = df.schema[name].dataType.simpleString(), F.col(f"`{name}`")
    if kind in ("string", "binary") or kind.startswith(("varchar", "char")):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column.cast("string"), "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if kind == "boolean" or kind.startswith("decimal") or kind in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        return column.cast("double")
    return F.xxhash64(column).cast("double")


def _below(bounds: list[float], value: Column) -> Column:
    """How many of ``bounds`` a value reaches; 0 for null."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= value)).cast("long")


def zorder_key(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> Column:
    """Interleaved bits of the columns' ranks among their approximate quantiles, the first column's bit ahead in each round.

    The quantiles (at most 255 a column) take one aggregation of ``df`` and are literals of the key, so skewed columns are cut
    into parts of like size. Nulls rank first, ties alike. An empty table gives a key too. At most 60 columns.
    """
    if not 1 <= len(columns) <= KEY_BITS:
        raise ValueError(f"1 to {KEY_BITS} columns, not {len(columns)}")
    bits = min(MOST_BITS, KEY_BITS // len(columns))
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    found = df.agg(*[F.percentile_approx(_number(df, c), shares, accuracy).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    key = F.lit(0).cast("long")
    for i, name in enumerate(columns):
        bounds = sorted(set(found[i] or ()))
        rank = F.lit(0).cast("long")
        if bounds:
            rank = _below(bounds, _number(df, name))
        for bit in range(bits):
            place = bit * len(columns) + len(columns) - 1 - i
            key = key + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), place)
    return key
