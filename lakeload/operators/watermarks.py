"""High-water marks: newest value per table, comparison with the stored map, and the row
filters built on them."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
MATCH, NEW, UPDATE = "MATCH", "NEW", "UPDATE"
KINDS = {"stamp17": "bigint", "datetime": "timestamp_ntz", "date": "date", "double": "double", "number": "string", "text": "string"}


def as_kind(value: Column, kind: str) -> Column:
    """A stored (text) watermark in the type it is compared in."""
    return value.cast(KINDS[_known(kind)])


def _known(kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"unknown watermark kind {kind!r}; one of {sorted(KINDS)}")
    return kind


def number_key(value: Column) -> Column:
    """Text that sorts as the decimal number written in ``value`` does, of any sign, length and scale.

    A sign digit, the whole part padded to 40 digits, and the fraction without its last zeros. Below zero the digits
    are complemented and end in a character above all digits, so that a longer fraction sorts lower. NULL where the
    text is no plain number of up to 40 whole digits.
    """
    digits = F.regexp_replace(value, "^[+-]", "")
    whole = F.lpad(F.regexp_replace(F.substring_index(digits, ".", 1), "^0+", ""), 40, "0")
    point = F.instr(digits, ".")
    fraction = F.when(point > 0, F.regexp_replace(F.substr(digits, point + 1), "0+$", "")).otherwise("")
    text = F.concat(whole, F.lit("."), fraction)
    below = F.concat(F.lit("0"), F.translate(text, "0123456789", "9876543210"), F.lit("~"))
    key = F.when(value.startswith("-") & text.rlike("[1-9]"), below).otherwise(F.concat(F.lit("1"), text))
    return F.when(value.rlike(r"^[+-]?0*[0-9]{1,40}(\.[0-9]*)?$"), key)


def _max_of_kind(mark: Column, kind: str, here: Column) -> Column:
    """The largest mark of a kind, as text, over the rows ``here``."""
    if kind != "number":
        return F.max(F.when(here, as_kind(mark, kind))).cast("string")
    key = F.when(here & mark.isNotNull(), F.coalesce(number_key(mark), F.raise_error(F.concat(F.lit("not a number: "), mark))))
    return F.max_by(mark, key)


def _above(old: str, new: str, kind: str) -> Column:
    if kind == "number":
        return number_key(F.col(old)) > number_key(F.col(new))
    return F.col(old).try_cast(KINDS[kind]) > as_kind(F.col(new), kind)


def max_watermarks(updates: DataFrame, kind: str | Mapping[str, str] | None = None,
                   keys: Sequence[str] = ("table_name",), value: str = "watermark") -> DataFrame:
    """Newest non-empty watermark per table, as text.

    Values are compared in the type of ``kind``, so that '9' sorts before '10': one kind for all
    tables, or a mapping from table name to kind. What that leaves open is the ``kind`` column's
    to say where ``updates`` has one, and else the type of the values. Partial maxima are built per map task,
    so one busy table does not load one reducer.
    """
    mark = F.col(value)
    if dict(updates.dtypes)[value] == "string":
        mark = F.when(mark != "", mark)
    if isinstance(kind, str):
        newest = _max_of_kind(mark.cast("string") if kind == "number" else mark, _known(kind), F.lit(True))
    elif kind or "kind" in updates.columns:
        own = F.col("kind") if "kind" in updates.columns else F.lit("text")
        if kind:
            given = F.create_map(*[F.lit(x) for pair in sorted(kind.items()) for x in pair])
            own = F.coalesce(given[F.col("table_name")], own)
        newest = F.coalesce(*[_max_of_kind(mark.cast("string"), k, own == k) for k in KINDS])
    else:
        newest = F.max(mark).cast("string")
    return updates.groupBy(*keys).agg(newest.alias(value)).where(F.col(value).isNotNull())


def compare_watermarks(stored: DataFrame, newest: DataFrame, keys: Sequence[str] = ("table_name",),
                       value: str = "watermark") -> DataFrame:
    """Each updated table with old and new value and MATCH, NEW or UPDATE."""
    old = stored.select(*keys, F.col(value).alias("old_watermark"))
    new = newest.select(*keys, F.col(value).alias("new_watermark"))
    status = (F.when(F.col("old_watermark").eqNullSafe(F.col("new_watermark")), MATCH)
              .when(F.col("old_watermark").isNull(), NEW)
              .otherwise(UPDATE))
    return new.join(old, list(keys), "left").select(*keys, "old_watermark", "new_watermark", status.alias("status"))


def merged_watermarks(stored: DataFrame, newest: DataFrame, keys: Sequence[str] = ("table_name",),
                      value: str = "watermark",
                      monotonic_kind: str | Mapping[str, str] | None = None) -> DataFrame:
    """The stored map after the updates; tables without an update keep their value.

    ``monotonic_kind``, one kind or a mapping from table name to kind (``text`` if not in it), keeps the larger
    value instead, so a mark never moves back. A stored value that is not of the kind gives way.
    """
    old = stored.select(*keys, F.col(value).alias("_old"))
    new = newest.select(*keys, F.col(value).alias("_new"))
    merged = F.coalesce("_new", "_old")
    if monotonic_kind is not None:
        # Marks of tables without an update may be of another kind; they are not compared.
        if isinstance(monotonic_kind, str):
            older = _above("_old", "_new", monotonic_kind)
        else:
            given = [F.lit(x) for pair in sorted(monotonic_kind.items()) for x in pair]
            own = F.coalesce(F.create_map(*given)[F.col("table_name")], F.lit("text")) if given else F.lit("text")
            older = F.coalesce(*[F.when(own == k, _above("_old", "_new", k)) for k in KINDS])
        merged = (F.when(F.col("_new").isNull() | F.col("_old").isNull(), merged)
                  .when(older, F.col("_old")).otherwise(merged))
    return old.join(new, list(keys), "full_outer").select(*keys, merged.alias(value))


def incremental_filter(df: DataFrame, column: str, kind: str, watermark: str | int | None) -> DataFrame:
    """Rows beyond the stored watermark; all rows when there is none yet. The bound is a
    literal of the column's type, so it reaches the file scan; a number keeps its own scale."""
    if watermark is None or watermark == "":
        return df
    if kind == "number":
        return df.where(F.col(column) > F.lit(decimal.Decimal(str(watermark))))
    return df.where(F.col(column) > as_kind(F.lit(str(watermark)), kind))


def lookback_start(run_day: dt.date | Column, months: int, late_months: int = 0) -> Column:
    day = F.lit(run_day) if isinstance(run_day, dt.date) else run_day
    return F.add_months(F.trunc(day, "MM"), -(months + late_months))


def lookback_filter(df: DataFrame, column: str, run_day: dt.date, months: int,
                    late_months: int = 0) -> DataFrame:
    """Rows of the last ``months`` calendar months before the run's month, and that month;
    ``late_months`` widens the window for facts that arrive late."""
    start = lookback_start(run_day, months, late_months)
    return df.where(F.col(column) >= start.cast(dict(df.dtypes)[column]))
