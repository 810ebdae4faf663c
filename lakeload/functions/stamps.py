"""Run stamps (``yyyyMMddTHHmmss[SSS]`` text) and 17-digit watermark stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 17-digit watermark layout (year to millisecond).
STAMP17_FORMAT = "yyyyMMddHHmmssSSS"


def run_date(run_ts: Column, strict: bool = True) -> Column:
    """Date of a run stamp, from its first eight characters.

    ``strict`` raises on stamps that are too short or not a date; otherwise they give NULL.
    """
    if not strict:
        return F.when(
            F.length(run_ts) >= 8, F.try_to_date(F.substring(run_ts, 1, 8), "yyyyMMdd"))
    parts = [F.substring(run_ts, pos, n).cast("int") for pos, n in ((1, 4), (5, 2), (7, 2))]
    complaint = F.concat(F.lit("run stamp '"), F.coalesce(run_ts, F.lit("NULL")),
                         F.lit("' is shorter than yyyyMMdd"))
    return F.when(F.length(run_ts) >= 8, F.make_date(*parts)).otherwise(
        F.raise_error(complaint).cast("date"))


def parse_run_date(run_ts: str) -> dt.date:
    """Driver-side twin of :func:`run_date` for one stamp."""
    if run_ts is None or len(run_ts) < 8:
        raise ValueError(f"run stamp {run_ts!r} is shorter than yyyyMMdd")
    return dt.datetime.strptime(run_ts[:8], "%Y%m%d").date()


def new_run_ts(now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%S") + f"{now.microsecond // 1000:03d}"


def stamp17(ts: Column) -> Column:
    """17-digit BIGINT of a timestamp (milliseconds truncated)."""
    return F.date_format(ts, STAMP17_FORMAT).cast("bigint")


def stamp17_to_timestamp(stamp: Column) -> Column:
    """Timestamp of a 17-digit stamp, built from its digits; NULL when it has another length."""
    s = stamp.cast("string")

    def digits(pos: int, n: int) -> Column:
        return F.substring(s, pos, n).cast("int")

    seconds = (F.substring(s, 13, 5).cast("decimal(8,0)") / F.lit(1000)).cast("decimal(8,6)")
    return F.when(
        F.length(s) == 17,
        F.make_timestamp_ntz(digits(1, 4), digits(5, 2), digits(7, 2), digits(9, 2), digits(11, 2), seconds))
