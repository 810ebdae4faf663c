"""Merge one bronze table into its silver table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.stamps import parse_run_date
from lakeload.operators import merge
from lakeload.operators.current import LOAD_COLUMN, loads_until
from lakeload.operators.runlog import FAILED, SKIPPED, SUCCESS
from lakeload.plans.bronze import MESSAGE_LIMIT, utc_now
from lakeload.plans.spec import TableSpec
from lakeload.schemas import LOG_SCHEMAS, SILVER_LOG
from lakeload.sources import bronze, covered, histories, versioned
from lakeload.sources.tables import described, folder_bytes, is_view, quoted, table_bytes, table_exists

# Fixed value: message that readers of the log look for.
NO_KEYS = "Business keys not defined in table config"
REJECTED_SUFFIX = "__rejected"
# Property of a silver version: when its bronze table was created.
STARTED = "lakeload.bronze_started"


def merge_table(spark: SparkSession, spec: TableSpec, source: str, run_id: str, run_ts: str,
                delete_modes: Sequence[str] = ("incremental",), only_new_loads: bool | None = None) -> dict:
    """Merge the current bronze state into silver; the outcome is the returned log record.

    Soft deletes are applied for the load modes in ``delete_modes`` and for tables that ask for
    ``sync_deletes``.

    Silver versions build on each other. Repeating a run that later runs were built on merges
    those again, in order, each from bronze as it was at its run; readers see the newest run
    throughout.

    Of a load history a merge reads just the runs after the version it builds on, so its cost is
    that of the new runs. It reads the whole history when the files of earlier runs are not those
    that version covers (see ``sources.covered``): an older run was committed or rewritten since, or
    the history was started over. ``only_new_loads`` decides otherwise: False always reads
    everything, True never does.
    """
    started = utc_now()
    record = dict.fromkeys(LOG_SCHEMAS[SILVER_LOG].fieldNames())
    record.update(
        log_id=f"{source}:{spec.name}:{run_ts}:silver:{uuid.uuid4().hex[:8]}", run_id=run_id, run_ts=run_ts,
        run_date=parse_run_date(run_ts), source=source, table_name=spec.name, load_mode=spec.load_mode,
        start_time=started)

    def done(status: str, message: str | None = None, **found) -> dict:
        ended = utc_now()
        return {**record, **found, "status": status, "error_message": message, "end_time": ended,
                "duration_seconds": int((ended - started).total_seconds())}

    if not spec.business_keys:
        return done(SKIPPED, NO_KEYS)
    record.update(bronze_table=spec.bronze_table, silver_table=spec.silver_table)
    try:
        later = [v.run_ts for v in versioned.later_versions(spark, spec.silver_table, run_ts)]
        metrics, note = _merge(spark, spec, run_ts, delete_modes, only_new_loads)
        for other in later:
            _merge(spark, spec, other, delete_modes, only_new_loads)
    except Exception as error:
        return done(FAILED, str(error)[:MESSAGE_LIMIT])
    notes = [note, f"merged again after it: {', '.join(later)}" if later else None]
    return done(SUCCESS, "; ".join(n for n in notes if n) or None, **metrics)


def bronze_as_of(spark: SparkSession, table: str, run_ts: str) -> DataFrame:
    """A versioned table as of a run; any other table as it is (histories are cut by load stamp)."""
    if is_view(spark, table) and versioned.versions(spark, table):
        return versioned.read_as_of(spark, table, run_ts)
    return spark.table(quoted(table))


def _merge(spark: SparkSession, spec: TableSpec, run_ts: str, delete_modes: Sequence[str],
           only_new_loads: bool | None) -> tuple[dict, str | None]:
    keys = list(spec.business_keys)
    history = spec.load_mode == "incremental"
    base = versioned.version_before(spark, spec.silver_table, run_ts)
    rows = bronze_as_of(spark, spec.bronze_table, run_ts)
    order = []
    listing = covered.listed_files(spark, spec.bronze_table, run_ts.upper()) if history else None
    cut = history and histories.refuse_removed(spark, spec.bronze_table, run_ts, base, listing)
    known = covered.covered_files(spark, spec.silver_table, base.run_ts) if history and base else None
    started = described(spark, spec.bronze_table, "Created Time") or ""
    if known is not None and versioned.version_properties(spark, base).get(STARTED) != started:
        known = None
    partial = history and base is not None and (
        covered.only_grown(listing, known, base.run_ts) if only_new_loads is None else only_new_loads)
    if history:
        rows = loads_until(rows, run_ts, after=base.run_ts if partial else None)
        order.append(F.col(LOAD_COLUMN).desc())
    if spec.incremental_column in rows.columns:
        order.append(F.col(f"`{spec.incremental_column}`").desc_nulls_last())
    buckets = versioned.bucket_count(spark, base, _expected_bytes(spark, spec, run_ts, base), _expected_rows(spark, rows, keys, base))
    current = merge.hashed_source(rows, keys, order)
    deletes = (spec.sync_deletes or spec.load_mode in delete_modes) and not partial and not cut
    previous = versioned.read_version(spark, base) if base else None
    merged = merge.merge_silver(previous, aligned(current, keys, buckets), keys, run_ts, deletes)
    metrics = versioned.write_version(
        spark, spec.silver_table, merged, run_ts, bucket_by=keys, buckets=buckets, laid_out=True,
        metrics=merge.merge_metrics(), drop_columns=[merge.CHANGE, merge.IN_SOURCE],
        properties={STARTED: started})
    metrics.pop("rows")
    if history:
        covered.record_covered(spark, spec.silver_table, spec.bronze_table, run_ts.upper(), listing, known if partial else None)
    return metrics, _set_aside(spark, spec, rows, keys, run_ts, base.run_ts if base and history else None)


def _expected_bytes(spark: SparkSession, spec: TableSpec, run_ts: str, base: versioned.Version | None) -> int:
    """Upper bound for the size of the next state: the last one plus what came in."""
    table = versioned.published(spark, spec.bronze_table) or spec.bronze_table
    if base and spec.load_mode == "incremental":
        incoming = sum(folder_bytes(spark, p) for p in bronze.run_folders(spark, table, run_ts))
    else:
        incoming = table_bytes(spark, table) or 0
    return incoming + (table_bytes(spark, base.table) or 0 if base else 0)


def _expected_rows(spark: SparkSession, rows: DataFrame, keys: Sequence[str], base: versioned.Version | None) -> int:
    """About as many rows as the two sides of the merge have: those of the last state and the incoming keys.

    Parquet counts rows in its footers. Keys are only counted, roughly, where there are more rows than fit a bucket.
    """
    incoming = rows.count()
    if incoming > versioned.BUCKET_ROWS:
        incoming = rows.agg(F.approx_count_distinct(F.xxhash64(*[F.col(f"`{k}`") for k in keys])).alias("n")).first().n
    return incoming + (versioned.version_rows(spark, base) or 0 if base else 0)


def aligned(current: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Incoming rows in as many partitions as the version has buckets.

    Spark drops this step when the session's shuffle partitions are the same number. Otherwise
    it moves the incoming rows once more, where it would have moved the whole silver table; and
    every bucket stays one file.
    """
    return current.repartition(buckets, *[F.col(k) for k in keys])


def _set_aside(spark: SparkSession, spec: TableSpec, rows: DataFrame, keys: list[str], run_ts: str,
               after: str | None) -> str | None:
    """Keep rows without a complete key in a table of their own: those of all loads that this
    merge is the first to cover. Parquet statistics let the check skip every row group whose
    keys are complete."""
    if after is not None:
        rows = rows.where(F.col(LOAD_COLUMN) > after)
    keyless = merge.null_key_rows(rows, keys)
    if keyless.limit(1).isEmpty():
        return None
    target = spec.silver_table + REJECTED_SUFFIX
    n = bronze.append_run(spark, target, keyless, run_ts, evolve=table_exists(spark, target))
    return f"{n} rows without a complete business key were set aside in {target}"
