"""Load one landed table into bronze."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lakeload.functions.stamps import parse_run_date
from lakeload.operators.runlog import EMPTY, FAILED, SKIPPED, SUCCESS
from lakeload.plans.spec import TableSpec
from lakeload.schemas import BRONZE_LOG, LOG_SCHEMAS
from lakeload.sources import bronze
from lakeload.sources.landed import add_load_metadata, landed_path, read_landed

# Limits, and messages that readers of the log look for.
MESSAGE_LIMIT = 500
MONTH_MODE = "window_replace"
UNSUPPORTED_MODE = "Unsupported load_mode '{}'"
READ_FAILED = "Read parquet failed: {}"
NOTHING_LANDED = "No parquet files found in {}"
NO_ROWS = "Parquet exists but contains 0 rows"
WRITE_FAILED = "Write failed: {}"
REBUILT = "Initial write failed but table was recreated. Original error: {}"


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def load_table(spark: SparkSession, spec: TableSpec, source: str, run_id: str, run_ts: str, root: str,
               drop_existing: bool = False, allow_rebuild: bool = False, evolve: bool = False,
               month_replacement: bool = False, keep_versions: bool = True,
               retention_hours: int | None = None) -> dict:
    """Read one table's landed files and write them by its load mode. Never raises for data or
    storage problems; the outcome is the returned log record.

    ``drop_existing`` recreates the target first. ``allow_rebuild`` lets a load history with
    another schema, or a table of another load mode, be dropped and restarted from this run
    (older runs are lost then). ``retention_hours`` drops versions of older runs after a
    snapshot or window load; by default all stay.
    ``evolve`` adds new columns to a history instead. ``month_replacement`` enables the mode
    that replaces only the months landed.
    """
    started = utc_now()
    record = dict.fromkeys(LOG_SCHEMAS[BRONZE_LOG].fieldNames())
    record.update(
        log_id=f"{source}:{spec.name}:{run_ts}:{uuid.uuid4().hex[:8]}", run_id=run_id, run_ts=run_ts,
        run_date=parse_run_date(run_ts), source=source, table_name=spec.name, load_mode=spec.load_mode,
        start_time=started)

    def done(status: str, rows: int | None = None, message: str | None = None) -> dict:
        ended = utc_now()
        return {**record, "status": status, "rows_processed": rows, "error_message": message, "end_time": ended,
                "duration_seconds": int((ended - started).total_seconds())}

    modes = (*bronze.LOAD_MODES, MONTH_MODE) if month_replacement else bronze.LOAD_MODES
    if spec.load_mode not in modes:
        return done(SKIPPED, message=UNSUPPORTED_MODE.format(spec.load_mode))
    record["parquet_path"] = landed_path(root, source, run_ts, spec.name)
    record["delta_table"] = spec.bronze_table
    try:
        landed = read_landed(spark, root, source, run_ts, spec.name)
    except Exception as error:
        return done(FAILED, message=READ_FAILED.format(str(error)[:MESSAGE_LIMIT]))
    if landed is None:
        return done(SKIPPED, 0, NOTHING_LANDED.format(record["parquet_path"]))
    rows = add_load_metadata(landed, run_ts)
    note = None
    try:
        if drop_existing:
            bronze.drop_target(spark, spec.bronze_table)
        try:
            written = _write(spark, spec, rows, run_ts, evolve, keep_versions, retention_hours)
        except (AnalysisException, bronze.SchemaConflict) as error:
            replaceable = _replaceable(spec, keep_versions) and not isinstance(error, bronze.FormConflict)
            if not (allow_rebuild or replaceable):
                raise
            bronze.drop_target(spark, spec.bronze_table)
            written = _write(spark, spec, rows, run_ts, evolve, keep_versions, retention_hours)
            note = REBUILT.format(str(error)[:300])
    except Exception as error:
        return done(FAILED, message=WRITE_FAILED.format(str(error)[:MESSAGE_LIMIT]))
    if written == 0:
        return done(EMPTY, 0, NO_ROWS)
    return done(SUCCESS, written, note)


def _replaceable(spec: TableSpec, keep_versions: bool) -> bool:
    """A plain snapshot or window table holds nothing that a new load does not bring. Histories
    and month-wise tables do, and a new version never conflicts with the old one."""
    return spec.load_mode in ("snapshot", "window") and not keep_versions


def _write(spark: SparkSession, spec: TableSpec, rows: DataFrame, run_ts: str, evolve: bool,
           keep_versions: bool, retention_hours: int | None) -> int:
    if spec.load_mode == "incremental":
        return bronze.append_run(spark, spec.bronze_table, rows, run_ts, evolve, spec.shape)
    if spec.load_mode == MONTH_MODE:
        return bronze.replace_months(spark, spec.bronze_table, rows, spec.window_column,
                                     spec.year_column, spec.month_column, spec.shape)
    return bronze.write_window(spark, spec.bronze_table, rows, run_ts, spec.window_column, spec.by_month,
                               spec.year_column, spec.month_column, spec.shape, keep_versions, retention_hours)
