"""Queries over run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.stamps import run_date
from lakeload.operators.current import latest_rows

# Fixed values.
SUCCESS, FAILED, EMPTY, SKIPPED = "SUCCESS", "FAILED", "EMPTY", "SKIPPED"
PARTIAL, NO_WORK = "PARTIAL", "NO_WORK"
BRONZE_OK = (SUCCESS, EMPTY, SKIPPED)
SILVER_OK = (SUCCESS, SKIPPED)
RUN_KEYS = ("source", "run_id", "run_ts")


def logs_for_run(logs: DataFrame, run_ts: str) -> DataFrame:
    """Log rows of one run. The derived date predicate prunes log partitions."""
    return logs.where((F.col("run_date") == run_date(F.lit(run_ts))) & (F.col("run_ts") == run_ts))


def tables_with_status(logs: DataFrame, run_ts: str, status: str) -> DataFrame:
    """Distinct table names of a run with the given status."""
    return logs_for_run(logs, run_ts).where(F.col("status") == status).select("source", "table_name").distinct()


def failed_tables(logs: DataFrame, run_ts: str) -> DataFrame:
    return tables_with_status(logs, run_ts, FAILED)


def successful_tables(logs: DataFrame, run_ts: str) -> DataFrame:
    return tables_with_status(logs, run_ts, SUCCESS)


def processed_flags(tables: DataFrame, logs: DataFrame, run_ts: str) -> DataFrame:
    """Every (source, table_name) with ``processed``: did it succeed in this run?"""
    done = successful_tables(logs, run_ts).withColumn("_done", F.lit(True))
    return (tables.select("source", "table_name")
            .join(done, ["source", "table_name"], "left")
            .select("source", "table_name", F.coalesce("_done", F.lit(False)).alias("processed")))


def is_table_processed(logs: DataFrame, run_ts: str, table_name: str) -> bool:
    """Did this table succeed in this run? Stops at the first row found."""
    hit = logs_for_run(logs, run_ts).where(
        (F.col("table_name") == table_name) & (F.col("status") == SUCCESS))
    return not hit.limit(1).isEmpty()


def _status_counts(*statuses: str) -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(f"tables_{s.lower()}") for s in statuses]


def _with_failed_list(summary: DataFrame, logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the JSON list of failed table names of each run.

    Collected apart from the sums: those stay a plain hash aggregation, and only failed rows,
    one per table, are ever collected. A list has as many entries as the source has tables.
    """
    failed = logs.where(F.col("status") == FAILED).select(*keys, "table_name").distinct()
    names = failed.groupBy(*keys).agg(
        F.to_json(F.array_sort(F.collect_list("table_name"))).alias("failed_tables"))
    return summary.join(names, list(keys), "left")


def _seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)


def run_status(all_ok: Column, any_rows: Column | None = None) -> Column:
    status = F.when(all_ok, SUCCESS).otherwise(PARTIAL)
    return status if any_rows is None else F.when(any_rows, status).otherwise(NO_WORK)


def bronze_run_summary(logs: DataFrame, workers: int | Column, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """One row per run: tables by status, rows, task seconds, efficiency, failed tables.

    Wall time is taken from the log rows (last end minus first start).
    """
    pool = F.lit(workers) if isinstance(workers, int) else workers
    grouped = logs.groupBy(*keys).agg(
        F.min("run_date").alias("run_date"),
        F.every(F.col("status").isin(*BRONZE_OK)).alias("_ok"),
        F.min("start_time").alias("run_start"),
        F.max("end_time").alias("run_end"),
        F.count(F.lit(1)).alias("total_tables"),
        *_status_counts(SUCCESS, EMPTY, FAILED, SKIPPED),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).cast("double").alias("sum_task_seconds"))
    timed = grouped.withColumns({
        "workers": pool.cast("bigint"),
        "actual_time_sec": _seconds_between(F.col("run_start"), F.col("run_end")),
    }).withColumns({
        "theoretical_min_sec": F.when(F.col("workers") > 0, F.col("sum_task_seconds") / F.col("workers"))
        .otherwise(F.col("sum_task_seconds")),
        "duration_seconds": F.col("actual_time_sec"),
        "status": run_status(F.col("_ok")),
    })
    efficiency = F.when(
        F.col("actual_time_sec") > 0, F.col("theoretical_min_sec") / F.col("actual_time_sec") * 100
    ).otherwise(F.lit(0.0))
    return _with_failed_list(timed.withColumn("efficiency_pct", efficiency).drop("_ok"), logs, keys)


def silver_run_summary(logs: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """One row per run: tables by status, change totals, failed tables."""
    totals = {"total_inserts": "rows_inserted", "total_updates": "rows_updated",
              "total_deletes": "rows_deleted", "total_unchanged": "rows_unchanged"}
    grouped = logs.groupBy(*keys).agg(
        F.min("run_date").alias("run_date"),
        F.min("start_time").alias("run_start"),
        F.max("end_time").alias("run_end"),
        F.count(F.lit(1)).alias("total_tables"),
        *_status_counts(SUCCESS, FAILED, SKIPPED),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in totals.items()])
    timed = grouped.withColumn(
        "duration_seconds",
        F.floor(_seconds_between(F.col("run_start"), F.col("run_end"))).cast("bigint"))
    return _with_failed_list(timed, logs, keys)


def overall_status(bronze: DataFrame, silver: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """SUCCESS / PARTIAL per run over both layers. Each layer is reduced to one row per run
    before the two meet."""
    def reduced(logs: DataFrame, fine: Sequence[str], name: str) -> DataFrame:
        return logs.groupBy(*keys).agg(F.every(F.col("status").isin(*fine)).alias(name))

    joined = reduced(bronze, BRONZE_OK, "_bronze").join(
        reduced(silver, SILVER_OK, "_silver"), list(keys), "full_outer")
    fine = F.coalesce("_bronze", F.lit(True)) & F.coalesce("_silver", F.lit(True))
    return joined.select(*keys, run_status(fine).alias("overall_status"))


def status_of_run(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row for a single run's logs; NO_WORK when both are empty."""
    def judged(logs: DataFrame, fine: Sequence[str]) -> DataFrame:
        return logs.select(F.col("status").isin(*fine).alias("fine"))

    rows = judged(bronze, BRONZE_OK).unionByName(judged(silver, SILVER_OK))
    return rows.agg(run_status(F.every("fine"), F.count(F.lit(1)) > 0).alias("overall_status"))


def latest_logs(logs: DataFrame, run_ts: str | None = None, tie_breakers: Sequence[Column] = ()) -> DataFrame:
    """Newest log row per source and table (of one run, or of every run)."""
    keys = ["source", "table_name"]
    rows = logs if run_ts is None else logs_for_run(logs, run_ts)
    if run_ts is None:
        keys = ["run_ts", *keys]
    order = [F.col("end_time").desc_nulls_last(), F.col("start_time").desc_nulls_last(), *tie_breakers]
    return latest_rows(rows, keys, order)


def latest_sizes(logs: DataFrame, tie_breakers: Sequence[Column] = ()) -> DataFrame:
    """Row count of each table's newest successful, non-empty load."""
    useful = logs.where((F.col("status") == SUCCESS) & (F.col("rows_processed") > 0))
    newest = latest_rows(useful, ["source", "table_name"], [F.col("run_ts").desc(), *tie_breakers])
    return newest.select("source", "table_name", "rows_processed")


def last_written_rows(logs: DataFrame, source: str, table_name: str) -> int | None:
    """Rows of a table's newest logged load, None when it was never loaded."""
    mine = logs.where((F.col("source") == source) & (F.col("table_name") == table_name)
                      & F.col("rows_processed").isNotNull())
    row = mine.orderBy(F.col("run_ts").desc(), F.col("end_time").desc_nulls_last()).select("rows_processed").first()
    return row.rows_processed if row else None


def with_sizes(tables: DataFrame, sizes: DataFrame) -> DataFrame:
    """Tables with their last known size; 0 when unknown."""
    known = sizes.select("source", F.col("table_name").alias("name"), F.col("rows_processed").alias("_rows"))
    return tables.join(known, ["source", "name"], "left").withColumn(
        "known_rows", F.coalesce("_rows", F.lit(0))).drop("_rows")


def largest_first(tables: DataFrame, sizes: DataFrame) -> DataFrame:
    """Loading order: largest known table first."""
    return with_sizes(tables, sizes).orderBy(F.col("known_rows").desc(), "source", "name")


def latest_run_summary(summaries: DataFrame, source: str) -> DataFrame:
    """The newest run of one source: one row, or none."""
    newest = [F.col("run_ts").desc(), *([F.col("run_start").desc()] if "run_start" in summaries.columns else [])]
    return summaries.where(F.col("source") == source).orderBy(*newest).limit(1)


def latest_run_summaries(summaries: DataFrame, tie_breakers: Sequence[Column] = ()) -> DataFrame:
    """The newest run of every source."""
    return latest_rows(summaries, ["source"], [F.col("run_ts").desc(), *tie_breakers])


LOG_UPSERT_KEYS = ("log_id", "table_name", "run_date")
LOG_UPSERT_FORCED = ("status", "run_ts", "run_date")


def upsert_log_rows(existing: DataFrame, updates: DataFrame,
                    keys: Sequence[str] = LOG_UPSERT_KEYS) -> DataFrame:
    """Log rows after an upsert: new values win where they are set, NULLs keep the old value;
    status and run stamp always come from the update."""
    marked_old = existing.select(*keys, F.lit(True).alias("_in_old"),
                                 *[F.col(c).alias(f"_old_{c}") for c in existing.columns if c not in keys])
    marked_new = updates.select(*keys, F.lit(True).alias("_in_new"),
                                *[F.col(c).alias(f"_new_{c}") for c in updates.columns if c not in keys])

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name not in updates.columns:
            return F.col(f"_old_{name}").alias(name)
        if name in LOG_UPSERT_FORCED:
            return F.when(F.col("_in_new"), F.col(f"_new_{name}")).otherwise(F.col(f"_old_{name}")).alias(name)
        return F.coalesce(f"_new_{name}", f"_old_{name}").alias(name)

    return marked_old.join(marked_new, list(keys), "full_outer").select(*[value(c) for c in existing.columns])
