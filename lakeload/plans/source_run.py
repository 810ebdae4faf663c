"""Run one source: bronze, logs, silver, logs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators import registry, runlog, tuning
from lakeload.plans.bronze import load_table
from lakeload.plans.silver import merge_table
from lakeload.plans.spec import TableSpec
from lakeload.schemas import BRONZE_LOG, BRONZE_SUMMARY, SILVER_LOG, SILVER_SUMMARY
from lakeload.sources import logs
from lakeload.sources.tables import ensure_schema, quoted

# Fixed values.
DEFAULT_WORKERS = 10


def run_source(spark: SparkSession, tables: DataFrame, source: str, run_ts: str, root: str,
               retry: list[str] | None = None, force: bool = False, workers: int | None = None,
               optimize_for: str = "throughput", load_options: dict | None = None,
               merge_options: dict | None = None, store: logs.LogStore = logs.LOGS) -> dict:
    """Load every pending table of a source and merge those with business keys.

    ``tables`` is a registry (see ``read_registry``). A table that the log shows as successful
    for ``run_ts`` is left alone unless ``force``; ``retry`` restricts the run to named tables.
    Merge candidates come from the log too, so a resumed run finishes what an earlier one
    loaded.

    Tables are submitted from a few driver threads, each in its own scheduler pool; with
    ``spark.scheduler.mode=FAIR`` Spark shares the executors between them, so one huge table
    does not hold up the small ones. ``store`` names the logs that the run reads and writes.
    """
    logs.ensure_log_tables(spark, store)
    run_id = f"{run_ts}_{uuid.uuid4().hex[:8]}"
    wanted = None if not retry else spark.createDataFrame([(n,) for n in retry], "name string")
    # Names are settled over the whole registry: two sources may have tables of one name.
    named = registry.with_unambiguous_silver(registry.with_targets(tables))
    chosen = registry.tables_to_process(named.where(F.col("source") == source), wanted)
    for row in registry.target_schemas(chosen).collect():
        ensure_schema(spark, row.schema_name)

    bronze_log = logs.read_log(spark, BRONZE_LOG, store)
    todo = chosen
    if not force:
        todo = registry.pending_tables(chosen, runlog.successful_tables(bronze_log, run_ts))
    sizes = runlog.latest_sizes(bronze_log.where(F.col("source") == source))
    specs = [TableSpec.from_row(r) for r in runlog.largest_first(todo, sizes).collect()]
    pool = workers or recommended_workers(spark, source, optimize_for, store)
    pool = max(1, min(pool, len(specs) or pool))

    bronze_results = _in_parallel(
        spark, pool, specs,
        lambda spec: load_table(spark, spec, source, run_id, run_ts, root, **(load_options or {})))
    if bronze_results:
        run_log_id = uuid.uuid4().hex
        logs.log_batch(spark, bronze_results, "bronze", run_log_id, store)
        summary = runlog.bronze_run_summary(_rows_of(spark, BRONZE_LOG, run_ts, run_id, store), pool)
        logs.append_logs(spark, summary.withColumn("log_id", F.lit(run_log_id)), BRONZE_SUMMARY, store)

    loaded = runlog.successful_tables(logs.read_log(spark, BRONZE_LOG, store), run_ts)
    merged = None if force else runlog.successful_tables(logs.read_log(spark, SILVER_LOG, store), run_ts)
    candidates = [TableSpec.from_row(r) for r in registry.silver_candidates(chosen, loaded, merged).collect()]
    silver_results = _in_parallel(
        spark, pool, candidates,
        lambda spec: merge_table(spark, spec, source, run_id, run_ts, **(merge_options or {})))
    if silver_results:
        logs.log_batch(spark, silver_results, "silver", store=store)
        logs.append_logs(
            spark, runlog.silver_run_summary(_rows_of(spark, SILVER_LOG, run_ts, run_id, store)), SILVER_SUMMARY, store)
    status = runlog.status_of_run(
        _rows_of(spark, BRONZE_LOG, run_ts, run_id, store), _rows_of(spark, SILVER_LOG, run_ts, run_id, store)).first()
    unknown = [] if wanted is None else [r.name for r in registry.unknown_retries(tables, wanted).collect()]
    return {
        "run_id": run_id, "source": source, "run_ts": run_ts, "workers": pool, "status": status.overall_status,
        "bronze": bronze_results, "silver": silver_results, "unknown_retries": sorted(unknown)}


def _rows_of(spark: SparkSession, table: str, run_ts: str, run_id: str, store: logs.LogStore) -> DataFrame:
    return runlog.logs_for_run(spark.table(quoted(store.table(table))), run_ts).where(F.col("run_id") == run_id)


def recommended_workers(spark: SparkSession, source: str, optimize_for: str = "throughput",
                        store: logs.LogStore = logs.LOGS) -> int:
    """Driver threads for the next run of a source, from its run history."""
    history = logs.read_log(spark, BRONZE_SUMMARY, store).where(F.col("source") == source)
    row = tuning.recommend_workers(
        history, DEFAULT_WORKERS, optimize_for=optimize_for, tie_breakers=[F.col("run_id").desc()]).first()
    return int(row.recommended_workers) if row else DEFAULT_WORKERS


def _in_parallel(spark: SparkSession, workers: int, specs: list[TableSpec],
                 work: Callable[[TableSpec], dict]) -> list[dict]:
    """Submit one job per table; results in the order of ``specs``."""
    if not specs:
        return []

    @inheritable_thread_target(spark)
    def submit(spec: TableSpec) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        return work(spec)

    with ThreadPoolExecutor(max_workers=workers) as threads:
        return list(threads.map(submit, specs))
