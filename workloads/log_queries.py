"""Run logs: filters, summaries, latest rows, messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.functions import stamps, text
from lakeload.operators import runlog
from workloads import fixtures as fx
from workloads.book import query

LOGS = (fx.PROCESSING_LOG,)
RUN = f"run_ts = '{fx.LOG_RUN}'"


@query("logs_for_run", ctes=LOGS, sql=f"SELECT * FROM processing_log WHERE {RUN}")
def logs_for_run(spark, sf_dir):
    return runlog.logs_for_run(fx.processing_log(spark, sf_dir), fx.LOG_RUN)


@query("failed_tables", ctes=LOGS,
       sql=f"SELECT DISTINCT source, table_name FROM processing_log WHERE {RUN} AND status = 'FAILED'")
def failed_tables(spark, sf_dir):
    return runlog.failed_tables(fx.processing_log(spark, sf_dir), fx.LOG_RUN)


@query("successful_tables", ctes=LOGS,
       sql=f"SELECT DISTINCT source, table_name FROM processing_log WHERE {RUN} AND status = 'SUCCESS'")
def successful_tables(spark, sf_dir):
    return runlog.successful_tables(fx.processing_log(spark, sf_dir), fx.LOG_RUN)


@query("tables_processed", ctes=(fx.PROCESSING_LOG, fx.REGISTRY),
       sql=f"""SELECT source, name AS table_name, EXISTS (SELECT 1 FROM processing_log l
                 WHERE l.source = r.source AND l.table_name = r.name AND {RUN} AND status = 'SUCCESS') AS processed
               FROM registry r""")
def tables_processed(spark, sf_dir):
    tables = fx.registry(spark, sf_dir).withColumnRenamed("name", "table_name")
    return runlog.processed_flags(tables, fx.processing_log(spark, sf_dir), fx.LOG_RUN)


@query("run_summary_bronze", ctes=LOGS, sql="""
SELECT *, CASE WHEN workers > 0 THEN sum_task_seconds / workers ELSE sum_task_seconds END AS theoretical_min_sec,
       actual_time_sec AS duration_seconds,
       CASE WHEN actual_time_sec > 0 THEN sum_task_seconds / workers / actual_time_sec * 100 ELSE 0 END AS efficiency_pct
FROM (
  SELECT source, run_id, run_ts, min(run_date) AS run_date, min(start_time) AS run_start, max(end_time) AS run_end,
         count(*) AS total_tables, count(*) FILTER (status = 'SUCCESS') AS tables_success,
         count(*) FILTER (status = 'EMPTY') AS tables_empty, count(*) FILTER (status = 'FAILED') AS tables_failed,
         count(*) FILTER (status = 'SKIPPED') AS tables_skipped, CAST(sum(rows_processed) AS BIGINT) AS total_rows,
         CAST(sum(duration_seconds) AS DOUBLE) AS sum_task_seconds,
         CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN
           '[' || string_agg(DISTINCT '"' || table_name || '"', ',' ORDER BY '"' || table_name || '"')
                  FILTER (status = 'FAILED') || ']' END AS failed_tables,
         CAST(8 AS BIGINT) AS workers,
         CAST(epoch_us(max(end_time)) - epoch_us(min(start_time)) AS DOUBLE) / 1000000 AS actual_time_sec,
         CASE WHEN bool_and(status <> 'FAILED') THEN 'SUCCESS' ELSE 'PARTIAL' END AS status
  FROM processing_log GROUP BY source, run_id, run_ts)""")
def run_summary_bronze(spark, sf_dir):
    return runlog.bronze_run_summary(fx.processing_log(spark, sf_dir), workers=8)


@query("run_summary_silver", ctes=LOGS, sql="""
SELECT source, run_id, run_ts, min(run_date) AS run_date, min(start_time) AS run_start, max(end_time) AS run_end,
       count(*) AS total_tables, count(*) FILTER (status = 'SUCCESS') AS tables_success,
       count(*) FILTER (status = 'FAILED') AS tables_failed, count(*) FILTER (status = 'SKIPPED') AS tables_skipped,
       CAST(sum(rows_inserted) AS BIGINT) AS total_inserts, CAST(sum(rows_updated) AS BIGINT) AS total_updates,
       CAST(sum(rows_deleted) AS BIGINT) AS total_deletes, CAST(sum(rows_unchanged) AS BIGINT) AS total_unchanged,
       CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN
         '[' || string_agg(DISTINCT '"' || table_name || '"', ',' ORDER BY '"' || table_name || '"')
                FILTER (status = 'FAILED') || ']' END AS failed_tables,
       (epoch_us(max(end_time)) - epoch_us(min(start_time))) // 1000000 AS duration_seconds
FROM processing_log GROUP BY source, run_id, run_ts""")
def run_summary_silver(spark, sf_dir):
    return runlog.silver_run_summary(fx.processing_log(spark, sf_dir))


@query("overall_status", ctes=LOGS, sql="""
SELECT coalesce(b.source, s.source) AS source, coalesce(b.run_id, s.run_id) AS run_id,
       coalesce(b.run_ts, s.run_ts) AS run_ts,
       CASE WHEN coalesce(b.ok, true) AND coalesce(s.ok, true) THEN 'SUCCESS' ELSE 'PARTIAL' END AS overall_status
FROM (SELECT source, run_id, run_ts, bool_and(status IN ('SUCCESS', 'EMPTY', 'SKIPPED')) AS ok
      FROM processing_log WHERE rows_processed <= 40 GROUP BY ALL) b
FULL JOIN (SELECT source, run_id, run_ts, bool_and(status IN ('SUCCESS', 'SKIPPED')) AS ok
      FROM processing_log WHERE rows_processed > 40 GROUP BY ALL) s
ON b.source = s.source AND b.run_id = s.run_id AND b.run_ts = s.run_ts""")
def overall_status(spark, sf_dir):
    logs = fx.processing_log(spark, sf_dir)
    return runlog.overall_status(logs.where("rows_processed <= 40"), logs.where("rows_processed > 40"))


def ties():
    return [F.col("rows_processed").desc(), F.col("log_id").desc()]


@query("latest_logs", ctes=LOGS, sql="""
SELECT * FROM processing_log
QUALIFY row_number() OVER (PARTITION BY run_ts, source, table_name
  ORDER BY end_time DESC NULLS LAST, start_time DESC NULLS LAST, rows_processed DESC, log_id DESC) = 1""")
def latest_logs(spark, sf_dir):
    return runlog.latest_logs(fx.processing_log(spark, sf_dir), tie_breakers=ties())


@query("latest_logs_of_run", ctes=LOGS, sql=f"""
SELECT * FROM processing_log WHERE {RUN}
QUALIFY row_number() OVER (PARTITION BY source, table_name
  ORDER BY end_time DESC NULLS LAST, start_time DESC NULLS LAST, rows_processed DESC, log_id DESC) = 1""")
def latest_logs_of_run(spark, sf_dir):
    return runlog.latest_logs(fx.processing_log(spark, sf_dir), fx.LOG_RUN, ties())


SIZES = """
sizes AS (
  SELECT source, table_name, rows_processed FROM processing_log WHERE status = 'SUCCESS' AND rows_processed > 0
  QUALIFY row_number() OVER (PARTITION BY source, table_name
    ORDER BY run_ts DESC, rows_processed DESC, log_id DESC) = 1)"""


@query("latest_sizes", ctes=(fx.PROCESSING_LOG, SIZES), sql="SELECT * FROM sizes")
def latest_sizes(spark, sf_dir):
    return runlog.latest_sizes(fx.processing_log(spark, sf_dir), ties())


@query("size_order", ctes=(fx.PROCESSING_LOG, fx.REGISTRY, SIZES), sql="""
SELECT r.source, r.name, coalesce(s.rows_processed, 0) AS known_rows
FROM registry r LEFT JOIN sizes s ON r.source = s.source AND r.name = s.table_name
ORDER BY known_rows DESC, r.source, r.name""")
def size_order(spark, sf_dir):
    sizes = runlog.latest_sizes(fx.processing_log(spark, sf_dir), ties())
    return runlog.largest_first(fx.registry(spark, sf_dir).select("source", "name"), sizes)


@query("latest_run", ctes=(fx.RUN_HISTORY,), sql="""
SELECT * FROM run_history WHERE source = '1-URGENT' ORDER BY run_ts DESC LIMIT 1""")
def latest_run(spark, sf_dir):
    return runlog.latest_run_summary(fx.run_history(spark, sf_dir), "1-URGENT")


@query("latest_run_per_source", ctes=(fx.RUN_HISTORY,), sql="""
SELECT * FROM run_history QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_ts DESC, run_id DESC) = 1""")
def latest_run_per_source(spark, sf_dir):
    return runlog.latest_run_summaries(fx.run_history(spark, sf_dir), [F.col("run_id").desc()])


@query("log_upsert", ctes=(fx.PROCESSING_LOG, """
stored AS (SELECT log_id, table_name, run_date, min(run_ts) AS run_ts, min(source) AS source, 'RUNNING' AS status,
                  min(start_time) AS start_time, CAST(NULL AS BIGINT) AS rows_processed
           FROM processing_log WHERE status <> 'SKIPPED' GROUP BY ALL),
incoming AS (SELECT log_id, table_name, run_date, min(run_ts) AS run_ts, CAST(NULL AS VARCHAR) AS source,
                    min(status) AS status, CAST(NULL AS TIMESTAMP) AS start_time, max(rows_processed) AS rows_processed
             FROM processing_log WHERE status <> 'EMPTY' GROUP BY log_id, table_name, run_date)"""), sql="""
SELECT coalesce(i.log_id, s.log_id) AS log_id, coalesce(i.table_name, s.table_name) AS table_name,
       coalesce(i.run_date, s.run_date) AS run_date, coalesce(i.run_ts, s.run_ts) AS run_ts, s.source AS source,
       coalesce(i.status, s.status) AS status, s.start_time AS start_time, i.rows_processed AS rows_processed
FROM stored s FULL JOIN incoming i
ON s.log_id = i.log_id AND s.table_name = i.table_name AND s.run_date = i.run_date""")
def log_upsert(spark, sf_dir):
    """Rows first logged as running, then completed by updates that carry only the outcome."""
    logs = fx.processing_log(spark, sf_dir)
    keys = list(runlog.LOG_UPSERT_KEYS)
    stored = logs.where("status <> 'SKIPPED'").groupBy(*keys).agg(
        F.min("run_ts").alias("run_ts"), F.min("source").alias("source"), F.lit("RUNNING").alias("status"),
        F.min("start_time").alias("start_time"), F.lit(None).cast("bigint").alias("rows_processed"))
    incoming = logs.where("status <> 'EMPTY'").groupBy(*keys).agg(
        F.min("run_ts").alias("run_ts"), F.lit(None).cast("string").alias("source"),
        F.min("status").alias("status"), F.lit(None).cast("timestamp_ntz").alias("start_time"),
        F.max("rows_processed").alias("rows_processed"))
    return runlog.upsert_log_rows(stored, incoming)


@query("run_date", ctes=LOGS, sql="""
SELECT run_ts, CAST(strptime(substr(run_ts, 1, 8), '%Y%m%d') AS DATE) AS run_day,
       CASE WHEN length(source) > 2 THEN CAST(strptime(substr(run_ts, 1, 8), '%Y%m%d') AS DATE) END AS lenient_day,
       count(*) AS n_rows
FROM processing_log GROUP BY ALL""")
def run_date(spark, sf_dir):
    logs = fx.processing_log(spark, sf_dir)
    damaged = F.when(F.length("source") > 2, F.col("run_ts")).otherwise(F.substring("run_ts", 3, 6))
    return logs.groupBy(
        "run_ts", stamps.run_date(F.col("run_ts")).alias("run_day"),
        stamps.run_date(damaged, strict=False).alias("lenient_day")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("truncated_messages", ctes=(fx.ERROR_MESSAGES,), sql="""
SELECT doc_id,
       CASE WHEN length(message) <= 1000 THEN message ELSE substr(message, 1, 1000) || '... [TRUNCATED]' END AS log_text,
       CASE WHEN length(message) <= 80 THEN message ELSE substr(message, 1, 80) || '... [TRUNCATED]' END AS short_text
FROM error_messages""")
def truncated_messages(spark, sf_dir):
    return fx.error_messages(spark, sf_dir).select(
        "doc_id", text.truncate_message(F.col("message")).alias("log_text"),
        text.truncate_message(F.col("message"), 80, empty="").alias("short_text"))


@query("error_classes", ctes=(fx.ERROR_MESSAGES,), sql=r"""
SELECT doc_id, CASE
  WHEN contains(m, 'path does not exist') OR contains(m, 'no such file or directory') OR contains(m, 'file not found')
    OR contains(m, 'cannot find path') OR contains(m, 'path not found') THEN 'MISSING_PATH'
  WHEN contains(m, 'is not a delta table') OR contains(m, 'failed to merge fields') OR contains(m, 'incompatible format')
    OR (contains(m, 'protocol') AND contains(m, 'unsupported')) OR (contains(m, 'delta log') AND contains(m, 'error'))
    OR contains(m, 'cannot find delta log') THEN 'CORRUPT_DELTA'
  WHEN contains(m, 'schema mismatch') OR contains(m, 'cannot resolve') OR contains(m, 'column not found')
    OR contains(m, 'mismatched input') OR contains(m, 'incompatible schema') THEN 'SCHEMA_MISMATCH'
  WHEN contains(m, 'timeout') OR contains(m, 'timed out') OR contains(m, 'out of memory') OR regexp_matches(m, '\boom\b')
    OR contains(m, 'resource exhausted') OR contains(m, 'deadline exceeded') THEN 'TIMEOUT'
  WHEN contains(m, 'connection refused') OR contains(m, 'connection failed') OR contains(m, 'network error')
    OR contains(m, 'cannot connect') OR contains(m, 'authentication failed') OR contains(m, 'login failed')
    OR contains(m, 'connection timeout') THEN 'CONNECTION'
  ELSE 'UNKNOWN' END AS category
FROM (SELECT doc_id, lower(message) AS m FROM error_messages)""")
def error_classes(spark, sf_dir):
    return fx.error_messages(spark, sf_dir).select("doc_id", text.error_category(F.col("message")).alias("category"))
