"""Fixed schemas: log tables, registry and configuration files."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and columns of the four log tables. ``write_id`` is our own: each write
# goes to partitions that only it owns, so that writers of one table never meet.
BRONZE_LOG = "logs.bronze_processing_log"
BRONZE_SUMMARY = "logs.bronze_run_summary"
SILVER_LOG = "logs.silver_processing_log"
SILVER_SUMMARY = "logs.silver_run_summary"

LOG_SCHEMAS = {
    BRONZE_LOG: (
        T.StructType()
        .add("log_id", "string", False)
        .add("run_log_id", "string", False)
        .add("run_id", "string", False)
        .add("run_date", "date", False)
        .add("run_ts", "string", False)
        .add("source", "string", False)
        .add("table_name", "string", False)
        .add("partition_key", "string")
        .add("load_mode", "string")
        .add("status", "string", False)
        .add("rows_processed", "long")
        .add("start_time", "timestamp")
        .add("end_time", "timestamp")
        .add("duration_seconds", "long")
        .add("error_message", "string")
        .add("parquet_path", "string")
        .add("delta_table", "string")
        .add("write_id", "string")),
    BRONZE_SUMMARY: (
        T.StructType()
        .add("log_id", "string", False)
        .add("run_id", "string", False)
        .add("run_date", "date", False)
        .add("run_ts", "string", False)
        .add("source", "string")
        .add("status", "string", False)
        .add("run_start", "timestamp", False)
        .add("run_end", "timestamp", False)
        .add("duration_seconds", "double")
        .add("total_tables", "long", False)
        .add("tables_success", "long", False)
        .add("tables_empty", "long", False)
        .add("tables_failed", "long", False)
        .add("tables_skipped", "long", False)
        .add("total_rows", "long", False)
        .add("workers", "long")
        .add("sum_task_seconds", "double")
        .add("theoretical_min_sec", "double")
        .add("actual_time_sec", "double")
        .add("efficiency_pct", "double")
        .add("failed_tables", "string")
        .add("error_message", "string")
        .add("write_id", "string")),
    SILVER_LOG: (
        T.StructType()
        .add("log_id", "string", False)
        .add("run_id", "string", False)
        .add("run_date", "date", False)
        .add("run_ts", "string", False)
        .add("source", "string", False)
        .add("table_name", "string", False)
        .add("load_mode", "string")
        .add("status", "string", False)
        .add("rows_inserted", "long")
        .add("rows_updated", "long")
        .add("rows_deleted", "long")
        .add("rows_unchanged", "long")
        .add("total_silver_rows", "long")
        .add("bronze_rows", "long")
        .add("bronze_table", "string")
        .add("start_time", "timestamp")
        .add("end_time", "timestamp")
        .add("duration_seconds", "long")
        .add("error_message", "string")
        .add("silver_table", "string")
        .add("write_id", "string")),
    SILVER_SUMMARY: (
        T.StructType()
        .add("run_id", "string", False)
        .add("source", "string", False)
        .add("run_ts", "string", False)
        .add("run_date", "date", False)
        .add("run_start", "timestamp", False)
        .add("run_end", "timestamp")
        .add("duration_seconds", "long")
        .add("total_tables", "long", False)
        .add("tables_success", "long")
        .add("tables_failed", "long")
        .add("tables_skipped", "long")
        .add("total_inserts", "long")
        .add("total_updates", "long")
        .add("total_deletes", "long")
        .add("total_unchanged", "long")
        .add("failed_tables", "string")
        .add("write_id", "string")),
}
WRITE_COLUMN = "write_id"
LOG_PARTITIONS = {
    BRONZE_LOG: [WRITE_COLUMN, "run_date", "table_name"],
    BRONZE_SUMMARY: [WRITE_COLUMN],
    SILVER_LOG: [WRITE_COLUMN, "run_date"],
    SILVER_SUMMARY: [WRITE_COLUMN],
}

# Registry file: one document per source. Flags and the incremental column occur in several
# spellings, so they are read as text and normalised afterwards.
REGISTRY_SCHEMA = """
    source STRING, run_date_utc STRING, watermarks_path STRING, base_files STRING, connection_name STRING,
    defaults STRUCT<concurrency_large: BIGINT, concurrency_small: BIGINT,
                    max_rows_per_file_large: BIGINT, max_rows_per_file_small: BIGINT>,
    tables ARRAY<STRUCT<
        name: STRING, enabled: STRING, size_class: STRING, load_mode: STRING,
        delta_schema: STRING, delta_table: STRING, base_query: STRING,
        business_keys: ARRAY<STRING>, zorder: ARRAY<STRING>,
        `window`: STRUCT<column: STRING, partition_column: STRING, granularity: STRING,
                         lookback_months: BIGINT, late_arrival_facts: BIGINT>,
        partitioning: STRUCT<type: STRING, year_col: STRING, month_col: STRING>,
        incremental: STRUCT<column: STRING, type: STRING>,
        incremental_column: STRING,
        single_file: BOOLEAN, sync_deletes: BOOLEAN,
        concurrency: BIGINT, max_rows_per_file: BIGINT>>
"""
WATERMARK_SCHEMA = "source ARRAY<STRUCT<name: STRING, tables: MAP<STRING, STRING>>>"
RUNPLAN_SCHEMA = "source STRING, time STRING, days STRING, config STRING, cadence STRING, hour STRING"
