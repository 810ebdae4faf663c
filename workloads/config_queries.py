"""Watermarks, table registry and column metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeload.functions import casts, stamps, text
from lakeload.operators import metadata, registry, runlog, watermarks
from workloads import fixtures as fx
from workloads.book import query

# Watermarks -------------------------------------------------------------------------------------

MARKS = (fx.WATERMARKS, """
newest AS (SELECT table_name, max(watermark) AS watermark FROM watermark_updates
           WHERE watermark IS NOT NULL AND watermark <> '' GROUP BY table_name)""")


@query("watermark_max", ctes=MARKS, sql="SELECT * FROM newest")
def watermark_max(spark, sf_dir):
    return watermarks.max_watermarks(fx.watermark_updates(spark, sf_dir), "stamp17")


@query("watermark_diff", ctes=MARKS, sql="""
SELECT n.table_name, s.watermark AS old_watermark, n.watermark AS new_watermark,
       CASE WHEN s.watermark = n.watermark THEN 'MATCH' WHEN s.watermark IS NULL THEN 'NEW' ELSE 'UPDATE' END AS status
FROM newest n LEFT JOIN watermark_store s ON n.table_name = s.table_name""")
def watermark_diff(spark, sf_dir):
    newest = watermarks.max_watermarks(fx.watermark_updates(spark, sf_dir))
    return watermarks.compare_watermarks(fx.watermark_store(spark, sf_dir), newest)


@query("watermark_merge", ctes=MARKS, sql="""
SELECT coalesce(s.table_name, n.table_name) AS table_name, coalesce(n.watermark, s.watermark) AS watermark
FROM newest n FULL JOIN watermark_store s ON n.table_name = s.table_name""")
def watermark_merge(spark, sf_dir):
    newest = watermarks.max_watermarks(fx.watermark_updates(spark, sf_dir), "stamp17")
    return watermarks.merged_watermarks(fx.watermark_store(spark, sf_dir), newest)


@query("watermark_merge_monotonic", ctes=MARKS, sql="""
SELECT coalesce(s.table_name, n.table_name) AS table_name,
       greatest(s.watermark, n.watermark) AS watermark
FROM (SELECT table_name, min(watermark) AS watermark FROM watermark_updates GROUP BY table_name) n
FULL JOIN watermark_store s ON n.table_name = s.table_name""")
def watermark_merge_monotonic(spark, sf_dir):
    """Updates that lie before the stored mark must not move it back."""
    oldest = fx.watermark_updates(spark, sf_dir).groupBy("table_name").agg(F.min("watermark").alias("watermark"))
    return watermarks.merged_watermarks(fx.watermark_store(spark, sf_dir), oldest, monotonic_kind="stamp17")


@query("stamp17_conversion", sql="""
SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S%g') AS BIGINT) AS stamp, date_trunc('millisecond', ts) AS moment
FROM events""")
def stamp17_conversion(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("event_id", stamps.stamp17(F.col("ts")).alias("stamp"))
    return events.withColumn("moment", stamps.stamp17_to_timestamp(F.col("stamp")))


@query("incremental_filter", sql="SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def incremental_filter(spark, sf_dir):
    return watermarks.incremental_filter(
        fx.table(spark, sf_dir, "events"), "ts", "datetime", "2024-01-20 00:00:00")


@query("lookback_filter", sql="SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-04-01'")
def lookback_filter(spark, sf_dir):
    return watermarks.lookback_filter(
        fx.table(spark, sf_dir, "orders"), "o_orderdate", dt.date(2001, 7, 15), months=12, late_months=3)


# Registry ---------------------------------------------------------------------------------------

REG = (fx.REGISTRY,)
ON = "coalesce(enabled, 'true') IN ('true', 'True', '1')"
MODE = "lower(coalesce(load_mode, 'snapshot'))"
NO_KEYS = "* EXCLUDE (business_keys)"


@query("enabled_tables", ctes=REG, sql=f"SELECT {NO_KEYS} FROM registry WHERE {ON}")
def enabled_tables(spark, sf_dir):
    return registry.enabled_tables(fx.registry(spark, sf_dir)).drop("business_keys")


@query("tables_by_load_mode", ctes=REG, sql=f"SELECT {NO_KEYS} FROM registry WHERE {MODE} = 'incremental'")
def tables_by_load_mode(spark, sf_dir):
    return registry.tables_by_load_mode(fx.registry(spark, sf_dir), "INCREMENTAL").drop("business_keys")


@query("tables_to_process", ctes=(fx.REGISTRY, fx.PROCESSING_LOG), sql=f"""
SELECT {NO_KEYS} FROM registry WHERE {ON} AND name IN (
  SELECT table_name FROM processing_log WHERE status = 'FAILED' AND run_ts = '{fx.LOG_RUN}')""")
def tables_to_process(spark, sf_dir):
    """Enabled tables, restricted to those that failed in one run."""
    failed = runlog.failed_tables(fx.processing_log(spark, sf_dir), fx.LOG_RUN)
    retry = failed.select(F.col("table_name").alias("name"))
    return registry.tables_to_process(fx.registry(spark, sf_dir), retry).drop("business_keys")


@query("unknown_retries", ctes=REG, sql="""
SELECT DISTINCT n_name AS name FROM nation WHERE n_name NOT IN (SELECT name FROM registry)""")
def unknown_retries(spark, sf_dir):
    names = fx.table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return registry.unknown_retries(fx.registry(spark, sf_dir), names)


TARGETS = """
targets AS (
  SELECT source, name,
         CASE WHEN contains(coalesce(delta_table, name), '.') THEN coalesce(delta_table, name)
              ELSE coalesce(delta_schema, 'bronze') || '.' || coalesce(delta_table, name) END AS bronze_table,
         CASE WHEN starts_with(delta_table, 'silver.') THEN delta_table ELSE 'silver.' || name END AS silver_table
  FROM registry)"""


@query("target_names", ctes=(fx.REGISTRY, TARGETS), sql="SELECT * FROM targets")
def target_names(spark, sf_dir):
    named = registry.with_targets(fx.registry(spark, sf_dir))
    return named.select("source", "name", "bronze_table", "silver_table")


@query("unambiguous_silver_names", ctes=(fx.REGISTRY, TARGETS), sql="""
SELECT source, name, CASE WHEN (SELECT count(DISTINCT source) FROM targets o WHERE o.silver_table = t.silver_table) > 1
                          THEN 'silver.' || source || '__' || name ELSE silver_table END AS silver_table
FROM targets t""")
def unambiguous_silver_names(spark, sf_dir):
    named = registry.with_unambiguous_silver(registry.with_targets(fx.registry(spark, sf_dir)))
    return named.select("source", "name", "silver_table")


@query("target_schemas", ctes=(fx.REGISTRY, TARGETS),
       sql="SELECT DISTINCT split_part(bronze_table, '.', 1) AS schema_name FROM targets")
def target_schemas(spark, sf_dir):
    return registry.target_schemas(fx.registry(spark, sf_dir))


@query("registry_summary", ctes=REG, sql=f"""
SELECT source, count(*) AS total_tables, count(*) FILTER ({ON}) AS enabled_tables,
       count(*) FILTER (NOT {ON}) AS disabled_tables,
       count(*) FILTER ({ON} AND {MODE} = 'snapshot') AS snapshot_tables,
       count(*) FILTER ({ON} AND {MODE} = 'incremental') AS incremental_tables,
       count(*) FILTER ({ON} AND {MODE} = 'window') AS window_tables,
       count(*) FILTER ({ON} AND {MODE} NOT IN ('snapshot', 'incremental', 'window')) AS other_tables
FROM registry GROUP BY source""")
def registry_summary(spark, sf_dir):
    return registry.registry_summary(fx.registry(spark, sf_dir))


@query("load_mode_counts", ctes=REG, sql=f"""
SELECT source, {MODE} AS load_mode, count(*) AS n_tables FROM registry WHERE {ON} GROUP BY ALL""")
def load_mode_counts(spark, sf_dir):
    return registry.load_mode_counts(fx.registry(spark, sf_dir))


DONE = f"SELECT 1 FROM processing_log l WHERE l.source = r.source AND l.table_name = r.name AND run_ts = '{fx.LOG_RUN}'"


@query("pending_tables", ctes=(fx.REGISTRY, fx.PROCESSING_LOG), sql=f"""
SELECT {NO_KEYS} FROM registry r WHERE NOT EXISTS ({DONE} AND status = 'SUCCESS')""")
def pending_tables(spark, sf_dir):
    done = runlog.successful_tables(fx.processing_log(spark, sf_dir), fx.LOG_RUN)
    return registry.pending_tables(fx.registry(spark, sf_dir), done).drop("business_keys")


@query("silver_candidates", ctes=(fx.REGISTRY, fx.PROCESSING_LOG), sql=f"""
SELECT {NO_KEYS} FROM registry r WHERE len(business_keys) > 0 AND EXISTS ({DONE} AND status = 'SUCCESS')
AND NOT EXISTS ({DONE} AND status = 'EMPTY')""")
def silver_candidates(spark, sf_dir):
    """Keyed tables with a bronze success; the fixture's EMPTY rows stand for finished merges."""
    logs = fx.processing_log(spark, sf_dir)
    merged = runlog.tables_with_status(logs, fx.LOG_RUN, "EMPTY")
    return registry.silver_candidates(
        fx.registry(spark, sf_dir), runlog.successful_tables(logs, fx.LOG_RUN), merged).drop("business_keys")


# Column metadata ----------------------------------------------------------------------------------

META = (fx.COLUMN_METADATA,)
EXPRESSION_COLUMNS = ["obj_name", "column_name", "data_type", "expression"]


def safe_sql(column: str) -> str:
    joined = f"regexp_replace(trim(regexp_replace({column}, '[^0-9A-Za-z_ ]+', '', 'g')), ' +', '_', 'g')"
    return (f"CASE WHEN {column} IS NULL THEN '' WHEN {joined} = '' THEN {column} "
            f"WHEN regexp_matches({joined}, '^[0-9]') THEN '_' || {joined} ELSE {joined} END")


@query("safe_names", sql=f"SELECT page_id, url, {safe_sql('url')} AS safe_name FROM pages")
def safe_names(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", "url", text.safe_identifier(F.col("url")).alias("safe_name"))


@query("safe_text_names", sql=f"SELECT doc_id, {safe_sql('text')} AS safe_name FROM documents")
def safe_text_names(spark, sf_dir):
    """The same clean-up over whole texts with every kind of character."""
    return fx.table(spark, sf_dir, "documents").select("doc_id", text.safe_identifier(F.col("text")).alias("safe_name"))


# The cast text of each source type, as specified. {c} is the quoted column, {p} and {s} are
# precision and scale.
CAST_TEXT = """
  ('decimal', 'CAST({c} AS decimal({p},{s}))'), ('numeric', 'CAST({c} AS decimal({p},{s}))'),
  ('money', 'CAST({c} AS decimal(19,4))'), ('smallmoney', 'CAST({c} AS decimal(10,4))'),
  ('tinyint', 'CAST({c} AS smallint)'), ('smallint', 'CAST({c} AS smallint)'), ('int', 'CAST({c} AS int)'),
  ('bigint', 'CAST({c} AS bigint)'), ('bit', 'CAST({c} AS bit)'), ('float', 'CAST({c} AS float)'),
  ('real', 'CAST({c} AS real)'), ('date', 'CAST({c} AS date)'), ('datetime', 'CAST({c} AS datetime2(3))'),
  ('smalldatetime', 'CAST({c} AS datetime2(0))'), ('datetime2', 'CAST({c} AS datetime2(6))'),
  ('time', 'CONVERT(varchar(8), {c}, 108)'), ('datetimeoffset', 'CAST(SWITCHOFFSET({c}, ''+00:00'') AS datetime2(6))'),
  ('text', 'CONVERT(varchar(max), {c})'), ('ntext', 'CONVERT(nvarchar(max), {c})'),
  ('uniqueidentifier', 'CONVERT(varchar(36), {c})'), ('xml', 'CONVERT(nvarchar(max), {c})')"""
WIDE_CAST_TEXT = CAST_TEXT + """,
  ('image', 'CONVERT(varbinary(max), {c})'), ('rowversion', 'CAST({c} AS varbinary(8))'),
  ('timestamp', 'CAST({c} AS varbinary(8))'), ('hierarchyid', '{c}.ToString()'), ('geometry', '{c}.STAsBinary()'),
  ('geography', '{c}.STAsBinary()'), ('sql_variant', 'CONVERT(nvarchar(max), {c})')"""


def cast_sql(wide: bool) -> str:
    """Types that are not listed are selected as they are."""
    column = "'[' || replace(column_name, ']', ']]') || ']'" if wide else "'[' || column_name || ']'"
    template = (f"coalesce((SELECT template FROM (VALUES {WIDE_CAST_TEXT if wide else CAST_TEXT}) k(kind, template)"
                " WHERE kind = lower(data_type)), '{c}')")
    filled = (f"replace(replace(replace({template}, '{{p}}', CAST(coalesce(numeric_precision, 0) AS VARCHAR)),"
              f" '{{s}}', CAST(coalesce(numeric_scale, 0) AS VARCHAR)), '{{c}}', {column})")
    return f"{filled} || ' AS [' || ({safe_sql('column_name')}) || ']'"


@query("column_expressions", ctes=META, sql=f"""
SELECT obj_name, column_name, data_type, {cast_sql(False)} AS expression FROM column_metadata""")
def column_expressions(spark, sf_dir):
    return metadata.column_expressions(fx.column_metadata(spark, sf_dir)).select(*EXPRESSION_COLUMNS)


@query("column_expressions_wide", ctes=META, sql=f"""
SELECT obj_name, column_name, data_type, {cast_sql(True)} AS expression FROM column_metadata""")
def column_expressions_wide(spark, sf_dir):
    return metadata.column_expressions(fx.column_metadata(spark, sf_dir), wide=True).select(*EXPRESSION_COLUMNS)


def base_query_sql(keys: str, separator: str, wide: bool = False) -> str:
    return f"""
SELECT {keys}, 'SELECT ' || string_agg({cast_sql(wide)}, '{separator}' ORDER BY coalesce(ordinal_position, 0), column_name)
       || ' FROM [' || schema_name || '].[' || obj_name || ']' AS base_query
FROM column_metadata GROUP BY {keys}"""


@query("base_queries", ctes=META, sql=base_query_sql("schema_name, obj_name", ","))
def base_queries(spark, sf_dir):
    return metadata.base_queries(fx.column_metadata(spark, sf_dir))


@query("base_queries_wide", ctes=META, sql=base_query_sql("schema_name, obj_name", ", ", True))
def base_queries_wide(spark, sf_dir):
    return metadata.base_queries(fx.column_metadata(spark, sf_dir), separator=", ", wide=True)


@query("metadata_nulls", ctes=META, sql="""
SELECT count(*) FILTER (server_name IS NULL) AS server_name_nulls, count(*) FILTER (ordinal_position IS NULL)
       AS ordinal_position_nulls, count(*) FILTER (numeric_scale IS NULL) AS numeric_scale_nulls
FROM column_metadata""")
def metadata_nulls(spark, sf_dir):
    return metadata.null_counts(
        fx.column_metadata(spark, sf_dir), ["server_name", "ordinal_position", "numeric_scale"])


# The configuration relations are taken from the metadata itself, so they grow with it.
SOURCES = """
sources AS (SELECT DISTINCT 'src_' || substr(server_name, 5) AS source, server_name, db_name FROM column_metadata),
tables_of AS (
  SELECT source, schema_name, obj_name, count(*) FILTER (data_type = 'image') AS images,
         sum(max_len) AS width, min(numeric_scale) AS low_scale, max(column_name) AS some_column
  FROM column_metadata JOIN sources USING (server_name, db_name) GROUP BY ALL)"""


def _sources(spark, sf_dir):
    return fx.column_metadata(spark, sf_dir).select(
        F.concat(F.lit("src_"), F.expr("substring(server_name, 5)")).alias("source"),
        F.col("server_name").alias("server"), F.col("db_name").alias("database")).distinct()


def _with_source(spark, sf_dir):
    return registry.with_source(fx.column_metadata(spark, sf_dir), _sources(spark, sf_dir))


@query("metadata_sources", ctes=(fx.COLUMN_METADATA, SOURCES), sql="""
SELECT source, schema_name, count(*) AS n_columns, count(DISTINCT obj_name) AS n_tables
FROM column_metadata JOIN sources USING (server_name, db_name) GROUP BY ALL""")
def metadata_sources(spark, sf_dir):
    return _with_source(spark, sf_dir).groupBy("source", "schema_name").agg(
        F.count(F.lit(1)).alias("n_columns"), F.countDistinct("obj_name").alias("n_tables"))


def _settings(spark, sf_dir):
    """Disabled tables, size classes, load modes, windows and excluded tables, from the metadata."""
    keys = list(registry.TABLE_KEYS)
    facts = _with_source(spark, sf_dir).groupBy(*keys).agg(
        F.count_if(F.col("data_type") == "image").alias("images"), F.sum("max_len").alias("width"),
        F.min("numeric_scale").alias("low_scale"), F.max("column_name").alias("some_column"))
    modes = facts.where("images > 0").select(
        *keys, F.when(F.col("width") > 500, "incremental").otherwise("window").alias("load_mode"),
        F.col("some_column").alias("filter_column"), F.lit("stamp17").alias("kind"))
    windows = facts.where("width <= 520").select(
        *keys, F.col("some_column").alias("partition_column"), F.lit("month").alias("granularity"),
        F.lit(12).alias("lookback_months"))
    return (facts.where("width < 400").select(*keys),
            facts.where("width > 600").select(*keys, F.lit("L").alias("size_class")), modes, windows,
            facts.select(*keys, F.when(F.col("low_scale") > 0, 1).otherwise(0).alias("excluded")))


def _joined_registry(spark, sf_dir, use_load_modes=True):
    queries = metadata.base_queries(_with_source(spark, sf_dir), list(registry.TABLE_KEYS))
    return registry.registry_join(queries, *_settings(spark, sf_dir), use_load_modes)


def joined_registry_sql(use_load_modes: bool) -> str:
    settings = """
       CASE WHEN images > 0 THEN CASE WHEN width > 500 THEN 'incremental' ELSE 'window' END ELSE 'snapshot' END AS load_mode,
       CASE WHEN images > 0 THEN some_column END AS filter_column, CASE WHEN images > 0 THEN 'stamp17' END AS kind,
       CASE WHEN width <= 520 THEN some_column END AS partition_column,
       CASE WHEN width <= 520 THEN 'month' END AS granularity, CASE WHEN width <= 520 THEN 12 END AS lookback_months"""
    if not use_load_modes:
        settings = """'snapshot' AS load_mode, CAST(NULL AS VARCHAR) AS filter_column, CAST(NULL AS VARCHAR) AS kind,
       CAST(NULL AS VARCHAR) AS partition_column, CAST(NULL AS VARCHAR) AS granularity, CAST(NULL AS INTEGER) AS lookback_months"""
    return f"""
SELECT t.source, t.schema_name, t.obj_name AS name, NOT width < 400 AS enabled,
       CASE WHEN width > 600 THEN 'L' ELSE 'S' END AS size_class, base_query, {settings}
FROM tables_of t JOIN ({base_query_sql("schema_name, obj_name", ",")}) q USING (schema_name, obj_name)
WHERE NOT coalesce(low_scale, 0) > 0"""


@query("registry_join", ctes=(fx.COLUMN_METADATA, SOURCES), sql=joined_registry_sql(True))
def registry_join(spark, sf_dir):
    return _joined_registry(spark, sf_dir)


@query("registry_join_snapshot", ctes=(fx.COLUMN_METADATA, SOURCES), sql=joined_registry_sql(False))
def registry_join_snapshot(spark, sf_dir):
    return _joined_registry(spark, sf_dir, use_load_modes=False)


@query("registry_records", ctes=(fx.COLUMN_METADATA, SOURCES), sql=f"""
SELECT source, name, '{{"name":"' || name || '","enabled":' || CAST(enabled AS VARCHAR) || ',"size_class":"' || size_class
       || '","load_mode":"' || load_mode || '","delta_schema":"' || source || '","delta_table":"' || name
       || '","base_query":"' || base_query || '"'
       || CASE load_mode WHEN 'window' THEN ',"window":{{' || concat_ws(',',
            '"partition_column":"' || partition_column || '"', '"granularity":"' || granularity || '"',
            '"lookback_months":' || CAST(lookback_months AS VARCHAR)) || '}}'
          WHEN 'incremental' THEN ',"incremental_column":{{"column":"' || filter_column || '","kind":"' || kind || '"}}'
          ELSE '' END || '}}' AS record
FROM ({joined_registry_sql(True)})""")
def registry_records(spark, sf_dir):
    return registry.table_records(_joined_registry(spark, sf_dir))


@query("registry_documents", ctes=(fx.COLUMN_METADATA, SOURCES), sql=f"""
SELECT source, count(*) OVER (PARTITION BY source) AS n_tables, name, CAST(enabled AS VARCHAR) AS enabled, size_class,
       load_mode, base_query
FROM ({joined_registry_sql(True)})""")
def registry_documents(spark, sf_dir):
    """Documents built per source, then parsed again: every table must be in them with its settings."""
    documents = registry.registry_documents(_joined_registry(spark, sf_dir))
    parsed = F.from_json("value", "source STRING, tables ARRAY<STRUCT<name: STRING, enabled: STRING, size_class: STRING,"
                                  " load_mode: STRING, base_query: STRING>>")
    documents = documents.select(parsed.alias("d")).select(
        "d.source", F.size("d.tables").cast("bigint").alias("n_tables"), F.explode("d.tables").alias("t"))
    return documents.select("source", "n_tables", "t.name", "t.enabled", "t.size_class", "t.load_mode", "t.base_query")
