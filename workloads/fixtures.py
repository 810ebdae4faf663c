"""Relations derived from the test tables, once in Spark and once in SQL.

Every relation covers its whole source table. The SQL fragments are common table expressions
that the checked queries put in front of their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREVIOUS_RUN = "20010701T000000"
THIS_RUN = "20010801T000000"
AS_OF_RUN = "20240115T000000"
LOG_RUN = "19950612T000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digits(day):
    """yyyyMMdd of a date; cheaper than a format pattern."""
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


# Orders with money as decimal, so that its text is the same everywhere ----------------------

def typed_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


TYPED_ORDERS = """
typed_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders)"""

# Text a row of orders is hashed over; columns sorted by name.
ORDERS_HASH_TEXT = (
    "concat_ws('|', coalesce(CAST(o_custkey AS VARCHAR), '∅'), coalesce(CAST(o_orderdate AS VARCHAR), '∅'),"
    " coalesce(CAST(o_orderkey AS VARCHAR), '∅'), coalesce(o_orderpriority, '∅'),"
    " coalesce(o_orderstatus, '∅'), coalesce(CAST(o_totalprice AS VARCHAR), '∅'))")


# Two states of orders ------------------------------------------------------------------------
# Previous silver: urgent orders had not arrived yet; finished orders were still open; some
# unspecified-priority orders had been deleted, as had cheap open low-priority ones.
# New bronze: open low-priority orders are gone.

def bronze_now(spark, sf_dir) -> DataFrame:
    orders = typed_orders(spark, sf_dir)
    return orders.where(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O")))


def silver_before(spark, sf_dir) -> DataFrame:
    from lakeload.operators.rowhash import add_row_hash

    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    deleted = ((priority == "4-NOT SPECIFIED") & (status != "O")) | (
        (priority == "5-LOW") & (status == "O") & (F.col("o_totalprice") < 100000))
    orders = (typed_orders(spark, sf_dir).where(priority != "1-URGENT")
              .withColumn("_gone", deleted)
              .withColumn("o_orderstatus", F.when(status == "F", "O").otherwise(status)))
    hashed = add_row_hash(orders, exclude_cols=["_gone"])
    return hashed.select(
        *[c for c in hashed.columns if c != "_gone"],
        F.lit(PREVIOUS_RUN).alias("_silver_inserted_ts"),
        F.lit(PREVIOUS_RUN).alias("_silver_updated_ts"),
        F.when(F.col("_gone"), F.lit(PREVIOUS_RUN)).alias("_silver_deleted_ts"),
        F.col("_gone").alias("is_deleted"))


ORDER_STATES = TYPED_ORDERS + f""",
bronze_now AS (
  SELECT *, sha256({ORDERS_HASH_TEXT}) AS row_hash FROM typed_orders
  WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'O')),
before_rows AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority,
         (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus <> 'O')
         OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'O' AND o_totalprice < 100000) AS is_deleted
  FROM typed_orders WHERE o_orderpriority <> '1-URGENT'),
silver_before AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         sha256({ORDERS_HASH_TEXT}) AS row_hash,
         '{PREVIOUS_RUN}' AS _silver_inserted_ts, '{PREVIOUS_RUN}' AS _silver_updated_ts,
         CASE WHEN is_deleted THEN '{PREVIOUS_RUN}' END AS _silver_deleted_ts, is_deleted
  FROM before_rows)"""


# Event history: one load per day -------------------------------------------------------------

def event_history(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        "user_id", "event_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"), "props",
        F.concat(digits(F.col("ts").cast("date")), F.lit("T000000")).alias("_bronze_load_ts"))


EVENT_HISTORY = """
event_history AS (
  SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, props,
         strftime(ts, '%Y%m%d') || 'T000000' AS _bronze_load_ts
  FROM events)"""

EVENT_HASH_TEXT = (
    "concat_ws('|', coalesce(CAST(event_id AS VARCHAR), '∅'), coalesce(event_type, '∅'),"
    " coalesce(props, '∅'), coalesce(CAST(user_id AS VARCHAR), '∅'), coalesce(CAST(value AS VARCHAR), '∅'))")


# Processing log: one row per lineitem, weekly runs, a source of 25 tables per 25 suppliers ----

def processing_log(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    week = F.date_trunc("week", "l_shipdate").cast("date")
    run_ts = F.concat(digits(week), F.lit("T000000"))
    source = F.concat(F.lit("S"), F.floor(F.col("l_suppkey") / 25).cast("string"))
    seconds = F.col("l_partkey") % 60
    start = F.col("l_shipdate").cast("timestamp_ntz")
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("log_id"),
        F.concat_ws("_", run_ts, source).alias("run_id"),
        week.alias("run_date"),
        run_ts.alias("run_ts"),
        source.alias("source"),
        F.concat(F.lit("T"), (F.col("l_suppkey") % 25).cast("string")).alias("table_name"),
        F.when(F.col("l_linenumber") == 1, "SUCCESS").when(F.col("l_linenumber") == 2, "FAILED")
        .when(F.col("l_linenumber") == 3, "EMPTY").when(F.col("l_linenumber") == 4, "SKIPPED")
        .otherwise("SUCCESS").alias("status"),
        F.col("l_quantity").cast("bigint").alias("rows_processed"),
        (F.col("l_quantity").cast("bigint") * 2).alias("rows_inserted"),
        F.col("l_linenumber").cast("bigint").alias("rows_updated"),
        (F.col("l_discount") * 100).cast("decimal(9,0)").cast("bigint").alias("rows_deleted"),
        (F.col("l_tax") * 100).cast("decimal(9,0)").cast("bigint").alias("rows_unchanged"),
        start.alias("start_time"),
        (start + F.make_dt_interval(secs=seconds)).alias("end_time"),
        seconds.cast("bigint").alias("duration_seconds"))


PROCESSING_LOG = """
processing_log AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS log_id,
         strftime(date_trunc('week', l_shipdate), '%Y%m%d') || 'T000000_S' || CAST(l_suppkey // 25 AS VARCHAR) AS run_id,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS run_date,
         strftime(date_trunc('week', l_shipdate), '%Y%m%d') || 'T000000' AS run_ts,
         'S' || CAST(l_suppkey // 25 AS VARCHAR) AS source,
         'T' || CAST(l_suppkey % 25 AS VARCHAR) AS table_name,
         CASE l_linenumber WHEN 2 THEN 'FAILED' WHEN 3 THEN 'EMPTY' WHEN 4 THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
         CAST(l_quantity AS BIGINT) AS rows_processed,
         CAST(l_quantity AS BIGINT) * 2 AS rows_inserted,
         CAST(l_linenumber AS BIGINT) AS rows_updated,
         CAST(round(l_discount * 100) AS BIGINT) AS rows_deleted,
         CAST(round(l_tax * 100) AS BIGINT) AS rows_unchanged,
         l_shipdate AS start_time,
         l_shipdate + to_seconds(l_partkey % 60) AS end_time,
         l_partkey % 60 AS duration_seconds
  FROM lineitem)"""


# Table registry: one row per supplier ---------------------------------------------------------

def registry(spark, sf_dir) -> DataFrame:
    key = F.col("s_suppkey")
    kind = key % 4
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.floor(key / 25).cast("string")).alias("source"),
        F.concat(F.lit("T"), (key % 25).cast("string")).alias("name"),
        F.when(F.col("s_acctbal") < 0, "false").when(F.col("s_acctbal") < 1000, "0")
        .when(F.col("s_acctbal") < 2000, "1").when(F.col("s_acctbal") < 5000, "true").alias("enabled"),
        F.when(kind == 1, "Incremental").when(kind == 2, "window").when(kind == 3, "snapshot").alias("load_mode"),
        F.when(F.col("s_nationkey") < 10, F.array(F.lit("id"), F.lit("line"))).alias("business_keys"),
        F.when(F.col("s_nationkey") == 3, F.concat(F.lit("silver."), "s_name"))
        .when(F.col("s_nationkey") == 4, F.concat(F.lit("mart."), "s_name"))
        .when(F.col("s_nationkey") > 12, F.col("s_name")).alias("delta_table"),
        F.when(F.col("s_nationkey") > 15, F.concat(F.lit("schema_"), F.col("s_nationkey").cast("string")))
        .alias("delta_schema"))


REGISTRY = """
registry AS (
  SELECT 'S' || CAST(s_suppkey // 25 AS VARCHAR) AS source, 'T' || CAST(s_suppkey % 25 AS VARCHAR) AS name,
         CASE WHEN s_acctbal < 0 THEN 'false' WHEN s_acctbal < 1000 THEN '0' WHEN s_acctbal < 2000 THEN '1'
              WHEN s_acctbal < 5000 THEN 'true' END AS enabled,
         CASE s_suppkey % 4 WHEN 1 THEN 'Incremental' WHEN 2 THEN 'window' WHEN 3 THEN 'snapshot' END AS load_mode,
         CASE WHEN s_nationkey < 10 THEN ['id', 'line'] END AS business_keys,
         CASE WHEN s_nationkey = 3 THEN 'silver.' || s_name WHEN s_nationkey = 4 THEN 'mart.' || s_name
              WHEN s_nationkey > 12 THEN s_name END AS delta_table,
         CASE WHEN s_nationkey > 15 THEN 'schema_' || CAST(s_nationkey AS VARCHAR) END AS delta_schema
  FROM supplier)"""


# Column metadata: one row per part, twenty columns per table ------------------------------------

TYPE_CYCLE = ["decimal", "money", "smallmoney", "tinyint", "int", "BIGINT", "bit", "float", "date", "datetime",
              "smalldatetime", "datetime2", "time", "datetimeoffset", "nvarchar", "text", "ntext",
              "uniqueidentifier", "xml", "image", "rowversion", "hierarchyid", "geography", "sql_variant", "cursor"]


def column_metadata(spark, sf_dir) -> DataFrame:
    key = F.col("p_partkey")
    types = F.array(*[F.lit(t) for t in TYPE_CYCLE])
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("host"), F.floor(key / 500).cast("string")).alias("server_name"),
        F.concat(F.lit("db"), F.floor(key / 500).cast("string")).alias("db_name"),
        F.when(F.col("p_partkey") < 100, "dbo").otherwise("sales").alias("schema_name"),
        F.concat(F.lit("Obj"), F.floor(key / 20).cast("string")).alias("obj_name"),
        F.when(F.col("p_size") < 10, F.concat_ws(" ", F.col("p_size").cast("string"), "p_name"))
        .otherwise(F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))).alias("column_name"),
        F.element_at(types, (key % len(TYPE_CYCLE) + 1).cast("int")).alias("data_type"),
        F.when(key % 20 > 0, (20 - key % 20).cast("int")).alias("ordinal_position"),
        F.lit(18).alias("numeric_precision"),
        F.when(F.col("p_size") > 5, (F.col("p_size") % 10).cast("int")).alias("numeric_scale"),
        F.col("p_size").alias("max_len"))


COLUMN_METADATA = f"""
column_metadata AS (
  SELECT 'host' || CAST(p_partkey // 500 AS VARCHAR) AS server_name, 'db' || CAST(p_partkey // 500 AS VARCHAR) AS db_name,
         CASE WHEN p_partkey < 100 THEN 'dbo' ELSE 'sales' END AS schema_name,
         'Obj' || CAST(p_partkey // 20 AS VARCHAR) AS obj_name,
         CASE WHEN p_size < 10 THEN CAST(p_size AS VARCHAR) || ' ' || p_name
              ELSE p_name || ' (' || p_brand || ')' END AS column_name,
         {TYPE_CYCLE!r}[p_partkey % {len(TYPE_CYCLE)} + 1] AS data_type,
         CASE WHEN p_partkey % 20 > 0 THEN CAST(20 - p_partkey % 20 AS INTEGER) END AS ordinal_position,
         18 AS numeric_precision,
         CASE WHEN p_size > 5 THEN p_size % 10 END AS numeric_scale,
         p_size AS max_len
  FROM part)"""


# Run history: one run per order ------------------------------------------------------------------

def run_history(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderkey").alias("run_id"),
        F.concat(digits(F.col("o_orderdate").cast("date")), F.lit("T"),
                 F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0")).alias("run_ts"),
        F.col("o_orderdate").alias("run_start"),
        (1 + F.col("o_custkey") % 12).alias("workers"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("total_rows"),
        (1 + F.col("o_orderkey") % 600).alias("duration_seconds"),
        (F.col("o_orderkey") % 101).cast("double").alias("efficiency_pct"))


RUN_HISTORY = """
run_history AS (
  SELECT o_orderpriority AS source, o_orderkey AS run_id,
         strftime(o_orderdate, '%Y%m%d') || 'T' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS run_ts,
         o_orderdate AS run_start, 1 + o_custkey % 12 AS workers,
         CAST(round(o_totalprice * 100) AS BIGINT) AS total_rows, 1 + o_orderkey % 600 AS duration_seconds,
         CAST(o_orderkey % 101 AS DOUBLE) AS efficiency_pct
  FROM orders)"""


# Error messages: one per document, a known phrase before the whole text ---------------------------

PHRASES = ["Path does not exist: ", "Failed to merge fields in ", "Cannot resolve column in ",
           "Connection timeout after ", "Login failed for ", "Worker ran OOM at ", "Room booked: "]


def error_messages(spark, sf_dir) -> DataFrame:
    phrases = F.array(*[F.lit(p) for p in PHRASES])
    phrase = F.element_at(phrases, (F.col("doc_id") % len(PHRASES) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(phrase, "text").alias("message"))


ERROR_MESSAGES = f"""
error_messages AS (
  SELECT doc_id, {PHRASES!r}[doc_id % {len(PHRASES)} + 1] || text AS message FROM documents)"""


# Watermarks: one update per event; the stored map lags behind for some tables ---------------------

def watermark_updates(spark, sf_dir) -> DataFrame:
    from lakeload.functions.stamps import stamp17

    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"), stamp17(F.col("ts")).cast("string").alias("watermark"))


def watermark_store(spark, sf_dir) -> DataFrame:
    """Stored map: newest stamp of views and clicks, an old one for errors, none for signups;
    purchases are missing, and one table had no updates."""
    events = table(spark, sf_dir, "events")
    from lakeload.functions.stamps import stamp17

    newest = events.where(F.col("event_type").isin("view", "click", "error", "signup")).groupBy("event_type").agg(
        F.max(stamp17(F.col("ts"))).alias("high"), F.min(stamp17(F.col("ts"))).alias("low"))
    kept = newest.select(
        F.col("event_type").alias("table_name"),
        F.when(F.col("event_type") == "error", F.col("low"))
        .when(F.col("event_type") != "signup", F.col("high")).cast("string").alias("watermark"))
    idle = events.agg(F.lit("idle_table").alias("table_name"),
                      F.min(stamp17(F.col("ts"))).cast("string").alias("watermark"))
    return kept.unionByName(idle)


WATERMARKS = """
watermark_updates AS (
  SELECT event_type AS table_name, strftime(ts, '%Y%m%d%H%M%S%g') AS watermark FROM events),
watermark_store AS (
  SELECT event_type AS table_name,
         CASE WHEN event_type = 'error' THEN min(strftime(ts, '%Y%m%d%H%M%S%g'))
              WHEN event_type <> 'signup' THEN max(strftime(ts, '%Y%m%d%H%M%S%g')) END AS watermark
  FROM events WHERE event_type IN ('view', 'click', 'error', 'signup') GROUP BY event_type
  UNION ALL
  SELECT 'idle_table', min(strftime(ts, '%Y%m%d%H%M%S%g')) FROM events)"""
