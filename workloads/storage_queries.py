"""Queries that write and read back: load modes, versions, streaming, storage use.

Each call writes to a fresh folder below the session's checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeload.operators import merge, storage
from lakeload.plans.hash_rewrite import hash_parquet
from lakeload.plans.silver import merge_table
from lakeload.plans.spec import TableSpec
from lakeload.session import scratch_path
from lakeload.sources import bronze, landed, tables, versioned
from lakeload.streaming import ingest
from workloads import fixtures as fx
from workloads.book import query


def _database(spark) -> str:
    """A new database on the shared folder."""
    name = f"lakeload_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


# Three runs that together hold the whole table.
RUN_CASE = "CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END"
EVENT_RUNS = ["20240111T000000", "20240121T000000", "20240131T000000"]
RUN_SQL = f"{EVENT_RUNS!r}[{RUN_CASE} + 1]"


def _event_runs(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    for number, run in enumerate(EVENT_RUNS):
        yield run, events.where(F.expr(RUN_CASE) == number)


@query("bronze_snapshot", sql="""
SELECT *, '20010801T000000' AS _bronze_load_ts, true AS has_file FROM orders""")
def bronze_snapshot(spark, sf_dir):
    """Replace a table twice; only the last contents are left."""
    target = f"{_database(spark)}.orders"
    orders = fx.table(spark, sf_dir, "orders")
    bronze.write_snapshot(spark, target, landed.add_load_metadata(orders, fx.PREVIOUS_RUN), fx.PREVIOUS_RUN)
    bronze.write_snapshot(spark, target, landed.add_load_metadata(orders, fx.THIS_RUN), fx.THIS_RUN)
    return spark.table(target).withColumn("has_file", F.contains("_bronze_filename", F.lit("orders"))).drop("_bronze_filename")


@query("bronze_append_history", sql=f"""
SELECT *, {RUN_SQL} AS _bronze_load_ts FROM events""")
def bronze_append_history(spark, sf_dir):
    """Three runs appended, one of them twice; the repeated run must not double."""
    target = f"{_database(spark)}.events"
    for run, rows in _event_runs(spark, sf_dir):
        bronze.append_run(spark, target, rows, run)
        if run == EVENT_RUNS[1]:
            bronze.append_run(spark, target, rows, run)
    return spark.table(target)


@query("window_load_partitions", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS p_year, CAST(month(o_orderdate) AS INTEGER) AS p_month,
       count(*) AS n_rows, min(o_orderkey) AS first_key
FROM orders GROUP BY ALL""")
def window_load_partitions(spark, sf_dir):
    target = f"{_database(spark)}.orders"
    bronze.write_window(spark, target, fx.table(spark, sf_dir, "orders"), fx.THIS_RUN, "o_orderdate", by_month=True)
    return spark.table(target).groupBy("p_year", "p_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key"))


@query("window_replace_months", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS p_year, CAST(month(o_orderdate) AS INTEGER) AS p_month,
       count(*) AS n_rows
FROM orders o
WHERE o_orderdate < TIMESTAMP '2000-01-01' OR o_orderstatus <> 'P'
   OR NOT EXISTS (SELECT 1 FROM orders m WHERE m.o_orderstatus <> 'P'
                  AND date_trunc('month', m.o_orderdate) = date_trunc('month', o.o_orderdate))
GROUP BY ALL""")
def window_replace_months(spark, sf_dir):
    """Load all months, then land the months from 2000 on again without pending orders; a month
    that is not landed again keeps its rows."""
    target = f"{_database(spark)}.orders"
    orders = fx.table(spark, sf_dir, "orders")
    bronze.replace_months(spark, target, orders, "o_orderdate")
    recent = orders.where("o_orderdate >= TIMESTAMP_NTZ '2000-01-01' AND o_orderstatus <> 'P'")
    bronze.replace_months(spark, target, recent, "o_orderdate")
    return spark.table(target).groupBy("p_year", "p_month").agg(F.count(F.lit(1)).alias("n_rows"))


@query("stored_merge", sql=f"""
WITH runs AS (SELECT *, {RUN_SQL} AS run FROM events),
newest AS (
  SELECT user_id, event_id, event_type, run, min(run) OVER (PARTITION BY user_id) AS first_run
  FROM runs QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY run DESC, event_id DESC) = 1)
SELECT user_id, event_id, event_type, first_run AS _silver_inserted_ts, run AS _silver_updated_ts, is_deleted
FROM (SELECT n.* EXCLUDE (first_run), (SELECT min(run) FROM runs r WHERE r.user_id = n.user_id) AS first_run,
             false AS is_deleted FROM newest n)""")
def stored_merge(spark, sf_dir):
    """Three runs through history, current state and bucketed silver versions, by the merge job."""
    database = _database(spark)
    spec = TableSpec("events", "incremental", f"{database}.events", f"{database}.silver", ("user_id",), "event_id")
    for run, rows in _event_runs(spark, sf_dir):
        bronze.append_run(spark, spec.bronze_table, rows, run)
        result = merge_table(spark, spec, "shop", "id", run)
        if result["status"] != "SUCCESS":
            raise RuntimeError(result["error_message"])
    return spark.table(spec.silver_table).select(
        "user_id", "event_id", "event_type", "_silver_inserted_ts", "_silver_updated_ts", "is_deleted")


@query("state_versions", sql="""
SELECT run_ts, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers FROM (
  SELECT '20010701T000000' AS run_ts, o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
  UNION ALL SELECT '20010801T000000', o_custkey FROM orders) GROUP BY run_ts""")
def state_versions(spark, sf_dir):
    """Two versions of a table, each read as of its run."""
    target = f"{_database(spark)}.orders"
    orders = fx.table(spark, sf_dir, "orders")
    for run, rows in ((fx.PREVIOUS_RUN, orders.where("o_orderdate < TIMESTAMP_NTZ '2000-01-01'")), (fx.THIS_RUN, orders)):
        versioned.write_version(spark, target, rows, run, bucket_by=["o_orderkey"])
    views = [versioned.read_as_of(spark, target, run).withColumn("run_ts", F.lit(run))
             for run in (fx.PREVIOUS_RUN, fx.THIS_RUN)]
    return views[0].unionByName(views[1]).groupBy("run_ts").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_custkey").alias("n_customers"))


@query("compacted_table", sql="""
SELECT * FROM lineitem""")
def compacted_table(spark, sf_dir):
    """A table rewritten in ranges of its clustering columns."""
    target = f"{_database(spark)}.lineitem"
    versioned.write_version(spark, target, fx.table(spark, sf_dir, "lineitem"), fx.THIS_RUN)
    versioned.compact(spark, target, ["l_shipdate", "l_partkey"])
    return spark.table(target)


@query("exported_table", sql="SELECT * FROM customer")
def exported_table(spark, sf_dir):
    target, path = f"{_database(spark)}.customer", scratch_path(spark, "export")
    bronze.write_snapshot(spark, target, fx.table(spark, sf_dir, "customer"), fx.THIS_RUN, keep_versions=False)
    tables.export_parquet(spark, target, path)
    return spark.read.parquet(path)


def _land_events(spark, sf_dir, kind="events"):
    root = scratch_path(spark, "landing")
    for run, rows in _event_runs(spark, sf_dir):
        rows.write.parquet(landed.landed_path(root, "shop", run, kind))
    return root


@query("stream_ingest", sql=f"""
SELECT *, {RUN_SQL} AS _bronze_load_ts FROM events""")
def stream_ingest(spark, sf_dir):
    """Landed runs picked up by a stream; a second start finds nothing new."""
    root, target = _land_events(spark, sf_dir), f"{_database(spark)}.events"
    checkpoint = scratch_path(spark, "stream")
    schema = fx.table(spark, sf_dir, "events").schema
    for _ in range(2):
        stream = ingest.landed_stream(spark, root, "shop", "events", schema)
        ingest.ingest(spark, stream, target, checkpoint).awaitTermination()
    return spark.table(target).drop(ingest.BATCH_COLUMN, "_bronze_filename")


TEXT_BYTES = """
text_bytes AS (
  SELECT 'source=' || source AS source, 'lang=' || lang AS lang, strlen(replace(text, chr(10), ' ')) + 1 AS bytes
  FROM documents)"""


def _land_text(spark, sf_dir):
    """Documents as plain text lines, one file per source and language."""
    root = scratch_path(spark, "text")
    docs = fx.table(spark, sf_dir, "documents").select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("value"), "source", "lang")
    docs.repartition("source", "lang").write.partitionBy("source", "lang").text(root)
    return root


@query("storage_by_level", ctes=(TEXT_BYTES,), sql="""
SELECT source AS folder, CAST(sum(bytes) AS BIGINT) AS size_bytes, count(DISTINCT lang) AS n_files
FROM text_bytes WHERE lang <> 'lang=en' GROUP BY source
UNION ALL SELECT source || '/' || lang, CAST(sum(bytes) AS BIGINT), CAST(1 AS BIGINT) FROM text_bytes WHERE lang = 'lang=en' GROUP BY ALL""")
def storage_by_level(spark, sf_dir):
    """Bytes and files per source folder without English, and per language folder of English."""
    files = storage.file_sizes(spark, _land_text(spark, sf_dir))
    english = storage.size_by_level(storage.filter_levels(files, {2: "lang=en"}), 2)
    return storage.size_by_level(files.where(F.get("levels", F.lit(1)) != "lang=en"), 1).unionByName(english)


@query("largest_folders", ctes=(TEXT_BYTES,), sql="""
SELECT source || '/' || lang AS folder, CAST(1 AS BIGINT) AS n_files, round(sum(bytes) / 1048576, 2) AS size_mb,
       round(sum(bytes) / 1073741824, 2) AS size_gb
FROM text_bytes GROUP BY source, lang ORDER BY sum(bytes) DESC, folder LIMIT 20""")
def largest_folders(spark, sf_dir):
    files = storage.file_sizes(spark, _land_text(spark, sf_dir))
    return storage.largest_folders(storage.size_by_level(files, 2))


@query("null_key_rows", sql="""
SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
WHERE doc_id IS NULL OR quality IS NULL""")
def null_key_rows(spark, sf_dir):
    """Rows a merge would set aside: documents whose label, part of the key, is missing."""
    labelled = fx.table(spark, sf_dir, "documents").select("doc_id").join(
        fx.table(spark, sf_dir, "labels"), ["doc_id"], "left")
    return merge.null_key_rows(labelled, ["doc_id", "quality"])


@query("hashed_parquet", sql="""
SELECT *, sha256(concat_ws('|', coalesce(CAST(c_custkey AS VARCHAR), '∅'), coalesce(c_mktsegment, '∅'),
         coalesce(c_name, '∅'), coalesce(CAST(c_nationkey AS VARCHAR), '∅'))) AS row_hash
FROM customer""")
def hashed_parquet(spark, sf_dir):
    """Files rewritten with a hash of all but the floating-point column."""
    path = scratch_path(spark, "hashed")
    hash_parquet(spark, f"{sf_dir}/customer.parquet", path, exclude_cols=["c_acctbal"])
    return spark.read.parquet(path)
