"""Configuration and data written to files, read back, and used."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lakeload.functions import stamps
from lakeload.operators import metadata, registry, watermarks
from lakeload.plans.registry_build import write_registries
from lakeload.plans.watermark_merge import merge_watermarks
from lakeload.session import scratch_path
from lakeload.sources import configs, landed
from workloads import config_queries as cq
from workloads import fixtures as fx
from workloads.book import query


@query("registry_round_trip", ctes=(fx.COLUMN_METADATA, cq.SOURCES), sql=f"""
SELECT source, name, CAST(enabled AS VARCHAR) AS enabled, size_class, load_mode, base_query,
       CASE WHEN load_mode = 'incremental' THEN filter_column END AS incremental_column,
       CASE WHEN load_mode = 'window' THEN partition_column END AS window_column,
       source || '.' || name AS bronze_table
FROM ({cq.joined_registry_sql(True)})""")
def registry_round_trip(spark, sf_dir):
    """Registry files of all sources, written and read again."""
    path = scratch_path(spark, "registry")
    write_registries(registry.registry_documents(cq._joined_registry(spark, sf_dir)), path)
    tables = registry.with_targets(configs.read_registry(spark, f"{path}/*/*.txt"))
    return tables.select("source", "name", "enabled", "size_class", "load_mode", "base_query",
                         "incremental_column", "window_column", "bronze_table")


@query("registry_violations", sql="""
WITH documents AS (SELECT n_name AS source, n_nationkey FROM nation),
tables_of AS (
  SELECT d.source, s_suppkey, row_number() OVER (PARTITION BY d.source ORDER BY s_suppkey) - 1 AS position,
         s_acctbal < 0 AS nameless, CASE WHEN s_acctbal > 5000 THEN 'window_replace' ELSE 'snapshot' END AS load_mode
  FROM documents d JOIN supplier ON s_nationkey = n_nationkey)
SELECT source, CAST(NULL AS INTEGER) AS position, 'no tables are defined' AS problem, true AS fatal
FROM documents WHERE source NOT IN (SELECT source FROM tables_of)
UNION ALL SELECT source, CAST(position AS INTEGER), 'table without name', true FROM tables_of WHERE nameless
UNION ALL SELECT source, CAST(position AS INTEGER), 'unsupported load mode window_replace', false
FROM tables_of WHERE load_mode = 'window_replace'""")
def registry_violations(spark, sf_dir):
    """One document per nation with its suppliers as tables; some lack a name."""
    nations, suppliers = fx.table(spark, sf_dir, "nation"), fx.table(spark, sf_dir, "supplier")
    entry = F.struct(
        F.col("s_suppkey").alias("position"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("name"),
        F.when(F.col("s_acctbal") > 5000, "window_replace").otherwise("Snapshot").alias("load_mode"))
    joined = nations.join(suppliers, nations.n_nationkey == suppliers.s_nationkey, "left")
    documents = joined.groupBy(F.col("n_name").alias("source")).agg(
        F.array_sort(F.collect_list(F.when(F.col("s_suppkey").isNotNull(), entry))).alias("tables"))
    return registry.registry_violations(documents)


def _land_watermarks(spark, sf_dir) -> str:
    """Runtime watermarks, one folder per table."""
    path = scratch_path(spark, "runtime")
    updates = fx.watermark_updates(spark, sf_dir).select("table_name", "watermark")
    updates.withColumn("table", F.col("table_name")).drop("table_name").write.partitionBy("table").parquet(path + "-parts")
    for row in updates.select("table_name").distinct().collect():
        (spark.read.parquet(f"{path}-parts/table={row.table_name}").write.parquet(f"{path}/{row.table_name}"))
    return path


# Each table's marks in another type; purchases leave files without the column.
MIXED_MARKS = """
mixed AS (
  SELECT 'click' AS table_name, CAST(max(epoch_us(ts)) AS VARCHAR) AS watermark FROM events WHERE event_type = 'click'
  UNION ALL SELECT 'error', strftime(max(ts), '%Y-%m-%d') FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'signup', strftime(date_trunc('second', max(ts)), '%Y-%m-%d %H:%M:%S') FROM events WHERE event_type = 'signup'
  UNION ALL SELECT 'view', lpad(CAST(max(event_id) AS VARCHAR), 12, '0') FROM events WHERE event_type = 'view')"""


def _land_mixed_watermarks(spark, sf_dir) -> str:
    path, events = scratch_path(spark, "runtime"), fx.table(spark, sf_dir, "events")
    marks = {"click": F.unix_micros(F.col("ts").cast("timestamp")), "error": F.to_date("ts"), "signup": F.date_trunc("second", "ts"),
             "view": F.lpad(F.col("event_id").cast("string"), 12, "0")}
    for name, mark in marks.items():
        events.where(F.col("event_type") == name).select(mark.alias("watermark")).write.parquet(f"{path}/{name}")
    events.where("event_type = 'purchase'").select("event_id").write.parquet(f"{path}/purchase")
    return path


@query("mixed_watermarks", ctes=(MIXED_MARKS,), sql="SELECT * FROM mixed")
def mixed_watermarks(spark, sf_dir):
    """Folders whose marks differ in type, and one without marks."""
    return watermarks.max_watermarks(configs.read_runtime_watermarks(spark, _land_mixed_watermarks(spark, sf_dir)))


# One table per type; marks below zero and of several lengths.
TYPED_MARKS = """
typed AS (
  SELECT 'bigint' AS table_name, CAST(max(o_orderkey) AS VARCHAR) AS watermark FROM orders
  UNION ALL SELECT 'smallint', CAST(max(o_orderkey % 130 - 120) AS VARCHAR) FROM orders
  UNION ALL SELECT 'decimal_whole', CAST(max(o_custkey) AS VARCHAR) FROM orders
  UNION ALL SELECT 'decimal_below', CAST(max(-CAST(o_totalprice AS DECIMAL(38, 6))) AS VARCHAR) FROM orders
  UNION ALL SELECT 'decimal_wide', CAST(max(CAST(o_totalprice AS DECIMAL(38, 12)) - 5000) AS VARCHAR) FROM orders
  UNION ALL SELECT 'double', CAST(max(c_acctbal) AS VARCHAR) FROM customer
  UNION ALL SELECT 'date', CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders
  UNION ALL SELECT 'timestamp', strftime(date_trunc('second', max(ts)), '%Y-%m-%d %H:%M:%S') FROM events
  UNION ALL SELECT 'text', max(o_orderpriority) FROM orders)"""


def _land_typed_watermarks(spark, sf_dir) -> str:
    path = scratch_path(spark, "runtime")
    orders, customers, events = (fx.table(spark, sf_dir, name) for name in ("orders", "customer", "events"))
    marks = {
        "bigint": (orders, F.col("o_orderkey").cast("bigint")), "smallint": (orders, (F.col("o_orderkey") % 130 - 120).cast("smallint")),
        "decimal_whole": (orders, F.col("o_custkey").cast("decimal(18,0)")),
        "decimal_below": (orders, -F.col("o_totalprice").cast("decimal(38,6)")),
        "decimal_wide": (orders, (F.col("o_totalprice").cast("decimal(38,12)") - F.lit(5000)).cast("decimal(38,12)")),
        "double": (customers, F.col("c_acctbal").cast("double")), "date": (orders, F.to_date("o_orderdate")),
        "timestamp": (events, F.date_trunc("second", "ts")), "text": (orders, F.col("o_orderpriority"))}
    for name, (source, mark) in marks.items():
        source.select(mark.alias("watermark")).write.parquet(f"{path}/{name}")
    return path


@query("typed_watermarks", ctes=(TYPED_MARKS,), sql="SELECT * FROM typed")
def typed_watermarks(spark, sf_dir):
    """Folders whose marks are of nine types, each compared as its type says."""
    return watermarks.max_watermarks(configs.read_runtime_watermarks(spark, _land_typed_watermarks(spark, sf_dir)))


@query("incremental_kinds", sql="""
SELECT 'date' AS kind, o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1997-01-01'
UNION ALL SELECT 'stamp17', o_orderkey FROM orders
WHERE CAST(strftime(CAST(o_orderdate AS TIMESTAMP), '%Y%m%d') || '000000000' AS BIGINT) > 19970101000000000
UNION ALL SELECT 'number', o_orderkey FROM orders WHERE CAST(o_totalprice AS DECIMAL(12, 2)) > 100000.005""")
def incremental_kinds(spark, sf_dir):
    """Rows beyond marks of several kinds."""
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"), stamps.stamp17(F.col("o_orderdate").cast("timestamp_ntz")).alias("stamp17"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("number"))
    marks = {"date": "1997-01-01", "stamp17": "19970101000000000", "number": "100000.005"}
    parts = [watermarks.incremental_filter(orders, kind, kind, mark).select(F.lit(kind).alias("kind"), "o_orderkey")
             for kind, mark in marks.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("mixed_watermark_job", ctes=(MIXED_MARKS,), sql="""
SELECT 'shop' AS source, table_name, watermark FROM mixed
UNION ALL SELECT 'shop', 'purchase', '0012'
UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), '0' || page_id || ' "' || url || '"' FROM pages""")
def mixed_watermark_job(spark, sf_dir):
    """The same folders merged into a map whose other marks have leading zeros and quotes."""
    stored, target = scratch_path(spark, "marks"), scratch_path(spark, "marks")
    pages = fx.table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source"), F.col("page_id").cast("string").alias("table_name"),
        F.concat(F.lit("0"), "page_id", F.lit(' "'), "url", F.lit('"')).alias("watermark"))
    mine = spark.createDataFrame([("shop", "purchase", "0012"), ("shop", "click", "1")], pages.schema)
    configs.write_document(configs.watermark_document(pages.unionByName(mine)), stored)
    merge_watermarks(spark, _land_mixed_watermarks(spark, sf_dir), stored, "shop", "run", target, monotonic=True)
    return configs.read_watermark_map(spark, target)


@query("concurrent_watermarks", sql="""
SELECT 'shop_' || o_custkey % 8 AS source, 'orders' AS table_name, CAST(max(o_orderkey) AS VARCHAR) AS watermark FROM orders GROUP BY ALL
UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), '0' || page_id FROM pages""")
def concurrent_watermarks(spark, sf_dir):
    """Eight sources bring their marks up to date at the same time, for two runs; one source repeats the first run after the second."""
    stored, store, landing = (scratch_path(spark, label) for label in ("marks", "store", "runtime"))
    shop = F.concat(F.lit("shop_"), F.col("o_custkey") % 8)
    runs = {"20240101T000000": "watermark % 2 = 0", "20240102T000000": "true"}
    orders = fx.table(spark, sf_dir, "orders").select(shop.alias("source"), F.col("o_orderkey").cast("bigint").alias("watermark"))
    for run, rows in runs.items():
        (orders.where(rows)
         .write.partitionBy("source").parquet(f"{landing}/{run}"))
    first = orders.select("source", F.lit("orders").alias("table_name"), F.lit("-1").alias("watermark")).distinct()
    pages = fx.table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source"), F.col("page_id").cast("string").alias("table_name"), F.concat(F.lit("0"), "page_id").alias("watermark"))
    configs.write_document(configs.watermark_document(first.unionByName(pages)), stored)
    names = [f"shop_{i}" for i in range(8)]

    def job(run, source):
        # The run's files of this source, as one table folder.
        place = scratch_path(spark, "run")
        spark.read.parquet(f"{landing}/{run}/source={source}").write.parquet(f"{place}/orders")
        merge_watermarks(spark, place, stored, source, run, monotonic=True, store_path=store, run_ts=run)

    with ThreadPoolExecutor(8) as jobs:
        for run in runs:
            list(jobs.map(lambda name, run=run: job(run, name), names))
    job(list(runs)[0], names[0])
    return configs.read_mark_store(spark, store, stored)


@query("runtime_watermarks", ctes=cq.MARKS, sql="SELECT * FROM newest")
def runtime_watermarks(spark, sf_dir):
    """All table folders of a run in one scan."""
    return watermarks.max_watermarks(configs.read_runtime_watermarks(spark, _land_watermarks(spark, sf_dir)), "stamp17")


@query("watermark_job", ctes=cq.MARKS, sql="""
SELECT 'shop' AS source, coalesce(s.table_name, n.table_name) AS table_name, coalesce(n.watermark, s.watermark) AS watermark
FROM newest n FULL JOIN watermark_store s ON n.table_name = s.table_name
UNION ALL SELECT 'other', table_name, watermark FROM watermark_store""")
def watermark_job(spark, sf_dir):
    """Stored map as a file, merged with a run's watermarks into a new file."""
    stored, target = scratch_path(spark, "marks"), scratch_path(spark, "marks")
    marks = fx.watermark_store(spark, sf_dir)
    both = marks.withColumn("source", F.lit("shop")).unionByName(marks.withColumn("source", F.lit("other")))
    configs.write_document(configs.watermark_document(both), stored)
    merge_watermarks(spark, _land_watermarks(spark, sf_dir), stored, "shop", "run", target, kind="stamp17")
    return configs.read_watermark_map(spark, target)


@query("read_formats", sql="""
SELECT kind, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer, (VALUES ('csv'), ('json'), ('parquet')) k(kind)""")
def read_formats(spark, sf_dir):
    """One table through each file format, with reader options."""
    customers = fx.table(spark, sf_dir, "customer")
    parts = []
    for kind in ("csv", "json", "parquet"):
        path = scratch_path(spark, kind)
        customers.write.options(**({"header": True, "sep": ";"} if kind == "csv" else {})).format(kind).save(path)
        options = {"header": True, "sep": ";", "inferSchema": True} if kind == "csv" else {}
        read = landed.read_files(spark, kind, path, **options)
        parts.append(read.select(F.lit(kind).alias("kind"), *[
            F.col(f.name).cast(f.dataType).alias(f.name) for f in customers.schema.fields]))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


ORDER_TYPES = [
    ("o_orderkey", "decimal", 12, 0), ("o_custkey", "int", None, None), ("o_orderstatus", "nvarchar", None, None),
    ("o_totalprice", "money", None, None), ("o_orderdate", "time", None, None), ("o_orderpriority", "cursor", None, None)]


@query("conformed_types", sql="""
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) AS o_totalprice,
       strftime(o_orderdate, '%H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders""")
def conformed_types(spark, sf_dir):
    """Orders with the types a source system's metadata asks for."""
    described = spark.createDataFrame(
        [(*row, i) for i, row in enumerate(ORDER_TYPES)],
        "column_name string, data_type string, numeric_precision int, numeric_scale int, ordinal_position int")
    typed = metadata.conform_types(fx.table(spark, sf_dir, "orders"), described)
    return typed.withColumns({c: F.col(c).cast("double") for c in ("o_orderkey", "o_totalprice")})


@query("metadata_scan", ctes=(fx.COLUMN_METADATA,), sql="""
SELECT obj_name, count(*) AS n_columns FROM column_metadata WHERE max_len >= 10 GROUP BY obj_name""")
def metadata_scan(spark, sf_dir):
    """Metadata files; rows without an object name are left out."""
    path = scratch_path(spark, "metadata")
    columns = fx.column_metadata(spark, sf_dir)
    columns.withColumn("obj_name", F.when(F.col("max_len") >= 10, F.col("obj_name"))).write.parquet(path)
    return metadata.load_metadata(spark, path).groupBy("obj_name").agg(F.count(F.lit(1)).alias("n_columns"))
