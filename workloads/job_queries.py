"""The jobs themselves, end to end: loads, merges, replays, runs, logs, versions.

Each call works in databases of its own, which it names after a fresh id; log rows carry that id as their
source, and what a query returns leaves it out.
"""

from __future__ import annotations

import functools
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.operators import runlog
from lakeload.operators.current import LOAD_COLUMN
from lakeload.plans.bronze import load_table
from lakeload.plans.registry_build import build_registry, write_registries
from lakeload.plans.silver import merge_table
from lakeload.plans.source_run import run_source
from lakeload.plans.spec import TableSpec
from lakeload.plans.tuning_report import tuning_report
from lakeload.schemas import BRONZE_LOG, BRONZE_SUMMARY, SILVER_LOG, SILVER_SUMMARY
from lakeload.session import scratch_path
from lakeload.sources import bronze, configs, covered, histories, landed, logs, tables, versioned
from lakeload.sources.files import matching_paths
from workloads import config_queries as cq
from workloads import fixtures as fx
from workloads.book import query
from workloads.storage_queries import EVENT_RUNS, RUN_CASE, RUN_SQL, _database, _event_runs, _land_events

EVENT_STATE = f"""
runs AS (SELECT *, {RUN_SQL} AS run FROM events),
event_state AS (
  SELECT user_id, event_id, event_type, (SELECT min(run) FROM runs r WHERE r.user_id = n.user_id) AS _silver_inserted_ts,
         run AS _silver_updated_ts, false AS is_deleted
  FROM runs n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY run DESC, event_id DESC) = 1)"""


def _event_spec(database: str, mode: str = "incremental") -> TableSpec:
    return TableSpec("events", mode, f"{database}.events", f"{database}.silver", ("user_id",), "event_id")


def _done(record: dict) -> dict:
    if record["status"] != "SUCCESS":
        raise RuntimeError(f"{record['table_name']}: {record['status']} {record['error_message']}")
    return record


ORDER_DAYS = {"20240101T000000": "1998-01-01", "20240102T000000": "2001-01-01", "20240103T000000": "9999-01-01"}


@query("snapshot_replay", sql="""
SELECT state, o_orderkey, o_orderstatus FROM orders,
  (VALUES ('now', TIMESTAMP '9999-01-01'), ('20240101T000000', TIMESTAMP '1998-01-01'),
          ('20240102T000000', TIMESTAMP '2001-01-01')) s(state, day)
WHERE o_orderdate < day""")
def snapshot_replay(spark, sf_dir):
    """Three snapshots, then the second and the first again: readers keep the third, every version can be read."""
    target = f"{_database(spark)}.orders"
    orders = fx.table(spark, sf_dir, "orders")
    runs = list(ORDER_DAYS)
    for run in (*runs, runs[1], runs[0]):
        bronze.write_snapshot(spark, target, orders.where(F.col("o_orderdate") < F.lit(ORDER_DAYS[run])), run)
    states = [spark.table(target).withColumn("state", F.lit("now"))]
    states += [versioned.read_as_of(spark, target, r).withColumn("state", F.lit(r)) for r in runs[:2]]
    return states[0].unionByName(states[1]).unionByName(states[2]).select("state", "o_orderkey", "o_orderstatus")


@query("silver_replay", ctes=(EVENT_STATE,), sql="SELECT * FROM event_state")
def silver_replay(spark, sf_dir):
    """Load and merge three runs, then merge the second and the first again; the state is that of the straight run."""
    spec, root = _event_spec(_database(spark)), _land_events(spark, sf_dir)
    for run in EVENT_RUNS:
        _done(load_table(spark, spec, "shop", "id", run, root))
        _done(merge_table(spark, spec, "shop", "id", run))
    for run in (EVENT_RUNS[1], EVENT_RUNS[0]):
        _done(merge_table(spark, spec, "shop", "id", run))
    return spark.table(spec.silver_table).select(
        "user_id", "event_id", "event_type", "_silver_inserted_ts", "_silver_updated_ts", "is_deleted")


@query("late_commit", ctes=(EVENT_STATE,), sql="SELECT * FROM event_state")
def late_commit(spark, sf_dir):
    """A run written before a merge but committed after it, its files older than what that merge read: none is lost."""
    spec = _event_spec(_database(spark))
    first, late, last = _event_runs(spark, sf_dir)
    bronze.append_run(spark, spec.bronze_table, first[1], first[0])
    folder = f"{tables.table_location(spark, spec.bronze_table)}/{bronze.ATTEMPTS}/late/{LOAD_COLUMN}={late[0]}"
    late[1].write.parquet(folder)
    _done(merge_table(spark, spec, "shop", "id", first[0]))
    bronze.append_run(spark, spec.bronze_table, last[1].where("event_id % 2 = 0"), last[0])
    _done(merge_table(spark, spec, "shop", "id", last[0]))
    spark.sql(f"ALTER TABLE {spec.bronze_table} ADD PARTITION ({LOAD_COLUMN} = '{late[0]}') LOCATION '{folder}'")
    bronze.append_run(spark, spec.bronze_table, last[1], last[0])
    _done(merge_table(spark, spec, "shop", "id", late[0]))
    return spark.table(spec.silver_table).select(
        "user_id", "event_id", "event_type", "_silver_inserted_ts", "_silver_updated_ts", "is_deleted")


@query("failed_replay", sql=f"""
WITH runs AS (SELECT *, {RUN_SQL} AS run FROM events)
SELECT 'after the failure' AS state, event_id, event_type, run FROM runs
UNION ALL SELECT 'after the next', event_id, event_type, run FROM runs WHERE run <> '{EVENT_RUNS[1]}' OR event_id % 2 = 0""")
def failed_replay(spark, sf_dir):
    """A replay that fails while it writes leaves the run as it was; the next one replaces it."""
    target = f"{_database(spark)}.events"
    for run, rows in _event_runs(spark, sf_dir):
        bronze.append_run(spark, target, rows, run)
    again = spark.table(target).where(F.col(LOAD_COLUMN) == EVENT_RUNS[1]).drop(LOAD_COLUMN)
    last = again.agg(F.max("event_id")).first()[0]
    broken = again.withColumn("event_type", F.when(F.col("event_id") == last, F.raise_error(F.lit("lost"))).otherwise(F.col("event_type")))
    try:
        bronze.append_run(spark, target, broken, EVENT_RUNS[1])
    except Exception as error:
        if "lost" not in str(error):
            raise
    kept = scratch_path(spark, "kept")
    columns = [F.col("event_id"), F.col("event_type"), F.col(LOAD_COLUMN).alias("run")]
    spark.table(target).select(F.lit("after the failure").alias("state"), *columns).write.parquet(kept)
    bronze.append_run(spark, target, again.where("event_id % 2 = 0"), EVENT_RUNS[1])
    return spark.read.parquet(kept).unionByName(spark.table(target).select(F.lit("after the next").alias("state"), *columns))


@query("compacted_history", sql=f"""
WITH runs AS (SELECT *, {RUN_SQL} AS run FROM events)
SELECT 'row' AS fact, event_id AS number, user_id, event_type, run FROM runs
UNION ALL SELECT 'files beyond the target', 0, NULL, NULL, run FROM runs GROUP BY run
UNION ALL SELECT 'state', count(DISTINCT user_id), NULL, NULL, NULL FROM runs
UNION ALL SELECT 'whole reads', 1, NULL, NULL, NULL""")
def compacted_history(spark, sf_dir):
    """A history of many small files between two merges: rows as before, few files, and the next merge reads new loads only."""
    spec, size = _event_spec(_database(spark)), 1 << 16
    first, second, last = _event_runs(spark, sf_dir)
    for run, rows in (first, second):
        bronze.append_run(spark, spec.bronze_table, rows.repartition(24), run)
        _done(merge_table(spark, spec, "shop", "id", run))
    bronze.append_run(spark, spec.bronze_table, last[1].repartition(24), last[0])
    histories.compact_history(spark, spec.bronze_table, size, silver=[spec.silver_table])
    _done(merge_table(spark, spec, "shop", "id", last[0]))
    files = covered.listed_files(spark, spec.bronze_table, histories.ALL_RUNS)
    beyond = F.greatest(F.lit(0), F.count("file") - F.ceil((F.sum("length") + F.lit(size - 1)) / size))
    none = F.lit(None)
    recorded = spark.table(spec.silver_table + covered.SUFFIX).where("whole").select(LOAD_COLUMN).distinct()
    columns = ["fact", "number", "user_id", "event_type", "run"]
    parts = [
        spark.table(spec.bronze_table).select(F.lit("row"), "event_id", "user_id", "event_type", LOAD_COLUMN),
        files.groupBy("load").agg(beyond.alias("n")).select(F.lit("files beyond the target"), "n", none, none, "load"),
        spark.table(spec.silver_table).agg(F.count("*").alias("n")).select(F.lit("state"), "n", none, none, none),
        recorded.agg(F.count("*").alias("n")).select(F.lit("whole reads"), "n", none, none, none)]
    return functools.reduce(DataFrame.unionAll, [p.toDF(*columns) for p in parts])


@query("history_left", ctes=(EVENT_STATE,), sql=f"""
SELECT 'bronze' AS layer, user_id, event_id, run AS run_ts, false AS is_deleted FROM runs WHERE run > '{EVENT_RUNS[0]}'
UNION ALL SELECT 'silver', user_id, event_id, _silver_updated_ts, false FROM event_state""")
def history_left(spark, sf_dir):
    """Loads that silver covers are removed, newer ones stay; later merges, a repeated one included, lose no key."""
    spec = _event_spec(_database(spark))
    first, second, last = _event_runs(spark, sf_dir)
    bronze.append_run(spark, spec.bronze_table, first[1], first[0])
    _done(merge_table(spark, spec, "shop", "id", first[0]))
    bronze.append_run(spark, spec.bronze_table, second[1], second[0])
    histories.remove_covered_loads(spark, spec.bronze_table, last[0], [spec.silver_table])
    bronze.append_run(spark, spec.bronze_table, last[1], last[0])
    for run in (second[0], last[0], second[0]):
        _done(merge_table(spark, spec, "shop", "id", run))
    return spark.table(spec.bronze_table).select(F.lit("bronze").alias("layer"), "user_id", "event_id", F.col(LOAD_COLUMN).alias("run_ts"),
                                                 F.lit(False).alias("is_deleted")).unionAll(
        spark.table(spec.silver_table).select(F.lit("silver"), "user_id", "event_id", "_silver_updated_ts", "is_deleted"))


@query("versioned_facts", sql="""
SELECT form, fact, value FROM (SELECT count(*) AS n FROM customer), (VALUES ('snapshot'), ('history'), ('state')) f(form),
  LATERAL (VALUES ('located', 1), ('rows with statistics', n), ('dropped', 1), ('exists after', 0)) s(fact, value)""")
def versioned_facts(spark, sf_dir):
    """Place, statistics and drop of a table in each form that loads and merges give it."""
    database = _database(spark)
    customers = fx.table(spark, sf_dir, "customer")
    spec = TableSpec("history", "incremental", f"{database}.history", f"{database}.state", ("c_custkey",))
    bronze.write_snapshot(spark, f"{database}.snapshot", customers, fx.THIS_RUN)
    bronze.append_run(spark, spec.bronze_table, customers, fx.THIS_RUN)
    _done(merge_table(spark, spec, "shop", "id", fx.THIS_RUN))
    facts = []
    for form in ("snapshot", "history", "state"):
        target = f"{database}.{form}"
        facts.append((form, "located", int(bool(matching_paths(spark, tables.table_location(spark, target))))))
        tables.analyze(spark, target)
        known = tables.described(spark, tables.stored_table(spark, target), "Statistics")
        facts.append((form, "rows with statistics", int(known.split(",")[1].split()[0])))
        facts.append((form, "dropped", int(tables.drop_table(spark, target))))
        facts.append((form, "exists after", int(tables.table_exists(spark, target) or bool(versioned.versions(spark, target)))))
    return spark.createDataFrame(facts, "form string, fact string, value long")


@query("zordered_table", sql="SELECT * FROM orders")
def zordered_table(spark, sf_dir):
    """A snapshot laid out along three columns of different types."""
    target, shape = f"{_database(spark)}.orders", bronze.FileShape(zorder_by=("o_custkey", "o_orderdate", "o_orderpriority"))
    bronze.write_snapshot(spark, target, fx.table(spark, sf_dir, "orders"), EVENT_RUNS[0], shape=shape)
    return spark.table(target)


@query("snapshot_merge_replay", ctes=(fx.TYPED_ORDERS,), sql="""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN '20240101T000000'
       WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN '20240102T000000' ELSE '20240103T000000' END AS _silver_inserted_ts,
       false AS is_deleted
FROM typed_orders""")
def snapshot_merge_replay(spark, sf_dir):
    """A replayed silver run reads the snapshot of its own run, not today's."""
    database = _database(spark)
    spec = TableSpec("orders", "snapshot", f"{database}.orders", f"{database}.silver", ("o_orderkey",), sync_deletes=True)
    orders = fx.typed_orders(spark, sf_dir)
    for run, day in ORDER_DAYS.items():
        bronze.write_snapshot(spark, spec.bronze_table, orders.where(F.col("o_orderdate") < F.lit(day)), run)
        _done(merge_table(spark, spec, "shop", "id", run))
    _done(merge_table(spark, spec, "shop", "id", list(ORDER_DAYS)[0]))
    return spark.table(spec.silver_table).select("o_orderkey", "o_orderstatus", "_silver_inserted_ts", "is_deleted")


@query("mode_changes", sql=f"""
WITH n AS (SELECT count(*) FILTER ({RUN_CASE} = 0) AS a, count(*) FILTER ({RUN_CASE} = 1) AS b,
                  count(*) FILTER ({RUN_CASE} = 2) AS c FROM events)
SELECT step, status, n_rows FROM n, LATERAL (VALUES
  ('1 history', 'SUCCESS', a), ('2 snapshot refused', 'FAILED', a), ('3 snapshot rebuilt', 'SUCCESS', b),
  ('4 history refused', 'FAILED', b), ('5 history rebuilt', 'SUCCESS', c)) s(step, status, n_rows)""")
def mode_changes(spark, sf_dir):
    """A table changes its load mode: refused without ``allow_rebuild``, and then nothing is lost."""
    database, root = _database(spark), _land_events(spark, sf_dir)
    steps = []
    for step, mode, run, rebuild in (
            ("1 history", "incremental", 0, False), ("2 snapshot refused", "snapshot", 1, False),
            ("3 snapshot rebuilt", "snapshot", 1, True), ("4 history refused", "incremental", 2, False),
            ("5 history rebuilt", "incremental", 2, True)):
        spec = _event_spec(database, mode)
        record = load_table(spark, spec, "shop", "id", EVENT_RUNS[run], root, allow_rebuild=rebuild)
        steps.append((step, record["status"], tables.row_count(spark, spec.bronze_table)))
    return spark.createDataFrame(steps, "step string, status string, n_rows long")


@query("rejected_rows", sql="""
SELECT event_id, event_type FROM events WHERE event_type = (SELECT min(event_type) FROM events)""")
def rejected_rows(spark, sf_dir):
    """Rows without a key; the second merge covers two loads at once and sets aside those of both."""
    database = _database(spark)
    spec = _event_spec(database)
    least = fx.table(spark, sf_dir, "events").agg(F.min("event_type")).first()[0]
    for number, (run, rows) in enumerate(_event_runs(spark, sf_dir)):
        keyless = rows.withColumn("user_id", F.when(F.col("event_type") != least, F.col("user_id")))
        bronze.append_run(spark, spec.bronze_table, keyless, run)
        if number != 1:
            _done(merge_table(spark, spec, "shop", "id", run))
    return spark.table(f"{spec.silver_table}__rejected").select("event_id", "event_type")


@query("load_jobs", sql="""
SELECT name, load_mode, status, n_rows FROM (SELECT count(*) AS n FROM orders), LATERAL (VALUES
  ('snapshot', 'snapshot', 'SUCCESS', n), ('months', 'window', 'SUCCESS', n), ('history', 'incremental', 'SUCCESS', n),
  ('other', 'window_replace', 'SKIPPED', NULL), ('absent', 'snapshot', 'SKIPPED', 0), ('empty', 'incremental', 'EMPTY', 0),
  ('broken', 'snapshot', 'FAILED', NULL), ('replaced', 'window_replace', 'SUCCESS', n)) s(name, load_mode, status, n_rows)""")
def load_jobs(spark, sf_dir):
    """One landed table through every load mode and every outcome."""
    database, root, run = _database(spark), scratch_path(spark, "landing"), EVENT_RUNS[0]
    orders = fx.table(spark, sf_dir, "orders")
    for name in ("snapshot", "months", "history", "other", "replaced"):
        orders.write.parquet(landed.landed_path(root, "shop", run, name))
    orders.where("false").write.parquet(landed.landed_path(root, "shop", run, "empty"))
    path = landed.landed_path(root, "shop", run, "broken")
    orders.select(F.col("o_orderstatus").alias("value")).write.text(f"{path}/part-0.parquet")
    modes = {"snapshot": "snapshot", "months": "window", "history": "incremental", "other": "window_replace",
             "absent": "snapshot", "empty": "incremental", "broken": "snapshot", "replaced": "window_replace"}
    records = []
    for name, mode in modes.items():
        spec = TableSpec(name, mode, f"{database}.{name}", window_column="o_orderdate", by_month=name == "months")
        record = load_table(spark, spec, "shop", "id", run, root, month_replacement=name == "replaced")
        records.append((name, mode, record["status"], record["rows_processed"]))
    return spark.createDataFrame(records, "name string, load_mode string, status string, n_rows long")


@query("source_run", sql=f"""
WITH runs AS (SELECT *, {RUN_SQL} AS run FROM events),
first_two AS (SELECT * FROM runs WHERE run < '{EVENT_RUNS[2]}'),
loads AS (SELECT run, count(*) AS n FROM first_two GROUP BY run),
merges AS (
  SELECT r.run, count(DISTINCT user_id) FILTER (NOT EXISTS (
           SELECT 1 FROM first_two e WHERE e.user_id = r.user_id AND e.run < r.run)) AS n
  FROM first_two r GROUP BY r.run)
SELECT 'bronze' AS layer, run AS run_ts, 'events' AS name, 'SUCCESS' AS status, n AS n_rows FROM loads
UNION ALL SELECT 'silver', run, 'events', 'SUCCESS', n FROM merges
UNION ALL SELECT 'bronze', run, 'later', 'SKIPPED', 0 FROM loads, range(2)
UNION ALL SELECT 'summary', run, 'bronze', 'SUCCESS', n FROM loads
UNION ALL SELECT 'summary', run, 'bronze', 'SUCCESS', 0 FROM loads
UNION ALL SELECT 'summary', run, 'silver', 'SUCCESS', n FROM merges""")
def source_run(spark, sf_dir):
    """Two runs of a source, each started again at once: what succeeded is left alone, what did not is tried again."""
    source, name = f"shop_{uuid.uuid4().hex[:8]}", f"events_{uuid.uuid4().hex[:8]}"
    root = scratch_path(spark, "landing")
    for run, rows in _event_runs(spark, sf_dir):
        rows.write.parquet(landed.landed_path(root, source, run, name))
    registry = spark.createDataFrame(
        [(source, name, "incremental", ["user_id"], "event_id"), (source, "later", "snapshot", ["id"], None)],
        "source string, name string, load_mode string, business_keys array<string>, incremental_column string")
    document = registry.groupBy("source").agg(F.collect_list(F.struct(
        "name", "load_mode", "business_keys", F.col("source").alias("delta_schema"),
        F.to_json(F.struct(F.col("incremental_column").alias("filter_column"))).alias("incremental_column"))).alias("tables"))
    path = scratch_path(spark, "registry")
    document.select(F.to_json(F.struct("source", "tables")).alias("value")).write.text(path)
    chosen = configs.read_registry(spark, path)
    for run in EVENT_RUNS[:2]:
        for _ in range(2):
            run_source(spark, chosen, source, run, root, workers=2)
    short = F.regexp_replace("table_name", "_[0-9a-f]{8}$", "").alias("name")
    mine = F.col("source") == source
    parts = [
        spark.table(BRONZE_LOG).where(mine).select(
            F.lit("bronze").alias("layer"), "run_ts", short, "status", F.col("rows_processed").alias("n_rows")),
        spark.table(SILVER_LOG).where(mine).select(
            F.lit("silver").alias("layer"), "run_ts", short, "status", F.col("rows_inserted").alias("n_rows")),
        spark.table(BRONZE_SUMMARY).where(mine).select(
            F.lit("summary").alias("layer"), "run_ts", F.lit("bronze").alias("name"), "status", F.col("total_rows").alias("n_rows")),
        spark.table(SILVER_SUMMARY).where(mine).select(
            F.lit("summary").alias("layer"), "run_ts", F.lit("silver").alias("name"),
            F.when(F.col("tables_failed") == 0, "SUCCESS").otherwise("PARTIAL").alias("status"), F.col("total_inserts").alias("n_rows"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


LINE_LOG = """
line_log AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS log_id, l_returnflag || l_linestatus AS table_name,
         year(l_shipdate) || '0101T000000' AS run_ts, make_date(year(l_shipdate), 1, 1) AS run_date,
         ['SUCCESS', 'FAILED', 'EMPTY', 'SKIPPED'][1 + l_linenumber % 4] AS status,
         CAST(l_quantity AS BIGINT) AS rows_processed, l_orderkey % 8 AS writer
  FROM lineitem)"""


def _line_log(spark, sf_dir, source):
    day = F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1))
    statuses = F.array(*[F.lit(s) for s in ("SUCCESS", "FAILED", "EMPTY", "SKIPPED")])
    return fx.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("log_id"),
        F.concat("l_returnflag", "l_linestatus").alias("table_name"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit("0101T000000")).alias("run_ts"), day.alias("run_date"),
        statuses[(F.col("l_linenumber") % 4).cast("int")].alias("status"), F.col("l_quantity").cast("long").alias("rows_processed"),
        (F.col("l_orderkey") % 8).alias("writer"), F.lit(source).alias("source"), F.lit("id").alias("run_id"),
        F.lit("id").alias("run_log_id"))


@query("concurrent_logs", ctes=(LINE_LOG,), sql="""
SELECT log_id, table_name, run_ts, run_date, status, rows_processed FROM line_log""")
def concurrent_logs(spark, sf_dir):
    """Eight writers append to one log table at the same time; together they hold every row once."""
    source = uuid.uuid4().hex
    rows = _line_log(spark, sf_dir, source)
    logs.ensure_log_tables(spark)
    with ThreadPoolExecutor(8) as writers:
        list(writers.map(lambda i: logs.append_logs(spark, rows.where(F.col("writer") == i), BRONZE_LOG), range(8)))
    return spark.table(BRONZE_LOG).where(F.col("source") == source).select(
        "log_id", "table_name", "run_ts", "run_date", "status", "rows_processed")


@query("compacted_logs", ctes=(LINE_LOG,), sql="""
SELECT log_id, table_name, run_ts, run_date, status, rows_processed FROM line_log""")
def compacted_logs(spark, sf_dir):
    """Log folders of past days joined into one; no row is lost or doubled."""
    source = uuid.uuid4().hex
    rows = _line_log(spark, sf_dir, source)
    for half in ("writer < 4", "writer >= 4"):
        logs.append_logs(spark, rows.where(half), BRONZE_LOG)
    latest = rows.agg(F.max("run_date")).first()[0]
    logs.compact_log(spark, BRONZE_LOG, latest)
    return spark.table(BRONZE_LOG).where(F.col("source") == source).select(
        "log_id", "table_name", "run_ts", "run_date", "status", "rows_processed")


@query("log_records", sql="""
SELECT 'bronze' AS layer, n_name AS name, CASE WHEN n_regionkey = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       CASE WHEN n_regionkey = 0 THEN 100 + n_nationkey ELSE n_nationkey END AS n_rows FROM nation
UNION ALL SELECT 'bronze', 'late', 'SUCCESS', 1
UNION ALL SELECT 'silver', n_name, 'SUCCESS', n_nationkey FROM nation
UNION ALL SELECT 'bronze run', NULL, 'PARTIAL', sum(n_nationkey)::BIGINT FROM nation
UNION ALL SELECT 'silver run', NULL, NULL, sum(n_nationkey)::BIGINT FROM nation""")
def log_records(spark, sf_dir):
    """Batches, a single record, summaries and an upsert, with one table per nation."""
    source, run_ts = uuid.uuid4().hex, "20240506T070809"
    moment = fx.table(spark, sf_dir, "events").agg(F.min("ts")).first()[0]
    nations = fx.table(spark, sf_dir, "nation").collect()
    base = {"run_id": source, "run_ts": run_ts, "source": source, "start_time": moment, "end_time": moment}
    logs.log_batch(spark, [{**base, "table_name": n.n_name, "status": "FAILED", "rows_processed": n.n_nationkey,
                            "log_id": f"{source}-{n.n_nationkey}"} for n in nations], "bronze", source)
    logs.log_batch(spark, [{**base, "table_name": n.n_name, "status": "SUCCESS", "rows_inserted": n.n_nationkey,
                            "log_id": f"{source}-{n.n_nationkey}"} for n in nations], "silver")
    total = sum(n.n_nationkey for n in nations)
    summary = {**base, "run_start": moment, "run_end": moment, "total_tables": len(nations)}
    logs.log_summary(spark, {**summary, "tables_success": 0, "tables_empty": 0, "tables_failed": len(nations),
                             "tables_skipped": 0, "total_rows": total}, "bronze")
    logs.log_summary(spark, {**summary, "total_inserts": total}, "silver")
    fixed = fx.table(spark, sf_dir, "nation").where("n_regionkey = 0").select(
        F.concat(F.lit(f"{source}-"), F.col("n_nationkey")).alias("log_id"), F.col("n_name").alias("table_name"),
        F.lit("SUCCESS").alias("status"), (F.col("n_nationkey") + 100).cast("long").alias("rows_processed"))
    added = spark.createDataFrame([(f"{source}-late", "late", "SUCCESS", 1)], fixed.schema)
    updates = fixed.unionByName(added).withColumns(
        {"run_ts": F.lit(run_ts), "run_date": F.to_date(F.lit("2024-05-06")), "run_log_id": F.lit(source),
         "run_id": F.lit(source), "source": F.lit(source)})
    logs.upsert_logs(spark, updates)
    mine, none = F.col("source") == source, F.lit(None).cast("string")
    rows = [spark.table(BRONZE_LOG).where(mine).select(
                F.lit("bronze").alias("layer"), F.col("table_name").alias("name"), "status", F.col("rows_processed").alias("n_rows")),
            spark.table(SILVER_LOG).where(mine).select(
                F.lit("silver").alias("layer"), F.col("table_name").alias("name"), "status", F.col("rows_inserted").alias("n_rows")),
            spark.table(BRONZE_SUMMARY).where(mine).select(
                F.lit("bronze run").alias("layer"), none.alias("name"), "status", F.col("total_rows").alias("n_rows")),
            spark.table(SILVER_SUMMARY).where(mine).select(
                F.lit("silver run").alias("layer"), none.alias("name"), none.alias("status"), F.col("total_inserts").alias("n_rows"))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("registry_build", ctes=(fx.COLUMN_METADATA, cq.SOURCES), sql=f"""
SELECT source, name, CAST(enabled AS VARCHAR) AS enabled, size_class, load_mode, base_query
FROM ({cq.joined_registry_sql(True)})""")
def registry_build(spark, sf_dir):
    """The job from column metadata to registry documents, read back as tables."""
    columns, sources = fx.column_metadata(spark, sf_dir), cq._sources(spark, sf_dir)
    documents = build_registry(columns, sources, *cq._settings(spark, sf_dir), use_load_modes=True)
    path = scratch_path(spark, "registry")
    write_registries(documents, path)
    return configs.read_registry(spark, f"{path}/*/*.txt").select("source", "name", "enabled", "size_class", "load_mode", "base_query")


@query("tuning_runs", ctes=(fx.RUN_HISTORY,), sql="""
SELECT source, run_id, workers, total_rows FROM run_history
QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_start DESC, run_id DESC) <= 20""")
def tuning_runs(spark, sf_dir):
    """The report's view of the last twenty runs of every source."""
    return tuning_report(fx.run_history(spark, sf_dir))["runs"].select("source", "run_id", "workers", "total_rows")


@query("run_plan", sql="""
SELECT n_name AS source, CAST(n_nationkey % 24 AS VARCHAR) || ':00' AS time, r_name AS days
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = (SELECT max(n_name) FROM nation)""")
def run_plan(spark, sf_dir):
    """A run plan file with one entry per nation, and the entries of one source."""
    nations, regions = fx.table(spark, sf_dir, "nation"), fx.table(spark, sf_dir, "region")
    entry = F.struct(F.col("n_name").alias("source"), F.concat((F.col("n_nationkey") % 24).cast("string"), F.lit(":00")).alias("time"),
                     F.col("r_name").alias("days"))
    path = scratch_path(spark, "runplan")
    plan = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    plan.agg(F.to_json(F.collect_list(entry)).alias("value")).write.text(path)
    last = nations.agg(F.max("n_name")).first()[0]
    return configs.source_schedule(configs.read_runplan(spark, path), last).select("source", "time", "days")


@query("table_facts", sql="""
SELECT fact, value FROM (SELECT count(*) AS n FROM customer), LATERAL (VALUES
  ('exists', 1), ('rows', n), ('rows with statistics', n), ('dropped', 1), ('exists after', 0), ('dropped again', 0)) s(fact, value)""")
def table_facts(spark, sf_dir):
    """A table's life: existence, row count, statistics, drop."""
    target = f"{_database(spark)}.customer"
    bronze.write_snapshot(spark, target, fx.table(spark, sf_dir, "customer"), fx.THIS_RUN, keep_versions=False)
    facts = [("exists", int(tables.table_exists(spark, target))), ("rows", tables.row_count(spark, target))]
    tables.analyze(spark, target)
    known = tables.described(spark, target, "Statistics")
    facts.append(("rows with statistics", int(known.split(",")[1].split()[0])))
    facts += [("dropped", int(tables.drop_table(spark, target))), ("exists after", int(tables.table_exists(spark, target))),
              ("dropped again", int(tables.drop_table(spark, target)))]
    return spark.createDataFrame(facts, "fact string, value long")


@query("versions_left", sql="""
SELECT run_ts, count(*) AS n_rows FROM orders, (VALUES ('20240102T000000', TIMESTAMP '2001-01-01'),
  ('20240103T000000', TIMESTAMP '9999-01-01')) s(run_ts, day) WHERE o_orderdate < day GROUP BY run_ts""")
def versions_left(spark, sf_dir):
    """Versions after those older than the retention are removed."""
    import datetime as dt

    target = f"{_database(spark)}.orders"
    orders = fx.table(spark, sf_dir, "orders")
    for run, day in ORDER_DAYS.items():
        bronze.write_snapshot(spark, target, orders.where(F.col("o_orderdate") < F.lit(day)), run)
    versioned.remove_old_versions(spark, target, 24, dt.datetime(2024, 1, 3))
    found = [versioned.read_version(spark, v).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(v.run_ts).alias("run_ts"), "n_rows")
             for v in versioned.versions(spark, target)]
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out


@query("latest_summary", ctes=(fx.RUN_HISTORY,), sql="""
SELECT source, run_id FROM run_history WHERE source = '1-URGENT' ORDER BY run_start DESC, run_id DESC LIMIT 1""")
def latest_summary(spark, sf_dir):
    """The newest run of a source where many start in the same second."""
    history = fx.run_history(spark, sf_dir)
    stamped = history.withColumns({
        "run_ts": F.lit("20240101T000000"), "run_start": F.col("run_start") + F.make_dt_interval(secs=F.col("run_id") / 100000)})
    return runlog.latest_run_summary(stamped, "1-URGENT").select("source", "run_id")
