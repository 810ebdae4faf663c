"""The four log tables: set-up, batch append, summaries, upsert, compaction.

Several runs write to one log table at a time, from sessions that need not share a catalog. The tables
are external, at a fixed place (:class:`LogStore`), and the folders there are the log: each write fills
one of its own (``write_id=<unique>``), which counts once its ``_SUCCESS`` file stands. Writers share no
temporary folder and a failed write leaves nothing that readers see. A catalog that knows less, or more,
than the folders is brought in line when it opens a log and when it reads one (:func:`read_log`). The
folders pile up, one per write; :func:`compact_log` joins those of past days.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.stamps import parse_run_date
from lakeload.functions.text import truncate_message, truncate_text
from lakeload.operators.runlog import LOG_UPSERT_KEYS, upsert_log_rows
from lakeload.schemas import (
    BRONZE_LOG, BRONZE_SUMMARY, LOG_PARTITIONS, LOG_SCHEMAS, SILVER_LOG, SILVER_SUMMARY, WRITE_COLUMN)
from lakeload.session import reliable_checkpoint
from lakeload.sources.bronze import add_partitions, drop_partitions
from lakeload.sources.files import delete_folder, matching_paths, partition_values
from lakeload.sources.tables import ensure_schema, quoted, table_exists, table_location

@dataclass(frozen=True)
class LogStore:
    """Where the log tables live: a database name, and the folder below which their files lie.

    Without ``root`` that is the session's warehouse folder. Sessions with the same root share their logs.
    """

    database: str = "logs"
    root: str | None = None

    def table(self, name: str) -> str:
        return f"{self.database}.{name.rsplit('.', 1)[-1]}"

    def location(self, spark: SparkSession, name: str) -> str:
        root = self.root or spark.conf.get("spark.sql.warehouse.dir")
        return f"{root.rstrip('/')}/{self.database}.db/{name.rsplit('.', 1)[-1]}"


LOGS = LogStore()
LAYERS = {"bronze": (BRONZE_LOG, BRONZE_SUMMARY), "silver": (SILVER_LOG, SILVER_SUMMARY)}


def layer_tables(layer: str) -> tuple[str, str]:
    """Processing log and run summary of a layer."""
    if layer.lower() not in LAYERS:
        raise ValueError(f"layer must be one of {sorted(LAYERS)}, not {layer!r}")
    return LAYERS[layer.lower()]


def ensure_log_tables(spark: SparkSession, store: LogStore = LOGS) -> None:
    """Create what this catalog is missing, over the folders that are there; safe to call before every write."""
    ensure_schema(spark, store.database)
    for table, schema in LOG_SCHEMAS.items():
        name = store.table(table)
        if table_exists(spark, name):
            continue
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
        place = store.location(spark, table).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING parquet "
                  f"PARTITIONED BY ({', '.join(LOG_PARTITIONS[table])}) LOCATION '{place}'")
        refresh_log(spark, table, store)


def refresh_log(spark: SparkSession, table: str, store: LogStore = LOGS) -> None:
    """Bring the catalog's partitions in line with the folders of complete writes."""
    name = store.table(table)
    # The catalog first: a partition it has was complete before the folders are listed.
    known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()}
    there = _complete_partitions(spark, table, table_location(spark, name))
    add_partitions(spark, name, [partition_values(p) for p in sorted(there - known)])
    drop_partitions(spark, name, [partition_values(p) for p in sorted(known - there)])


def read_log(spark: SparkSession, table: str, store: LogStore = LOGS) -> DataFrame:
    """A log table with the writes of every session up to now."""
    ensure_log_tables(spark, store)
    refresh_log(spark, table, store)
    return spark.table(quoted(store.table(table)))


def _complete_partitions(spark: SparkSession, table: str, location: str, write_id: str = "*") -> set[str]:
    """Partitions, as folder names below the table, of writes that are complete."""
    def below(path: str) -> str:
        return path[path.index(f"/{WRITE_COLUMN}=") + 1:]

    complete = {below(p).split("/")[0] for p in matching_paths(spark, f"{location}/{WRITE_COLUMN}={write_id}/_SUCCESS")}
    inner = "".join(f"/{c}=*" for c in LOG_PARTITIONS[table][1:])
    found = map(below, matching_paths(spark, f"{location}/{WRITE_COLUMN}={write_id}{inner}"))
    return {p for p in found if p.split("/")[0] in complete}


def conform_log(df: DataFrame, table: str) -> DataFrame:
    """Columns of a log table in its order and types; absent ones are NULL, messages are cut."""
    columns = []
    for f in LOG_SCHEMAS[table].fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name == "error_message":
            value = truncate_message(value.cast("string"))
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def append_logs(spark: SparkSession, df: DataFrame, table: str, store: LogStore = LOGS) -> None:
    """Append log rows that are a DataFrame already (such as a summary computed from logs)."""
    ensure_log_tables(spark, store)
    _write_own(spark, conform_log(df, table), table, store)


def _write_own(spark: SparkSession, rows: DataFrame, table: str, store: LogStore) -> None:
    """Write rows to a folder of their own and register its partitions: one per day and table."""
    write_id, name = uuid.uuid4().hex, store.table(table)
    location = table_location(spark, name)
    columns = [f.name for f in LOG_SCHEMAS[table].fields if f.name != WRITE_COLUMN]
    rows.select(*columns).write.partitionBy(*LOG_PARTITIONS[table][1:]).parquet(f"{location}/{WRITE_COLUMN}={write_id}")
    add_partitions(spark, name, [partition_values(p) for p in sorted(_complete_partitions(spark, table, location, write_id))])


def _require(record: dict, names: Sequence[str], table: str) -> None:
    missing = [n for n in names if record.get(n) is None]
    if missing:
        raise ValueError(f"record for {table} lacks {missing}")


def _frame(spark: SparkSession, records: list[dict], table: str) -> DataFrame:
    schema = LOG_SCHEMAS[table]
    for record in records:
        _require(record, [f.name for f in schema.fields if not f.nullable], table)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


def log_batch(spark: SparkSession, records: list[dict], layer: str, run_log_id: str | None = None,
              store: LogStore = LOGS) -> int:
    """Append the results of a run, one record per table, in one write."""
    table, _ = layer_tables(layer)
    if not records:
        return 0
    bronze = table == BRONZE_LOG
    if bronze and not run_log_id:
        raise ValueError("bronze records need the run_log_id of their run summary")
    rows = []
    for record in records:
        run_ts = record.get("run_ts")
        if not run_ts:
            raise ValueError("log record without run_ts")
        row = {**record, "error_message": truncate_text(record.get("error_message"))}
        row["run_date"] = row.get("run_date") or parse_run_date(run_ts)
        if bronze:
            row["run_log_id"] = run_log_id
            row["log_id"] = row.get("log_id") or f"{run_log_id}_{uuid.uuid4().hex[:8]}"
            row["partition_key"] = row.get("partition_key") or run_ts
        rows.append(row)
    append_logs(spark, _frame(spark, rows, table), table, store)
    return len(rows)


def log_table_processing(spark: SparkSession, layer: str = "bronze", run_log_id: str | None = None,
                         store: LogStore = LOGS, **record) -> int:
    """Append one record."""
    return log_batch(spark, [record], layer, run_log_id, store)


def log_summary(spark: SparkSession, summary: dict, layer: str, store: LogStore = LOGS) -> str | None:
    """Append one run summary; returns its id for bronze, None for silver."""
    _, table = layer_tables(layer)
    row = dict(summary)
    if not row.get("run_ts"):
        raise ValueError("run summary without run_ts")
    row["run_date"] = row.get("run_date") or parse_run_date(row["run_ts"])
    names = row.get("failed_tables")
    if names is not None and not isinstance(names, str):
        row["failed_tables"] = json.dumps(list(names), ensure_ascii=False) if names else None
    log_id = None
    if table == BRONZE_SUMMARY:
        log_id = row["log_id"] = row.get("log_id") or uuid.uuid4().hex
        row["run_id"] = row.get("run_id") or f"{row['run_ts']}_{log_id[:8]}"
        row["status"] = row.get("status") or ("PARTIAL" if row.get("tables_failed") else "SUCCESS")
        row["error_message"] = truncate_text(row.get("error_message"))
    append_logs(spark, _frame(spark, [row], table), table, store)
    return log_id


def upsert_logs(spark: SparkSession, updates: DataFrame, layer: str = "bronze", store: LogStore = LOGS) -> None:
    """Merge log rows by (log_id, table_name, run_date); of several updates of one key any may win.

    Only the partitions that hold an updated row are read and rewritten, each as a whole and by
    itself; appends go on meanwhile, because they own other partitions. New keys are appended.
    The merged rows go through a reliable checkpoint first, because Spark will not overwrite
    what a plan reads.
    """
    table, _ = layer_tables(layer)
    log, name = read_log(spark, table, store), store.table(table)
    parts = LOG_PARTITIONS[table]
    keys = list(LOG_UPSERT_KEYS)
    fresh = reliable_checkpoint(spark, conform_log(updates, table).drop(WRITE_COLUMN).dropDuplicates(keys))
    days = fresh.select("run_date").distinct()
    existing = log.join(days, ["run_date"], "left_semi")
    touched = reliable_checkpoint(spark, existing.join(fresh, keys, "left_semi").select(*parts).distinct())
    existing = existing.join(touched, parts, "left_semi")
    merged = reliable_checkpoint(spark, upsert_log_rows(existing, fresh, keys))
    (merged.where(F.col(WRITE_COLUMN).isNotNull()).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(table_location(spark, name)))
    spark.catalog.refreshTable(quoted(name))
    added = merged.where(F.col(WRITE_COLUMN).isNull())
    if not added.isEmpty():
        _write_own(spark, added, table, store)


def compact_log(spark: SparkSession, table: str, before: dt.date, store: LogStore = LOGS) -> int:
    """Join the write folders of log days before ``before`` into one; returns how many went.

    The joined rows are complete before the old folders go, so readers may see rows twice for a moment but
    never miss one. A session that listed the folders before must list them again (:func:`read_log`).
    """
    log, name = read_log(spark, table, store), store.table(table)
    inner = LOG_PARTITIONS[table][1:]
    if "run_date" in inner:
        partitions = (partition_values(r.partition) for r in spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect())
        old = [p for p in partitions if p["run_date"] is not None and dt.date.fromisoformat(p["run_date"]) < before]
        rows = log.where(F.col("run_date") < F.lit(before))
    else:
        # Summary folders hold whole writes; only those entirely in the past are joined.
        past = log.groupBy(WRITE_COLUMN).agg(F.max("run_date").alias("last"), F.count("run_date").alias("dated"), F.count("*").alias("n"))
        past = past.where((F.col("last") < F.lit(before)) & (F.col("dated") == F.col("n"))).select(WRITE_COLUMN)
        old = [r.asDict() for r in past.collect()]
        rows = log.join(past, WRITE_COLUMN, "left_semi")
    writes = {p[WRITE_COLUMN] for p in old}
    if len(writes) < 2:
        return 0
    _write_own(spark, reliable_checkpoint(spark, rows.repartition(*inner) if inner else rows.coalesce(1)), table, store)
    location = table_location(spark, name)
    # Whole days of a write go, or the whole write.
    going = {"/".join(p.split("/")[:2]) for w in writes for p in _complete_partitions(spark, table, location, w) if partition_values(p) in old}
    drop_partitions(spark, name, old)
    for partition in going:
        delete_folder(spark, f"{location}/{partition}")
    for write in writes:
        if not _complete_partitions(spark, table, location, write):
            delete_folder(spark, f"{location}/{WRITE_COLUMN}={write}")
    return len(writes)
