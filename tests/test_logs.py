"""Log tables: set-up, appends, summaries, upsert."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from lakeload.operators import runlog
from lakeload.plans.tuning_report import tuning_report
from lakeload.schemas import BRONZE_LOG, BRONZE_SUMMARY, LOG_PARTITIONS, LOG_SCHEMAS, SILVER_LOG, SILVER_SUMMARY
from lakeload.sources import logs
from workloads import fixtures as fx

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)


def record(run_ts="20240506T070809", name="t", **values):
    return {"run_id": "r", "run_ts": run_ts, "source": values.pop("source", uuid.uuid4().hex), "table_name": name,
            "status": "SUCCESS", "start_time": NOW, "end_time": NOW + dt.timedelta(seconds=5), "log_id": uuid.uuid4().hex,
            **values}


def rows(spark, table, source):
    return spark.table(table).where(F.col("source") == source)


def test_set_up_is_idempotent(spark):
    for _ in range(2):
        logs.ensure_log_tables(spark)
    for table, schema in LOG_SCHEMAS.items():
        found = spark.table(table)
        assert set(found.columns) == set(schema.fieldNames())
        parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        assert parts == LOG_PARTITIONS[table]


def test_batches(spark):
    first = record(error_message="x" * 2000, rows_processed=3)
    source = first["source"]
    assert logs.log_batch(spark, [first, record(name="u", source=source, log_id=None)], "bronze", "run-log") == 2
    got = {r.table_name: r for r in rows(spark, BRONZE_LOG, source).collect()}
    assert got["t"].error_message == "x" * 1000 + "... [TRUNCATED]" and got["t"].partition_key == first["run_ts"]
    assert got["t"].run_date == dt.date(2024, 5, 6) and got["u"].log_id.startswith("run-log_")
    assert logs.log_batch(spark, [record(source=source, rows_inserted=7)], "Silver") == 1
    assert rows(spark, SILVER_LOG, source).first().rows_inserted == 7
    assert logs.log_table_processing(spark, "bronze", "run-log", **record(source=source, name="v")) == 1
    assert rows(spark, BRONZE_LOG, source).count() == 3
    assert logs.log_batch(spark, [], "bronze") == 0
    for bad in (lambda: logs.log_batch(spark, [first], "bronze"), lambda: logs.log_batch(spark, [first], "gold"),
                lambda: logs.log_batch(spark, [record(run_ts=None)], "silver"),
                lambda: logs.log_batch(spark, [record(status=None)], "silver")):
        with pytest.raises(ValueError):
            bad()


def test_summaries(spark):
    source = uuid.uuid4().hex
    counts = {f"tables_{s}": 1 for s in ("success", "empty", "failed", "skipped")}
    base = {"run_ts": "20240506T070809", "source": source, "run_start": NOW, "run_end": NOW, "total_tables": 4}
    log_id = logs.log_summary(spark, {**base, **counts, "total_rows": 9, "failed_tables": ["é", "b"]}, "bronze")
    got = rows(spark, BRONZE_SUMMARY, source).first()
    assert (got.log_id, got.run_id, got.status) == (log_id, f"20240506T070809_{log_id[:8]}", "PARTIAL")
    assert got.failed_tables == '["é", "b"]'
    assert logs.log_summary(spark, {**base, "run_id": "r", "failed_tables": []}, "silver") is None
    assert rows(spark, SILVER_SUMMARY, source).first().failed_tables is None
    for bad in ({**base, "run_ts": None}, base):
        with pytest.raises(ValueError):
            logs.log_summary(spark, bad, "bronze")


def test_upsert_touches_only_its_partitions(spark):
    source = uuid.uuid4().hex
    days = ["20240601T000000", "20240602T000000"]
    old = [record(d, "t", source=source, status="RUNNING", log_id=f"{source}{d}", load_mode="snapshot") for d in days]
    logs.log_batch(spark, old, "bronze", "x")
    files = set(spark.table(BRONZE_LOG).inputFiles())
    updates = spark.createDataFrame(
        [(f"{source}{days[1]}", "t", days[1], "x", "r", source, "SUCCESS", 5),
         (f"{source}new", "u", days[1], "x", "r", source, "FAILED", None)],
        "log_id string, table_name string, run_ts string, run_log_id string, run_id string, source string, "
        "status string, rows_processed long").withColumn("run_date", F.lit(dt.date(2024, 6, 2)))
    logs.upsert_logs(spark, updates)
    got = {(r.table_name, r.run_ts): r for r in rows(spark, BRONZE_LOG, source).collect()}
    assert len(got) == 3
    assert got["t", days[0]].status == "RUNNING"
    changed = got["t", days[1]]
    assert (changed.status, changed.rows_processed, changed.load_mode, changed.start_time) == (
        "SUCCESS", 5, "snapshot", NOW)
    assert got["u", days[1]].status == "FAILED"
    gone = files - set(spark.table(BRONZE_LOG).inputFiles())
    assert gone and all("run_date=2024-06-02" in f for f in gone)


def test_computed_summary_fits_the_log(spark, sf_dir):
    """A summary computed from log rows can be appended as it is."""
    summary = runlog.bronze_run_summary(fx.processing_log(spark, sf_dir).where("run_date = '1995-06-12'"), 4)
    ids = summary.withColumn("log_id", F.concat(F.lit("computed-"), "run_id"))
    n = ids.count()
    logs.append_logs(spark, ids, BRONZE_SUMMARY)
    assert spark.table(BRONZE_SUMMARY).where("log_id like 'computed-%'").count() == n > 0


def test_status_of_run(spark, sf_dir):
    log = fx.processing_log(spark, sf_dir)
    none = log.where("false")
    for bronze, silver, want in ((none, none, "NO_WORK"), (log.where("status = 'EMPTY'"), none, "SUCCESS"),
                                 (none, log.where("status = 'EMPTY'"), "PARTIAL"), (log, none, "PARTIAL")):
        assert runlog.status_of_run(bronze, silver).first().overall_status == want


def test_tuning_report(spark, sf_dir):
    report = tuning_report(fx.run_history(spark, sf_dir), "1-URGENT", 12)
    assert report["runs"].count() == 12
    assert all({r.source for r in df.select("source").collect()} <= {"1-URGENT"} for df in report.values())


def test_another_catalog_opens_the_same_log(spark, tmp_path):
    """A catalog that lost a log, as every new session without a metastore has, finds its complete writes again."""
    store = logs.LogStore(f"log_{uuid.uuid4().hex[:8]}", str(tmp_path))
    source = uuid.uuid4().hex
    for day in ("20240601T000000", "20240602T000000", "20240603T000000"):
        logs.log_batch(spark, [record(day, "a b=c/é", source=source), record(day, "u", source=source)], "bronze", "x", store)
        logs.log_summary(spark, {"run_ts": day, "source": source, "run_id": "r", "run_start": NOW, "run_end": NOW, "total_tables": 1}, "silver", store)
        for table in LOG_SCHEMAS:
            spark.sql(f"DROP TABLE {store.table(table)}")
    got = {(r.run_ts[:8], r.table_name) for r in logs.read_log(spark, BRONZE_LOG, store).collect()}
    assert got == {(d, t) for d in ("20240601", "20240602", "20240603") for t in ("a b=c/é", "u")}
    assert logs.read_log(spark, SILVER_SUMMARY, store).count() == 3
    assert logs.read_log(spark, BRONZE_LOG).where(F.col("source") == source).count() == 0

    # A write without its success file does not count; one that goes leaves the catalog.
    place = next(tmp_path.rglob("write_id=*/run_date=2024-06-01")).parent
    marks = list(place.glob("*_SUCCESS"))
    assert len(marks) == 1
    marks[0].unlink()
    left = {r.run_ts[:8] for r in logs.read_log(spark, BRONZE_LOG, store).collect()}
    other = {r.run_ts[:8] for r in logs.read_log(spark, SILVER_LOG, store).collect()}
    assert left == {"20240602", "20240603"} and other == set()


def test_compaction_is_seen_by_other_catalogs(spark, tmp_path):
    store = logs.LogStore(f"log_{uuid.uuid4().hex[:8]}", str(tmp_path))
    for day in ("20240601T000000", "20240601T010000", "20240602T000000", "20240603T000000"):
        logs.log_batch(spark, [record(day, "t"), record("20240603T000000", "t")], "bronze", "x", store)
        logs.log_summary(spark, {"run_ts": day, "source": "s", "run_id": "r", "run_start": NOW, "run_end": NOW, "total_tables": 1}, "silver", store)
    before = sorted(r.log_id for r in logs.read_log(spark, BRONZE_LOG, store).collect())
    assert logs.compact_log(spark, BRONZE_LOG, dt.date(2024, 6, 3), store) == 3
    assert logs.compact_log(spark, SILVER_SUMMARY, dt.date(2024, 6, 3), store) == 3
    for table in LOG_SCHEMAS:
        spark.sql(f"DROP TABLE {store.table(table)}")
    assert sorted(r.log_id for r in logs.read_log(spark, BRONZE_LOG, store).collect()) == before
    assert logs.read_log(spark, SILVER_SUMMARY, store).count() == 4
    assert len(list(tmp_path.rglob("run_date=2024-06-01"))) == 1
    assert logs.compact_log(spark, BRONZE_LOG, dt.date(2024, 6, 1), store) == 0
