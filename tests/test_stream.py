"""Streaming ingest: exactly once, late files, repeated batches, merge after each batch."""

import uuid

from pyspark.sql import functions as F

from lakeload.plans.silver import merge_table
from lakeload.plans.spec import TableSpec
from lakeload.sources import landed
from lakeload.streaming import ingest
from workloads import fixtures as fx

RUNS = ["20240111T000000", "20240121T000000"]


def land(df, root, run, mode="error"):
    df.coalesce(3).write.mode(mode).parquet(landed.landed_path(root, "shop", run, "events"))


def test_ingest(spark, sf_dir, tmp_path):
    root, target = str(tmp_path / "in"), f"s_{uuid.uuid4().hex[:8]}.events"
    events = fx.table(spark, sf_dir, "events")
    checkpoint = str(tmp_path / "checkpoint")

    def start(**options):
        stream = ingest.landed_stream(spark, root, "shop", "events", events.schema, **options)
        ingest.ingest(spark, stream, target, checkpoint).awaitTermination()
        return {r._bronze_load_ts: r["count"] for r in spark.table(target).groupBy("_bronze_load_ts").count().collect()}

    early, late = events.where("ts < '2024-01-11'"), events.where("ts >= '2024-01-21'")
    land(early, root, RUNS[0])
    assert start() == {RUNS[0]: early.count()}
    assert start() == {RUNS[0]: early.count()}
    middle = events.where("ts >= '2024-01-11' and ts < '2024-01-21'")
    land(middle, root, RUNS[1])
    land(late, root, RUNS[0], "append")
    assert start(max_files_per_batch=2) == {RUNS[0]: early.count() + late.count(), RUNS[1]: middle.count()}
    stored = spark.table(target).select(*events.columns)
    assert stored.exceptAll(events).isEmpty() and events.exceptAll(stored).isEmpty()
    assert spark.table(target).select(ingest.BATCH_COLUMN).distinct().count() >= 2


def test_repeated_batch_does_not_double(spark, sf_dir):
    target = f"s_{uuid.uuid4().hex[:8]}.events"
    rows = fx.table(spark, sf_dir, "events").withColumn("_bronze_filename", F.lit("f")).withColumn(
        "_bronze_load_ts", F.when(F.col("ts") < "2024-01-11", RUNS[0]).otherwise(RUNS[1]))
    ingest.ensure_history(spark, target, rows)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    try:
        for batch in (0, 1, 1, 0):
            facts = ingest.write_batch(rows, batch, target)
            assert facts == {"rows": rows.count(), "newest_run": RUNS[1]}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    spark.catalog.refreshTable(target)
    assert spark.table(target).count() == 2 * rows.count()


def test_merge_after_each_batch(spark, sf_dir, tmp_path):
    root, name = str(tmp_path / "in"), f"s_{uuid.uuid4().hex[:8]}"
    spec = TableSpec("events", "incremental", f"{name}.events", f"{name}.state", ("user_id",), "ts")
    events = fx.table(spark, sf_dir, "events")
    results = []

    def merge(facts):
        results.append(merge_table(spark, spec, "shop", "stream", facts["newest_run"]))

    for run, rows in zip(RUNS, (events.where("ts < '2024-01-11'"), events.where("ts >= '2024-01-11'"))):
        land(rows, root, run)
        stream = ingest.landed_stream(spark, root, "shop", "events", events.schema)
        ingest.ingest(spark, stream, spec.bronze_table, str(tmp_path / "c"), merge).awaitTermination()
    assert [r["status"] for r in results] == ["SUCCESS", "SUCCESS"], results
    newest = events.groupBy("user_id").agg(F.max("ts").alias("ts"))
    state = spark.table(spec.silver_table)
    assert state.join(newest, ["user_id", "ts"], "left_semi").count() == newest.count() == state.count()
