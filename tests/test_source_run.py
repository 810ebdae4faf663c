"""A source from landed files to silver: load modes, logs, resume, retry, failures."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from lakeload.operators import registry, runlog
from lakeload.plans.source_run import run_source
from lakeload.schemas import BRONZE_LOG, BRONZE_SUMMARY, SILVER_LOG, SILVER_SUMMARY
from lakeload.sources import configs, landed, versioned
from workloads import fixtures as fx

RUNS = ["20240110T010000", "20240120T010000", "20240131T010000"]


@pytest.fixture()
def lake(spark, sf_dir, tmp_path):
    """A registry and three landed runs of one source."""
    source = f"crm{uuid.uuid4().hex[:6]}"
    for name in ("silver.events", "silver.orders"):
        versioned.drop_versioned(spark, name)
    document = {
        "source": source, "base_files": "landing",
        "tables": [
            {"name": "events", "enabled": True, "load_mode": "incremental", "delta_schema": source,
             "business_keys": ["user_id"], "incremental_column": json.dumps({"filter_column": "ts", "kind": "datetime"})},
            {"name": "orders", "load_mode": "Snapshot", "delta_schema": source, "delta_table": "all_orders",
             "business_keys": ["o_orderkey"], "sync_deletes": True, "max_rows_per_file": 100000},
            {"name": "facts", "enabled": 1, "load_mode": "window", "delta_schema": source,
             "window": {"column": "o_orderdate", "granularity": "month", "lookback_months": 1},
             "partitioning": {"type": "year_month", "year_col": "p_year", "month_col": "p_month"}},
            {"name": "nation", "load_mode": "window_replace", "delta_schema": source},
            {"name": "off", "enabled": 0, "delta_schema": source},
            {"name": "absent", "enabled": "true", "delta_schema": source, "business_keys": ["id"]},
        ]}
    path = tmp_path / "registry.json"
    path.write_text(json.dumps(document))
    root = str(tmp_path / "landing")
    events, orders = fx.table(spark, sf_dir, "events"), fx.typed_orders(spark, sf_dir)
    before = None
    for run in RUNS:
        day = f"{run[:4]}-{run[4:6]}-{run[6:8]}"
        new = events.where(F.col("ts") < day)
        if before:
            new = new.where(F.col("ts") >= before)
        new.coalesce(2).write.parquet(landed.landed_path(root, source, run, "events"))
        before = day
    for run, kept in ((RUNS[0], "o_orderpriority <> '1-URGENT'"), (RUNS[1], "o_orderstatus <> 'P'"), (RUNS[2], "true")):
        orders.where(kept).write.parquet(landed.landed_path(root, source, run, "orders"))
    orders.write.parquet(landed.landed_path(root, source, RUNS[0], "facts"))
    fx.table(spark, sf_dir, "nation").write.parquet(landed.landed_path(root, source, RUNS[0], "nation"))
    return source, configs.read_registry(spark, str(path)), root


def statuses(results):
    return {r["table_name"]: r["status"] for r in results}


def by_name(results, name):
    return next(r for r in results if r["table_name"] == name)


def test_runs_in_sequence(spark, sf_dir, lake):
    source, tables, root = lake
    first = run_source(spark, tables, source, RUNS[0], root, workers=4)
    assert statuses(first["bronze"]) == {
        "events": "SUCCESS", "orders": "SUCCESS", "facts": "SUCCESS", "nation": "SKIPPED", "absent": "SKIPPED"}
    assert statuses(first["silver"]) == {"events": "SUCCESS", "orders": "SUCCESS"}
    assert first["status"] == "SUCCESS"
    events = fx.table(spark, sf_dir, "events")
    early = events.where("ts < '2024-01-10'")
    assert by_name(first["bronze"], "events")["rows_processed"] == early.count()
    assert by_name(first["silver"], "events")["rows_inserted"] == early.select("user_id").distinct().count()
    assert set(spark.table(f"{source}.facts").columns) >= {"p_year", "p_month", "_bronze_load_ts", "_bronze_filename"}

    second = run_source(spark, tables, source, RUNS[1], root, workers=2)
    assert statuses(second["bronze"])["facts"] == "SKIPPED"
    merged = by_name(second["silver"], "orders")
    orders = fx.typed_orders(spark, sf_dir)
    seen = orders.where("o_orderpriority <> '1-URGENT'")
    assert merged["rows_inserted"] == orders.where("o_orderpriority = '1-URGENT' and o_orderstatus <> 'P'").count()
    assert merged["rows_deleted"] == seen.where("o_orderstatus = 'P'").count()
    assert merged["rows_unchanged"] == seen.where("o_orderstatus <> 'P'").count()
    assert merged["bronze_rows"] == orders.where("o_orderstatus <> 'P'").count()

    third = run_source(spark, tables, source, RUNS[2], root)
    merged = by_name(third["silver"], "orders")
    assert merged["rows_updated"] == seen.where("o_orderstatus = 'P'").count()
    silver = spark.table("silver.orders")
    assert silver.count() == orders.count() and silver.where("is_deleted").count() == 0
    state = spark.table("silver.events")
    newest = events.groupBy("user_id").agg(F.max("ts").alias("ts"))
    assert state.join(newest, ["user_id", "ts"], "left_semi").count() == state.count() == newest.count()
    assert versioned.read_as_of(spark, "silver.orders", RUNS[0]).count() == seen.count()

    log = spark.table(BRONZE_LOG).where(F.col("source") == source)
    assert log.count() == 15
    assert runlog.is_table_processed(log, RUNS[0], "events") and not runlog.is_table_processed(log, RUNS[1], "facts")
    runs = spark.table(BRONZE_SUMMARY).where(F.col("source") == source)
    assert runs.count() == 3 and {r.status for r in runs.collect()} == {"SUCCESS"}
    assert runlog.latest_run_summary(runs, source).first().run_ts == RUNS[2]
    totals = spark.table(SILVER_SUMMARY).where(F.col("source") == source).orderBy("run_ts").collect()
    assert [t.total_tables for t in totals] == [2, 2, 2]
    assert spark.table(SILVER_LOG).where(F.col("source") == source).count() == 6


def test_resume_retry_and_force(spark, lake):
    source, tables, root = lake
    run = RUNS[0]
    only = run_source(spark, tables, source, run, root, retry=["orders", "no_such_table"], workers=2)
    assert statuses(only["bronze"]) == {"orders": "SUCCESS"} == statuses(only["silver"])
    assert only["unknown_retries"] == ["no_such_table"]
    rest = run_source(spark, tables, source, run, root, workers=2)
    assert "orders" not in statuses(rest["bronze"]) and statuses(rest["silver"]) == {"events": "SUCCESS"}
    again = run_source(spark, tables, source, run, root, workers=2)
    assert set(statuses(again["bronze"])) == {"nation", "absent"} and again["silver"] == []
    before = {r.user_id: r.row_hash for r in spark.table("silver.events").collect()}
    forced = run_source(spark, tables, source, run, root, force=True, workers=2)
    assert statuses(forced["silver"]) == {"events": "SUCCESS", "orders": "SUCCESS"}
    assert {r.user_id: r.row_hash for r in spark.table("silver.events").collect()} == before
    assert len([v for v in versioned.versions(spark, "silver.events") if v.run_ts == run]) == 1
    # A table whose target another tool left in a plain form is taken over.
    assert forced["status"] == "SUCCESS"


def test_resume_merges_what_an_earlier_session_loaded(spark, lake):
    """Bronze succeeded and was logged, then the session ended before silver."""
    from lakeload.plans.bronze import load_table
    from lakeload.plans.spec import TableSpec
    from lakeload.sources import logs

    source, tables, root = lake
    run = RUNS[0]
    row = registry.with_targets(tables).where("name = 'events'").first()
    result = load_table(spark, TableSpec.from_row(row), source, "earlier", run, root)
    logs.log_batch(spark, [result], "bronze", "earlier-summary")
    resumed = run_source(spark, tables, source, run, root, retry=["events"], workers=1)
    assert resumed["bronze"] == [] and statuses(resumed["silver"]) == {"events": "SUCCESS"}


def test_failures_are_reported(spark, sf_dir, lake, tmp_path):
    source, tables, root = lake
    import pathlib

    broken = pathlib.Path(landed.landed_path(root, source, RUNS[0], "absent"))
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("not parquet")
    result = run_source(spark, tables, source, RUNS[0], root, workers=3)
    assert statuses(result["bronze"])["absent"] == "FAILED" and result["status"] == "PARTIAL"
    assert "Read parquet failed" in by_name(result["bronze"], "absent")["error_message"]
    summary = spark.table(BRONZE_SUMMARY).where(F.col("source") == source).first()
    assert summary.status == "PARTIAL" and json.loads(summary.failed_tables) == ["absent"]
    failed = runlog.failed_tables(spark.table(BRONZE_LOG).where(F.col("source") == source), RUNS[0])
    assert [r.table_name for r in failed.collect()] == ["absent"]
    # A history with another schema is not rebuilt unless asked for.
    events = fx.table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("string"))
    events.write.mode("overwrite").parquet(landed.landed_path(root, source, RUNS[1], "events"))
    second = run_source(spark, tables, source, RUNS[1], root, retry=["events"], workers=1)
    assert statuses(second["bronze"]) == {"events": "FAILED"}
    n = spark.table(f"{source}.events").count()
    assert n == fx.table(spark, sf_dir, "events").where("ts < '2024-01-10'").count()
    third = run_source(spark, tables, source, RUNS[1], root, retry=["events"], workers=1,
                       load_options={"allow_rebuild": True})
    assert by_name(third["bronze"], "events")["status"] == "SUCCESS"
    assert "recreated" in by_name(third["bronze"], "events")["error_message"]


def test_nothing_to_do(spark, lake):
    source, tables, root = lake
    result = run_source(spark, tables.where("name = 'off'"), source, RUNS[0], root)
    assert result["status"] == "NO_WORK"


def test_empty_files_and_month_replacement(spark, sf_dir, lake):
    source, tables, root = lake
    fx.typed_orders(spark, sf_dir).where("false").write.parquet(landed.landed_path(root, source, RUNS[1], "facts"))
    fx.typed_orders(spark, sf_dir).withColumnRenamed("o_orderdate", "Boek_Datum").write.mode("overwrite").parquet(
        landed.landed_path(root, source, RUNS[1], "nation"))
    result = run_source(spark, tables, source, RUNS[1], root, retry=["facts", "nation"], workers=1,
                        load_options={"month_replacement": True})
    assert statuses(result["bronze"]) == {"facts": "EMPTY", "nation": "SUCCESS"}
    assert spark.table(f"{source}.nation").where("p_year = 1998 and p_month = 3").count() > 0


def test_rebuild_of_a_plain_table(spark, sf_dir, tmp_path):
    """A folder in the way of a plain snapshot: the target is dropped and written again."""
    from lakeload.plans.bronze import load_table
    from lakeload.plans.spec import TableSpec

    root, name = str(tmp_path), f"r_{uuid.uuid4().hex[:8]}"
    orders = fx.typed_orders(spark, sf_dir)
    orders.write.parquet(landed.landed_path(root, "crm", RUNS[0], "orders"))
    spec = TableSpec("orders", bronze_table=f"{name}.orders", by_month=True)
    missing = load_table(spark, spec, "crm", "id", RUNS[0], root)
    assert missing["status"] == "FAILED" and "no column" in missing["error_message"]
    dated = TableSpec("orders", bronze_table=f"{name}.orders", by_month=True, window_column="o_orderdate")
    for keep in (True, False, True):
        done = load_table(spark, dated, "crm", "id", RUNS[0], root, keep_versions=keep, drop_existing=not keep)
        assert (done["status"], done["rows_processed"]) == ("SUCCESS", orders.count())
        assert spark.table(f"{name}.orders").where("p_year = 1998").count() > 0
    # A failed load leaves the published version alone.
    assert load_table(spark, spec, "crm", "id", RUNS[0], root)["status"] == "FAILED"
    assert spark.table(f"{name}.orders").count() == orders.count()


def test_two_sources_at_once(spark, sf_dir, tmp_path):
    """Runs that write the same log tables at the same time lose no row of each other."""
    from concurrent.futures import ThreadPoolExecutor

    nation, run = fx.table(spark, sf_dir, "nation"), RUNS[0]
    sources = [f"s{i}{uuid.uuid4().hex[:6]}" for i in range(2)]
    for source in sources:
        for name in ("a", "b"):
            nation.write.parquet(landed.landed_path(str(tmp_path), source, run, f"{source}{name}"))
    registries = [spark.createDataFrame(
        [(s, f"{s}{n}", "snapshot", True, s, ["n_nationkey"]) for n in ("a", "b")],
        "source string, name string, load_mode string, enabled boolean, delta_schema string, business_keys array<string>")
        for s in sources]
    paths = []
    for source, tables in zip(sources, registries):
        path = str(tmp_path / f"{source}.json")
        document = {"source": source, "tables": [r.asDict() for r in tables.drop("source").collect()]}
        (tmp_path / f"{source}.json").write_text(json.dumps(document))
        paths.append(path)
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda sp: run_source(
            spark, configs.read_registry(spark, sp[1]), sp[0], run, str(tmp_path), workers=2), zip(sources, paths)))
    assert [r["status"] for r in results] == ["SUCCESS"] * 2
    for source in sources:
        for table, n in ((BRONZE_LOG, 2), (SILVER_LOG, 2), (BRONZE_SUMMARY, 1), (SILVER_SUMMARY, 1)):
            assert spark.table(table).where(F.col("source") == source).count() == n, table
