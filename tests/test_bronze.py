"""Load modes: what is replaced, what stays, and what a repeated run does."""

import uuid

import pytest
from pyspark.sql import functions as F

from lakeload.sources import bronze, landed, tables, versioned
from workloads import fixtures as fx


def fresh(name):
    return f"b_{uuid.uuid4().hex[:8]}.{name}"


def months(spark, target):
    return {(r.p_year, r.p_month): r["count"] for r in spark.table(target).groupBy("p_year", "p_month").count().collect()}


@pytest.mark.parametrize("keep_versions", [True, False])
def test_snapshot_replaces_rows_and_schema(spark, sf_dir, keep_versions):
    target = fresh("orders")
    orders = fx.typed_orders(spark, sf_dir)
    assert bronze.write_snapshot(spark, target, orders, "20240101T000000", keep_versions=keep_versions) == orders.count()
    smaller = orders.where("o_orderstatus = 'P'").drop("o_custkey").withColumn("extra", F.lit(1))
    n = bronze.write_snapshot(spark, target, smaller, "20240102T000000", keep_versions=keep_versions)
    assert n == smaller.count() == spark.table(target).count()
    assert spark.table(target).columns == smaller.columns


def test_snapshot_changes_form(spark, sf_dir):
    target = fresh("orders")
    orders = fx.typed_orders(spark, sf_dir)
    for i, keep in enumerate([False, True, False]):
        bronze.write_snapshot(spark, target, orders, f"2024010{i + 1}T000000", keep_versions=keep)
        assert spark.table(target).count() == orders.count()


def test_snapshot_can_read_what_it_replaces(spark, sf_dir):
    target = fresh("orders")
    bronze.write_snapshot(spark, target, fx.typed_orders(spark, sf_dir), "20240101T000000")
    kept = spark.table(target).where("o_orderstatus = 'F'")
    n = kept.count()
    assert bronze.write_snapshot(spark, target, kept, "20240102T000000") == n == spark.table(target).count()


def test_incremental_history_is_replay_safe(spark, sf_dir):
    target = fresh("orders")
    orders = fx.typed_orders(spark, sf_dir)
    runs = {"20240101T000000": "F", "20240102T000000": "O", "20240103T000000": "P"}
    for run, status in runs.items():
        bronze.append_run(spark, target, orders.where(F.col("o_orderstatus") == status), run)
    bronze.append_run(spark, target, orders.where("o_orderstatus = 'O'"), "20240102T000000")
    history = spark.table(target)
    assert history.count() == orders.count()
    got = {r._bronze_load_ts: r.o_orderstatus for r in history.select("_bronze_load_ts", "o_orderstatus").distinct().collect()}
    assert got == runs
    plan = history.where("_bronze_load_ts <= '20240101T000000'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_bronze_load_ts" in plan


def test_incremental_schema_change(spark, sf_dir):
    target = fresh("orders")
    orders = fx.typed_orders(spark, sf_dir)
    bronze.append_run(spark, target, orders, "20240101T000000")
    with pytest.raises(bronze.SchemaConflict):
        bronze.append_run(spark, target, orders.withColumn("extra", F.lit(1)), "20240102T000000")
    with pytest.raises(bronze.SchemaConflict):
        bronze.append_run(spark, target, orders.withColumn("o_custkey", F.lit("x")), "20240102T000000", evolve=True)
    bronze.append_run(spark, target, orders.withColumn("extra", F.lit(1)), "20240102T000000", evolve=True)
    assert spark.table(target).agg(F.count("extra"), F.count("*")).first()[:] == (orders.count(), 2 * orders.count())


def test_window_by_month_and_month_replacement(spark, sf_dir):
    target = fresh("orders")
    orders = fx.typed_orders(spark, sf_dir)
    n = bronze.write_window(spark, target, orders, "20240101T000000", "o_orderdate", by_month=True)
    assert n == orders.count() == spark.table(target).count()
    with pytest.raises(ValueError, match="no column"):
        bronze.write_window(spark, target, orders, "20240101T000000", by_month=True)

    plain = fresh("orders")
    bronze.replace_months(spark, plain, orders, "o_orderdate")
    before = months(spark, plain)
    assert sum(before.values()) == orders.count()
    march = orders.where("year(o_orderdate) = 1998 and month(o_orderdate) = 3 and o_orderstatus = 'F'")
    bronze.replace_months(spark, plain, march, "o_orderdate")
    after = months(spark, plain)
    assert after[(1998, 3)] == march.count() < before[(1998, 3)]
    assert {k: v for k, v in after.items() if k != (1998, 3)} == {k: v for k, v in before.items() if k != (1998, 3)}


def test_file_shape(spark, sf_dir):
    orders = fx.typed_orders(spark, sf_dir)
    target = fresh("orders")
    shape = bronze.FileShape(max_rows_per_file=500)
    bronze.write_snapshot(spark, target, orders, "20240101T000000", shape=shape)
    stored = spark.table(versioned.published(spark, target))
    sizes = [r["count"] for r in stored.groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) <= 500 and sum(sizes) == orders.count()
    bronze.write_snapshot(spark, target, orders.repartition(6), "20240102T000000",
                          shape=bronze.FileShape(single_file=True))
    assert len(spark.table(target).inputFiles()) == 1
    # One value in nearly all rows still spreads over the requested files.
    hot = orders.withColumn("hot", F.when(F.col("o_orderkey") > 3, 1).otherwise(0))
    sizes = [r["count"] for r in tables.shaped(hot, ["hot"], 4).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * orders.count()


def test_landed_files(spark, sf_dir, tmp_path):
    root, run = str(tmp_path), "20240305T101500123"
    path = landed.landed_path(root, "crm", run, "orders")
    assert path == f"{root}/crm/2024/03/05/{run}/orders"
    assert landed.read_landed(spark, root, "crm", run, "orders") is None
    orders = fx.typed_orders(spark, sf_dir)
    orders.write.parquet(path)
    df = landed.add_load_metadata(landed.read_landed(spark, root, "crm", run, "orders"), run)
    row = df.select("_bronze_load_ts", "_bronze_filename", landed.landed_run().alias("run")).distinct().collect()
    assert {(r._bronze_load_ts, r.run) for r in row} == {(run, run)}
    assert all(f"/{run}/orders/part-" in r._bronze_filename for r in row)
    with pytest.raises(ValueError):
        landed.landed_path(root, "crm", "2024", "orders")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception) as raised:
        landed.read_files(spark, "parquet", str(tmp_path / "bad"))
    assert not landed.is_missing_path(raised.value)


def test_table_helpers(spark, sf_dir, tmp_path):
    target = fresh("nation")
    assert tables.row_count(spark, target) is None
    assert tables.table_location(spark, target) is None
    assert tables.drop_table(spark, target) is False
    nation = fx.table(spark, sf_dir, "nation")
    bronze.write_snapshot(spark, target, nation, "20240101T000000", keep_versions=False)
    assert tables.row_count(spark, target) == 25
    tables.analyze(spark, target)
    tables.analyze(spark, target, columns=False)
    assert "rows" in tables.described(spark, target, "Statistics")
    tables.export_parquet(spark, target, f"{tmp_path}/out")
    tables.export_parquet(spark, target, f"{tmp_path}/out", mode="append")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 50
    assert tables.drop_table(spark, target) is True
    assert not tables.table_exists(spark, target)


@pytest.mark.parametrize("name", [fresh("nation"), fresh("Dim_Nation")])
def test_versions(spark, sf_dir, name):
    import datetime as dt

    nation = fx.table(spark, sf_dir, "nation")
    for day in (1, 2, 3):
        versioned.write_version(spark, name, nation.where(f"n_nationkey < {day}"), f"2024010{day}T000000",
                                bucket_by=["n_nationkey"], buckets=4)
    assert [v.run_ts for v in versioned.versions(spark, name)] == [f"2024010{d}T000000" for d in (1, 2, 3)]
    assert versioned.read_as_of(spark, name, "20240102T120000").count() == 2
    assert spark.table(name).count() == 3
    assert versioned.version_before(spark, name, "20240103T000000").run_ts == "20240102T000000"
    assert versioned.published(spark, name) == versioned.version_as_of(spark, name).table
    versioned.write_version(spark, name, nation.where("n_nationkey < 3"), "20240103T000000")
    assert len(versioned.versions(spark, name)) == 3
    with pytest.raises(ValueError):
        versioned.read_as_of(spark, name, "20230101T000000")
    versioned.compact(spark, name, ["n_name"])
    assert spark.table(name).count() == 3 and len(versioned.versions(spark, name)) == 3
    gone = versioned.remove_old_versions(spark, name, 24, dt.datetime(2024, 1, 3, 12))
    assert [g.rsplit("__v", 1)[1][:8] for g in gone] == ["20240101", "20240102"]
    assert versioned.remove_old_versions(spark, name, 0) == []
    assert spark.table(name).count() == 3
    with pytest.raises(ValueError):
        versioned.write_version(spark, name, nation, "today")
    assert versioned.drop_versioned(spark, name) is True
    assert not tables.table_exists(spark, name)


def test_buckets_follow_growth(spark, sf_dir):
    name = fresh("nation")
    nation = fx.table(spark, sf_dir, "nation")
    versioned.write_version(spark, name, nation, "20240101T000000", bucket_by=["n_nationkey"], buckets=4)
    base = versioned.version_as_of(spark, name)
    assert versioned.bucket_count(spark, base) == 4 and versioned.version_rows(spark, base) == 25
    gib = 1 << 30
    sizes = {None: 8, 1 << 20: 1, gib: 8, 300 * gib: 1200, 10**15: versioned.MAX_BUCKETS}
    assert {size: versioned.bucket_count(spark, None, size) for size in sizes} == sizes
    assert tables.table_bytes(spark, base.table) > 0 and tables.table_bytes(spark, name) is None
    assert [versioned.bucket_count(spark, base, size) for size in (gib, 3 * gib, 10**15)] == [4, 8, versioned.MAX_BUCKETS]
    assert tables.folder_bytes(spark, "/no/such/folder") == 0


def test_hash_rewrite(spark, sf_dir, tmp_path):
    from lakeload.operators.rowhash import add_row_hash
    from lakeload.plans.hash_rewrite import hash_parquet, hash_table

    nation = fx.table(spark, sf_dir, "nation")
    want = {r.row_hash for r in add_row_hash(nation).collect()}
    hash_parquet(spark, f"{sf_dir}/nation.parquet", f"{tmp_path}/out")
    assert {r.row_hash for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want
    with pytest.raises(ValueError):
        hash_parquet(spark, f"{tmp_path}/out", f"{tmp_path}/out/")
    for keep in (True, False):
        target = fresh("nation")
        bronze.write_snapshot(spark, target, nation, "20240101T000000", keep_versions=keep)
        assert hash_table(spark, target, "20240101T000000", target=f"{target}_copy") == 25
        assert hash_table(spark, target, "20240101T000000") == 25
        assert {r.row_hash for r in spark.table(target).collect()} == want


def test_local_session_without_shared_folder():
    """Without a named folder only a local session may use a temporary one."""
    from lakeload import session

    class Fake:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master, applicationId = "local[2]", "app-1"

    root = session.checkpoint_root(Fake)
    assert root == session.checkpoint_root(Fake)
    Fake.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Fake)


def test_form_changes_are_refused_before_anything_is_written(spark, sf_dir):
    import os

    orders = fx.typed_orders(spark, sf_dir)
    history, snapshot = fresh("history"), fresh("snapshot")
    bronze.append_run(spark, history, orders, "20240101T000000")
    for keep in (True, False):
        with pytest.raises(bronze.FormConflict):
            bronze.write_snapshot(spark, history, orders, "20240102T000000", keep_versions=keep)
    assert spark.table(history).count() == orders.count() and not versioned.versions(spark, history)
    bronze.write_snapshot(spark, snapshot, orders, "20240101T000000")
    plain = fresh("plain")
    bronze.write_snapshot(spark, plain, orders, "20240101T000000", keep_versions=False)
    for target in (snapshot, plain):
        with pytest.raises(bronze.FormConflict):
            bronze.append_run(spark, target, orders, "20240102T000000")
        assert spark.table(target).count() == orders.count()
    assert not os.path.exists("None")


def test_retention_and_compaction_keep_layout(spark, sf_dir):
    orders = fx.typed_orders(spark, sf_dir)
    target = fresh("orders")
    for day in (1, 2, 3):
        bronze.write_snapshot(spark, target, orders, f"2024010{day}T000000")
    assert len(versioned.versions(spark, target)) == 3
    bronze.write_snapshot(spark, target, orders, "20240104T000000", retention_hours=24)
    assert [v.run_ts for v in versioned.versions(spark, target)] == ["20240104T000000"]
    monthly = fresh("monthly")
    bronze.write_window(spark, monthly, orders, "20240101T000000", "o_orderdate", by_month=True)
    versioned.compact(spark, monthly)
    assert tables.partition_columns(spark, versioned.published(spark, monthly)) == ["p_year", "p_month"]
    state = fresh("state")
    versioned.write_version(spark, state, orders, "20240101T000000", ["o_orderkey"], 3)
    versioned.compact(spark, state)
    version = versioned.version_as_of(spark, state)
    assert versioned.stored_buckets(spark, version) == 3 and spark.table(state).count() == orders.count()


def test_batch_load_into_a_streamed_history(spark, sf_dir):
    from lakeload.streaming import ingest

    target, orders = fresh("orders"), fx.typed_orders(spark, sf_dir)
    ingest.ensure_history(spark, target, orders.withColumn("_bronze_load_ts", F.lit("x")))
    for _ in range(2):
        bronze.append_run(spark, target, orders, "20240101T000000")
    assert spark.table(target).count() == orders.count()


@pytest.mark.parametrize("months", [False, True])
def test_a_failed_replacement_changes_nothing(spark, sf_dir, months):
    """The second write raises midway; the first rows are still there, and a third write replaces them."""
    name = f"f_{uuid.uuid4().hex[:8]}.t"
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")

    def write(rows):
        if months:
            return bronze.replace_months(spark, name, rows, "o_orderdate")
        return bronze.append_run(spark, name, rows, "20240101T000000")

    n = orders.count()
    assert write(orders) == n
    last = orders.agg(F.max("o_orderkey")).first()[0]
    with pytest.raises(Exception, match="midway"):
        write(orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("midway")).cast("long"))
                                .otherwise(-F.col("o_orderkey"))))
    assert spark.table(name).where("o_orderkey >= 0").count() == n == spark.table(name).count()
    half = orders.where("month(o_orderdate) <= 6")
    assert write(half) == half.count()
    assert spark.table(name).count() == (n if months else half.count())
