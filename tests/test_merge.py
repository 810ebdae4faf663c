"""The merge truth table against a plain-Python model, on generated states."""

import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeload.operators import current, merge
from lakeload.plans.silver import aligned, merge_table
from lakeload.plans.spec import TableSpec
from lakeload.sources import bronze, versioned

OLD = "k int, v string, row_hash string, _silver_inserted_ts string, _silver_updated_ts string, " \
      "_silver_deleted_ts string, is_deleted boolean"


def expected(old, new, run, sync):
    out = {}
    for k in {*old, *new}:
        o, n = old.get(k), new.get(k)
        if o is None:
            out[k] = (n, run, run, None, False, "INSERT")
        elif n is not None and o["deleted"]:
            out[k] = (n, "r0", run, None, False, "RESURRECT")
        elif n is not None and n != o["v"]:
            out[k] = (n, "r0", run, None, False, "UPDATE")
        elif n is not None:
            out[k] = (o["v"], "r0", "r0", None, False, "UNCHANGED")
        elif o["deleted"]:
            out[k] = (o["v"], "r0", "r0", "r0", True, "STILL_DELETED")
        elif sync:
            out[k] = (o["v"], "r0", "r0", run, True, "DELETE")
        else:
            out[k] = (o["v"], "r0", "r0", None, False, "UNCHANGED")
    return out


states = st.dictionaries(st.integers(0, 12), st.fixed_dictionaries(
    {"v": st.sampled_from("ab"), "deleted": st.booleans()}), max_size=10)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=states, new=st.dictionaries(st.integers(0, 12), st.sampled_from("ab"), max_size=10), sync=st.booleans())
def test_truth_table(spark, old, new, sync):
    source = merge.hashed_source(spark.createDataFrame(list(new.items()), "k int, v string"), ["k"])
    rows = [(k, o["v"], "r0", "r0", "r0" if o["deleted"] else None, o["deleted"]) for k, o in old.items()]
    previous = spark.createDataFrame(
        rows, "k int, v string, _silver_inserted_ts string, _silver_updated_ts string, "
              "_silver_deleted_ts string, is_deleted boolean")
    hashed = merge.add_row_hash(previous, include_cols=["k", "v"])
    got = merge.merge_silver(hashed, source, ["k"], "r1", sync)
    found = {r.k: (r.v, r._silver_inserted_ts, r._silver_updated_ts, r._silver_deleted_ts, r.is_deleted, r._change)
             for r in got.collect()}
    assert found == expected(old, new, "r1", sync)
    assert {r.k for r in got.where("_in_source").collect()} == set(new)


def test_new_and_dropped_columns(spark):
    keys = ["k"]
    first = merge.merge_silver(None, merge.hashed_source(
        spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, gone int"), keys), keys, "r1")
    source = merge.hashed_source(spark.createDataFrame([(2, "b", True), (3, "c", False)], "k int, v string, extra boolean"), keys)
    got = merge.merge_silver(first.drop("_change", "_in_source"), source, keys, "r2", sync_deletes=False)
    rows = {r.k: (r.v, r.gone, r.extra) for r in got.collect()}
    assert rows == {1: ("a", 5, None), 2: ("b", None, True), 3: ("c", None, False)}


def test_duplicates_and_missing_keys(spark):
    target = f"m_{uuid.uuid4().hex[:8]}"
    spec = TableSpec("t", "snapshot", f"{target}.t", f"{target}.s", ("k",))
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "x"), (None, "y")], "k int, v string")
    bronze.write_snapshot(spark, spec.bronze_table, df, "20240101T000000")
    result = merge_table(spark, spec, "s", "id", "20240101T000000")
    assert result["status"] == "SUCCESS" and result["rows_inserted"] == 2
    assert "2 rows without a complete business key" in result["error_message"]
    assert spark.table(f"{target}.s__rejected").count() == 2
    again = merge_table(spark, spec, "s", "id", "20240102T000000")
    assert (again["rows_unchanged"], again["rows_inserted"], again["rows_updated"]) == (2, 0, 0)
    assert merge_table(spark, TableSpec("t"), "s", "id", "20240101T000000")["status"] == "SKIPPED"
    broken = merge_table(spark, TableSpec("t", bronze_table=f"{target}.none", business_keys=("k",)), "s", "id",
                         "20240101T000000")
    assert broken["status"] == "FAILED" and broken["error_message"]


def test_new_loads_only_gives_the_same_state(spark, sf_dir):
    from workloads import fixtures as fx

    name = f"m_{uuid.uuid4().hex[:8]}"
    history = fx.event_history(spark, sf_dir)
    specs = [TableSpec("t", "incremental", f"{name}.h", f"{name}.{s}", ("user_id",), "event_id") for s in ("full", "fast")]
    runs = [r[0] for r in history.select("_bronze_load_ts").distinct().orderBy("_bronze_load_ts").collect()][::9]
    for spec, fast in zip(specs, (False, True)):
        before = None
        for run in runs:
            if not fast:
                load = history.where(F.col("_bronze_load_ts") <= run)
                load = load if before is None else load.where(F.col("_bronze_load_ts") > before)
                bronze.append_run(spark, f"{name}.h", load.drop("_bronze_load_ts"), run)
            result = merge_table(spark, spec, "s", "id", run, only_new_loads=fast)
            assert result["status"] == "SUCCESS", result["error_message"]
            before = run
    full, fast = (spark.table(s.silver_table) for s in specs)
    assert full.exceptAll(fast).isEmpty() and fast.exceptAll(full).isEmpty()
    # A small table is stored in one bucket; in general incoming rows meet the stored buckets.
    state = versioned.version_as_of(spark, specs[0].silver_table)
    assert versioned.stored_buckets(spark, state) == 1
    wide = f"{name}.wide"
    versioned.write_version(spark, wide, versioned.read_version(spark, state), runs[-1], ["user_id"], buckets=8)
    for partitions, exchanges in (("8", 1), ("5", 2)):
        plan = merge_plan(spark, specs[0], versioned.version_as_of(spark, wide), partitions)
        assert plan.count("Exchange hashpartitioning") == exchanges, plan
        silver_side = plan[:plan.index("true AS _in_new")]
        assert "__v" in silver_side and "Exchange" not in silver_side, plan


def test_buckets_follow_the_rows_that_a_task_sorts(spark, monkeypatch):
    """Narrow rows take little room on disk and much in memory: their number decides, and copies of a key count once."""
    monkeypatch.setattr(versioned, "BUCKET_ROWS", 1000)
    monkeypatch.setattr(versioned, "MOST_BUCKET_ROWS", 4000)
    name = f"m_{uuid.uuid4().hex[:8]}"
    spec = TableSpec("t", "snapshot", f"{name}.t", f"{name}.s", ("k",), sync_deletes=True)
    found = []
    for day, n in ((1, 8000), (2, 8500), (3, 40000)):
        run = f"2024010{day}T000000"
        bronze.write_snapshot(spark, spec.bronze_table, spark.range(n).select(F.col("id").alias("k"), F.lit("v").alias("v")), run)
        result = merge_table(spark, spec, "s", "id", run)
        assert result["status"] == "SUCCESS", result["error_message"]
        found.append(versioned.stored_buckets(spark, versioned.version_as_of(spark, spec.silver_table)))
        assert spark.table(spec.silver_table).select("k").distinct().count() == n == spark.table(spec.silver_table).count()
    assert 7 <= found[0] <= 9 and found[1] == found[0] and found[2] == 2 * found[0]
    state = versioned.version_as_of(spark, spec.silver_table)
    places = spark.table(state.table).select(F.col("_metadata.file_path").alias("file")).groupBy("file").count()
    assert places.agg(F.max("count")).first()[0] < 4000
    history = TableSpec("h", "incremental", f"{name}.h", f"{name}.hs", ("k",))
    bronze.append_run(spark, history.bronze_table, spark.range(9000).select((F.col("id") % 900).alias("k"), F.col("id").alias("v")), run)
    assert merge_table(spark, history, "s", "id", run)["rows_inserted"] == 900
    assert versioned.stored_buckets(spark, versioned.version_as_of(spark, history.silver_table)) == 1


def test_a_merge_asks_the_catalog_without_jobs(spark, sf_dir):
    """Most of a small merge is listing and catalog work: a repeated one takes few jobs."""
    from lakeload.sources import tables
    from workloads import fixtures as fx

    name = f"m_{uuid.uuid4().hex[:8]}"
    spec = TableSpec("t", "incremental", f"{name}.h", f"{name}.s", ("user_id",), "event_id")
    bronze.append_run(spark, spec.bronze_table, fx.table(spark, sf_dir, "events"), "20240101T000000")
    assert merge_table(spark, spec, "s", "id", "20240101T000000")["status"] == "SUCCESS"
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "catalog")
    try:
        place = tables.table_location(spark, spec.silver_table)
        assert tables.partition_columns(spark, spec.bronze_table) == ["_bronze_load_ts"]
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
        assert merge_table(spark, spec, "s", "id", "20240101T000000")["status"] == "SUCCESS"
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(key, None)
    assert place and tables.table_location(spark, spec.silver_table) != place
    assert 0 < jobs <= 70, jobs
    # A column may carry the name of an entry.
    spark.sql(f"CREATE TABLE {name}.named (Location int, Type int, `Num Buckets` int, p int) USING parquet PARTITIONED BY (p)")
    assert tables.table_location(spark, f"{name}.named").endswith("named") and not tables.is_view(spark, f"{name}.named")
    assert tables.described(spark, f"{name}.named", "Num Buckets") is None and tables.partition_columns(spark, f"{name}.named") == ["p"]


def merge_plan(spark, spec, base, partitions):
    """Physical plan of the next merge: only the incoming side is shuffled."""
    keys = list(spec.business_keys)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": partitions}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.table(spec.bronze_table)
        source = merge.hashed_source(rows, keys, [F.col("_bronze_load_ts").desc()])
        merged = merge.merge_silver(
            versioned.read_version(spark, base), aligned(source, keys, versioned.stored_buckets(spark, base)),
            keys, "20300101T000000")
        return merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_current_state_ranks_before_the_shuffle(spark, sf_dir):
    from workloads import fixtures as fx

    df = current.latest_versions(fx.event_history(spark, sf_dir), ["user_id"])
    assert df._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_one_key_with_a_third_of_the_rows(spark):
    """The hot key is reduced inside each map task: the shuffle carries a row per task for it."""
    history = spark.range(60000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
        F.format_string("202401%02dT000000", 1 + F.col("id") % 28).alias("_bronze_load_ts"))
    order = [F.col("_bronze_load_ts").desc(), F.col("v").desc()]
    source = merge.hashed_source(history, ["k"], order, unique_order=True)
    got = {r.k: r.v for r in source.collect()}
    rows = [(7 if i % 3 == 0 else i, 1 + i % 28, i) for i in range(60000)]
    want = {}
    for k, day, v in rows:
        want[k] = max(want.get(k, (0, 0)), (day, v))
    assert got == {k: v for k, (_, v) in want.items()}


def test_history_merge_reads_new_runs_only(spark, sf_dir, monkeypatch):
    """A merge opens the runs after its base, unless an older run came in since or the history was restarted."""
    from lakeload.sources import covered
    from workloads import fixtures as fx

    name = f"m_{uuid.uuid4().hex[:8]}"
    spec = TableSpec("t", "incremental", f"{name}.h", f"{name}.s", ("user_id",), "event_id")
    events = fx.table(spark, sf_dir, "events")
    runs = ["20240101T000000", "20240102T000000", "20240103T000000", "20240104T000000"]
    parts = [events.where(F.col("event_id") % 4 == i) for i in range(4)]
    seen = []
    original = covered.only_grown
    monkeypatch.setattr(covered, "only_grown", lambda *a: seen.append(original(*a)) or seen[-1])

    def merged(run):
        result = merge_table(spark, spec, "s", "id", run)
        assert result["status"] == "SUCCESS", result["error_message"]
        return result

    for i in (0, 2):
        bronze.append_run(spark, spec.bronze_table, parts[i], runs[i])
        result = merged(runs[i])
    assert seen == [True] and result["bronze_rows"] == parts[2].select("user_id").distinct().count()
    bronze.append_run(spark, spec.bronze_table, parts[1], runs[1])
    bronze.append_run(spark, spec.bronze_table, parts[3], runs[3])
    result = merged(runs[3])
    assert seen[-1] is False and result["bronze_rows"] == events.select("user_id").distinct().count()
    state = spark.table(spec.silver_table).select("user_id", "event_id")
    newest = current.latest_rows(spark.table(spec.bronze_table), ["user_id"], [F.col("_bronze_load_ts").desc(), F.col("event_id").desc()])
    assert state.exceptAll(newest.select("user_id", "event_id")).isEmpty() and state.count() == newest.count()
    bronze.drop_target(spark, spec.bronze_table)
    bronze.append_run(spark, spec.bronze_table, parts[0], "20240105T000000")
    gone = merged("20240105T000000")
    assert seen[-1] is False and gone["rows_deleted"] == state.join(parts[0], "user_id", "left_anti").count()
