"""Upkeep of load histories: compaction and retention, and what merges make of them."""

import uuid

import pytest
from pyspark.sql import functions as F

from lakeload.plans.silver import merge_table
from lakeload.plans.spec import TableSpec
from lakeload.sources import bronze, covered, histories
from lakeload.sources.configs import read_mark_store, write_source_marks

RUNS = ["20240101T000000", "20240102T000000", "20240103T000000"]


@pytest.fixture
def spec():
    database = f"h_{uuid.uuid4().hex[:8]}"
    return TableSpec("t", "incremental", f"{database}.t", f"{database}.silver", ("id",))


def load(spark, spec, run, low, high, files=1):
    rows = spark.range(low, high, 1, files).select("id", F.lit(run).alias("value"))
    bronze.append_run(spark, spec.bronze_table, rows, run)


def merged(spark, spec, run):
    record = merge_table(spark, spec, "s", "id", run)
    assert record["status"] == "SUCCESS", record["error_message"]
    return record


def state(spark, spec):
    return {r.id: (r.value, r.is_deleted) for r in spark.table(spec.silver_table).select("id", "value", "is_deleted").collect()}


def test_bins_follow_prefix_sums(spark):
    files = spark.createDataFrame([("l", "p", f"f{i}", n) for i, n in enumerate((60, 60, 60, 300, 10))], covered.FILES)
    bins = {r.file: r.bin for r in histories.packed_files(files, 100).collect()}
    assert bins == {"f0": 0, "f1": 0, "f2": 1, "f3": 1, "f4": 4}


def test_compaction_without_a_named_silver_table_reads_everything_again(spark, spec):
    load(spark, spec, RUNS[0], 0, 50, 6)
    merged(spark, spec, RUNS[0])
    assert histories.compact_history(spark, spec.bronze_table) == 1
    assert histories.compact_history(spark, spec.bronze_table) == 0
    load(spark, spec, RUNS[1], 50, 60)
    merged(spark, spec, RUNS[1])
    assert state(spark, spec) == {i: (RUNS[0] if i < 50 else RUNS[1], False) for i in range(60)}


def test_nothing_goes_that_silver_does_not_cover(spark, spec):
    load(spark, spec, RUNS[0], 0, 5)
    load(spark, spec, RUNS[1], 5, 9)
    assert histories.remove_covered_loads(spark, spec.bronze_table, histories.ALL_RUNS, []) == []
    assert histories.remove_covered_loads(spark, spec.bronze_table, histories.ALL_RUNS, [spec.silver_table]) == []
    merged(spark, spec, RUNS[0])
    assert histories.remove_covered_loads(spark, spec.bronze_table, histories.ALL_RUNS, [spec.silver_table]) == [RUNS[0]]
    assert spark.table(spec.bronze_table).count() == 4
    assert merge_table(spark, spec, "s", "id", RUNS[0])["status"] == "FAILED"


def test_a_full_merge_after_removal_deletes_nothing(spark, spec):
    for i, run in enumerate(RUNS[:2]):
        load(spark, spec, run, 5 * i, 5 * i + 5)
        merged(spark, spec, run)
    assert histories.remove_covered_loads(spark, spec.bronze_table, RUNS[1], [spec.silver_table]) == [RUNS[0]]
    load(spark, spec, RUNS[2], 8, 12)
    assert merge_table(spark, spec, "s", "id", RUNS[2], only_new_loads=False)["status"] == "SUCCESS"
    want = {i: (RUNS[0], False) for i in range(5)} | {i: (RUNS[1], False) for i in range(5, 8)} | {i: (RUNS[2], False) for i in range(8, 12)}
    assert state(spark, spec) == want
    # A load that comes back older than what was removed would be taken for newer than it is.
    load(spark, spec, RUNS[0], 0, 3)
    record = merge_table(spark, spec, "s", "id", RUNS[2])
    assert record["status"] == "FAILED" and RUNS[0] in record["error_message"]
    assert state(spark, spec) == want


def test_marks_of_the_newest_run_count(spark, tmp_path):
    def marks(**tables):
        return spark.createDataFrame(list(tables.items()), "table_name string, watermark string")

    assert read_mark_store(spark, str(tmp_path / "none")).count() == 0
    root = str(tmp_path / "store")
    write_source_marks(marks(a="1", b="007"), root, RUNS[1], "x/y")
    write_source_marks(marks(a="2"), root, RUNS[2], "x/y")
    write_source_marks(marks(a="0", c="3"), root, RUNS[0], "x/y")
    write_source_marks(marks(a="9"), root, RUNS[0], "z")
    found = {(r.source, r.table_name): r.watermark for r in read_mark_store(spark, root).collect()}
    assert found == {("x/y", "a"): "2", ("x/y", "b"): "007", ("x/y", "c"): "3", ("z", "a"): "9"}
