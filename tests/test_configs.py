"""Configuration files: registries in all spellings, watermark maps, run plans."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakeload.operators import metadata, registry, watermarks
from lakeload.plans.registry_build import build_registry, write_registries
from lakeload.plans.watermark_merge import merge_watermarks
from lakeload.sources import configs
from workloads import fixtures as fx


def write(path, document):
    path.write_text(json.dumps(document))
    return str(path)


def table(name, **settings):
    return {"name": name, **settings}


def test_registry_spellings(spark, tmp_path):
    write(tmp_path / "a.json", {"source": "a", "base_files": "in", "tables": [
        table("one", enabled=True, incremental={"column": "x", "type": "date"}, business_keys=["k", "l"]),
        table("two", enabled=0, incremental_column='{"filter_column":"y","kind":"stamp17"}', load_mode="INCREMENTAL"),
        table("three", enabled="1", incremental_column={"column": "z", "kind": "datetime"}, delta_table="silver.three"),
        table("four", window={"column": "d", "lookback_months": 3, "late_arrival_facts": 1}, delta_schema="mart")]})
    write(tmp_path / "b.json", {"source": "b", "tables": [
        table("one", window={"partition_column": "p", "granularity": "month"}, delta_table="x.y")]})
    tables = configs.read_registry(spark, [f"{tmp_path}/a.json", f"{tmp_path}/b.json"])
    rows = {(r.source, r.name): r for r in tables.collect()}
    assert [rows["a", n].incremental_column for n in ("one", "two", "three", "four")] == ["x", "y", "z", None]
    assert [rows["a", n].incremental_kind for n in ("one", "two", "three")] == ["date", "stamp17", "datetime"]
    assert rows["a", "four"].window_column == "d" and rows["b", "one"].window_column == "p"
    assert rows["a", "one"].business_keys == ["k", "l"]
    assert rows["a", "one"].base_files == "in" and rows["b", "one"].base_files == registry.DEFAULT_BASE_FILES
    assert {r.name for r in registry.enabled_tables(tables.where("source = 'a'")).collect()} == {"one", "three", "four"}
    assert [r.name for r in registry.tables_by_load_mode(tables, "incremental").collect()] == ["two"]
    named = {(r.source, r.name): (r.bronze_table, r.silver_table)
             for r in registry.with_unambiguous_silver(registry.with_targets(tables)).collect()}
    assert named == {
        ("a", "one"): ("bronze.one", "silver.a__one"), ("b", "one"): ("x.y", "silver.b__one"),
        ("a", "two"): ("bronze.two", "silver.two"), ("a", "three"): ("silver.three", "silver.three"),
        ("a", "four"): ("mart.four", "silver.four")}


def test_registry_validation(spark, tmp_path):
    good = write(tmp_path / "good.json", {"source": "g", "tables": [table("t", load_mode="window_replace")]})
    assert registry.validate_registry(configs.read_registry_documents(spark, good)) == [
        "g: unsupported load mode window_replace"]
    for i, bad in enumerate(({"tables": [table("t")]}, {"source": " ", "tables": [table("t")]},
                             {"source": "s"}, {"source": "s", "tables": []}, {"source": "s", "tables": [{"enabled": 1}]})):
        path = write(tmp_path / f"bad{i}.json", bad)
        with pytest.raises(ValueError):
            registry.validate_registry(configs.read_registry_documents(spark, path))


MARKS = {"source": [
    {"name": "crm", "tables": {"a": 20251005022543449, "b": None, "c": "2024-01-01T00:00:00", "d": 5}},
    {"name": "other", "tables": {"a": "it's \"quoted\""}}]}


def test_numbers_sort_by_their_keys(spark):
    from decimal import Decimal

    values = ["-120.50", "-120.5", "-120.55", "-9", "-10", "-0", "0", "0.000", "3", "0012", "+7", "1.05", "1.5", "1.", "9" * 38, "-" + "9" * 38]
    rows = spark.createDataFrame([(v,) for v in [*values, "x", "", "1e5", "1 2"]], "v string")
    keys = {r.v: r.k for r in rows.select("v", watermarks.number_key(F.col("v")).alias("k")).collect()}
    assert [v for v, k in keys.items() if k is None] == ["x", "", "1e5", "1 2"]
    for a in values:
        for b in values:
            assert (keys[a] < keys[b]) == (Decimal(a) < Decimal(b)), (a, b)


def test_marks_of_decimals_never_move_back(spark, tmp_path):
    stored, run = f"{tmp_path}/stored", f"{tmp_path}/run"
    old = spark.createDataFrame([("s", "t", "10"), ("s", "u", "-3.50")], "source string, table_name string, watermark string")
    configs.write_document(configs.watermark_document(old), stored)
    spark.sql("select cast(c as decimal(18,0)) watermark from values (9), (7), (null) t(c)").write.parquet(f"{run}/t")
    spark.sql("select cast(c as decimal(38,2)) watermark from values (-3.25), (-10) t(c)").write.parquet(f"{run}/u")
    spark.sql("select cast(c as smallint) watermark from values (9), (10), (-200) t(c)").write.parquet(f"{run}/v")
    result = merge_watermarks(spark, run, stored, "s", "r", f"{tmp_path}/new", monotonic=True)
    assert {c["table"]: c["new"] for c in result["changes"]} == {"t": "9", "u": "-3.25", "v": "10"}
    kept = configs.read_watermark_map(spark, f"{tmp_path}/new")
    assert {r.table_name: r.watermark for r in kept.collect()} == {"t": "10", "u": "-3.25", "v": "10"}
    numbers = spark.sql("select cast(c as decimal(12,2)) c from values (1.00), (1.01), (2) t(c)")
    assert watermarks.incremental_filter(numbers, "c", "number", "1.005").count() == 2


def test_watermark_map_and_merge(spark, tmp_path):
    stored = write(tmp_path / "marks.json", MARKS)
    marks = configs.read_watermark_map(spark, stored)
    assert configs.table_watermark(marks, "crm", "a") == "20251005022543449"
    assert configs.table_watermark(marks, "crm", "b") is None and configs.table_watermark(marks, "none", "a") is None
    run = f"{tmp_path}/runtime/crm/r1"
    for name, values in (("a", ["20251005022543449", "20240101000000000", ""]), ("b", ["20250101000000000", None]),
                         ("d", ["4"]), ("new table", ["7", "10"])):
        spark.createDataFrame([(v,) for v in values], "watermark string").write.parquet(f"{run}/{name}")
    spark.createDataFrame([], "watermark string").write.parquet(f"{run}/nothing")
    target = f"{tmp_path}/new"
    result = merge_watermarks(spark, run, stored, "crm", "r1", target, kind="stamp17")
    assert (result["updates_processed"], result["watermarks_changed"]) == (4, 3)
    assert {c["table"]: (c["old"], c["new"], c["status"]) for c in result["changes"]} == {
        "b": (None, "20250101000000000", "NEW"), "d": ("5", "4", "UPDATE"), "new table": (None, "10", "NEW")}
    text = spark.read.text(target).first().value
    crm, other = json.loads(text)["source"]
    assert crm == {"name": "crm", "tables": {"a": 20251005022543449, "b": 20250101000000000,
                                             "c": "2024-01-01T00:00:00", "d": 4, "new table": 10}}
    assert other == MARKS["source"][1]
    again = configs.read_watermark_map(spark, target)
    assert configs.table_watermark(again, "crm", "d") == "4"
    kept = merge_watermarks(spark, run, stored, "crm", "r1", f"{tmp_path}/mono", kind="stamp17", monotonic=True)
    assert kept["watermarks_changed"] == 3
    assert configs.table_watermark(configs.read_watermark_map(spark, f"{tmp_path}/mono"), "crm", "d") == "5"
    assert not merge_watermarks(spark, f"{tmp_path}/runtime/crm/r2", stored, "crm", "r2")["config_updated"]
    with pytest.raises(ValueError):
        merge_watermarks(spark, run, stored, "unknown", "r1")


def test_text_order_differs_from_number_order(spark):
    df = spark.createDataFrame([("t", "9"), ("t", "10"), ("t", "")], "table_name string, watermark string")
    assert watermarks.max_watermarks(df).first().watermark == "9"
    assert watermarks.max_watermarks(df, "stamp17").first().watermark == "10"
    with pytest.raises(ValueError):
        watermarks.max_watermarks(df, "other")


def test_filters_reach_the_scan(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    assert watermarks.incremental_filter(events, "ts", "datetime", None) is events
    plan = watermarks.incremental_filter(events, "ts", "datetime", "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-20T00:00" in plan
    orders = fx.table(spark, sf_dir, "orders")
    plan = watermarks.lookback_filter(orders, "o_orderdate", dt.date(2001, 7, 15), 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2001-05-01T00:00" in plan


def test_runplan(spark, tmp_path):
    plan = write(tmp_path / "plan.json", [
        {"source": "a", "time": "06:00", "days": "weekday", "config": "x.json"}, {"source": "b", "time": "07:00"}])
    assert [r.config for r in configs.source_schedule(configs.read_runplan(spark, plan), "a").collect()] == ["x.json"]
    assert configs.read_runplan(spark, f"{tmp_path}/none.json").isEmpty()


def test_registry_build_round_trip(spark, sf_dir, tmp_path):
    columns = fx.column_metadata(spark, sf_dir)
    sources = columns.select(
        F.concat(F.lit("src_"), F.substring("server_name", 5, 20)).alias("source"),
        F.col("server_name").alias("server"), F.col("db_name").alias("database")).distinct()
    keys = "source string, schema_name string, obj_name string"
    make = spark.createDataFrame
    path = f"{tmp_path}/registries"
    write_registries(build_registry(
        columns, sources,
        make([("src_0", "dbo", "Obj1")], keys),
        make([("src_0", "dbo", "Obj2", "L")], keys + ", size_class string"),
        make([("src_0", "dbo", "Obj3", "window", "d", "datetime"), ("src_0", "dbo", "Obj4", "incremental", "u", "stamp17")],
             keys + ", load_mode string, filter_column string, kind string"),
        make([("src_0", "dbo", "Obj3", "d", "month", 12)],
             keys + ", partition_column string, granularity string, lookback_months int"),
        make([("src_0", "sales", "Obj5", 1), ("src_0", "sales", "Obj6", 0)], keys + ", excluded int"),
        use_load_modes=True), path)
    assert registry.validate_registry(configs.read_registry_documents(spark, f"{path}/*/*.txt")) == []
    tables = {r.name: r for r in configs.read_registry(spark, f"{path}/*/*.txt").collect()}
    n_tables = columns.select("obj_name").distinct().count()
    assert len(tables) == n_tables - 1 and "Obj5" not in tables and "Obj6" in tables
    assert tables["Obj1"].enabled == "false" and tables["Obj0"].enabled == "true"
    assert (tables["Obj2"].size_class, tables["Obj3"].size_class) == ("L", "S")
    assert (tables["Obj3"].load_mode, tables["Obj3"].window_column, tables["Obj3"].lookback_months) == ("window", "d", 12)
    assert (tables["Obj4"].incremental_column, tables["Obj4"].incremental_kind) == ("u", "stamp17")
    assert tables["Obj0"].base_query.startswith("SELECT ") and tables["Obj0"].base_query.endswith("FROM [dbo].[Obj0]")
    assert tables["Obj0"].connection_name == "connection_src_0_prod" and tables["Obj0"].defaults.concurrency_small == 8
    assert [t.position for t in sorted(tables.values(), key=lambda t: t.name)] == list(range(len(tables)))


def test_metadata_validation(spark, sf_dir):
    columns = fx.column_metadata(spark, sf_dir)
    assert metadata.validate_metadata(columns) is columns
    with pytest.raises(ValueError, match="missing: db_name"):
        metadata.validate_metadata(columns.drop("db_name"))
    with pytest.raises(ValueError, match="empty values: obj_name"):
        metadata.validate_metadata(columns.withColumn("obj_name", F.when(F.col("max_len") > 9, F.col("obj_name"))))


def test_conform_types(spark):
    landed = spark.createDataFrame(
        [("12.345", 7, "2024-01-02 03:04:05.678901", "10:11:12.5", "x", 1)],
        "`unit price` string, flag int, changed string, at string, `2nd` string, extra int")
    described = spark.createDataFrame(
        [("unit price", "decimal", 9, 2, 1), ("flag", "bit", None, None, 2), ("changed", "datetime", None, None, 3),
         ("at", "time", None, None, 4), ("2nd", "cursor", None, None, 5)],
        "column_name string, data_type string, numeric_precision int, numeric_scale int, ordinal_position int")
    got = metadata.conform_types(landed, described)
    assert dict(got.dtypes) == {"unit_price": "decimal(9,2)", "flag": "boolean", "changed": "timestamp_ntz",
                                "at": "string", "_2nd": "string", "extra": "int"}
    row = got.first()
    assert str(row.unit_price) == "12.35" and row.changed.microsecond == 678000 and row.at == "10:11:12"
    with pytest.raises(ValueError, match="collide"):
        metadata.conform_types(landed.withColumn("unit#_price", F.lit(1)).withColumn("unit_price", F.lit(1)), described)
