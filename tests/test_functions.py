"""Column builders, and their driver-side twins where there are any."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeload.functions import hashing, stamps, text
from lakeload.operators import rowhash


def values(spark, kind, items, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def test_safe_names(spark):
    names = ["Column Name (Special)", "123Column", "  a \t b  ", "Telefoon 2", "DelCd.", "E-mail", "###", "", None, "é"]
    got = values(spark, "string", names, text.safe_identifier(F.col("v")))
    assert got == ["Column_Name_Special", "_123Column", "a_b", "Telefoon_2", "DelCd", "Email", "###", "", "", "é"]
    assert text.safe_column_names(["a b", "1x", "?"]) == ["a_b", "_1x", "?"]


def test_truncation(spark):
    got = values(spark, "string", [None, "", "abc", "abcdef"], text.truncate_message(F.col("v"), 3))
    assert got == [None, None, "abc", "abc... [TRUNCATED]"]
    assert values(spark, "string", [None, ""], text.truncate_message(F.col("v"), 3, empty="")) == ["", ""]
    assert text.truncate_text("abcdef", 3) == "abc... [TRUNCATED]" and text.truncate_text("") is None


MESSAGES = {
    "PATH DOES NOT EXIST: /x": "MISSING_PATH", "x is not a delta table": "CORRUPT_DELTA",
    "protocol version unsupported": "CORRUPT_DELTA", "unsupported\nprotocol": "CORRUPT_DELTA", "protocol": "UNKNOWN",
    "cannot resolve column": "SCHEMA_MISMATCH", "job timed out": "TIMEOUT", "OOM killed": "TIMEOUT",
    "the room is full": "UNKNOWN", "connection timeout": "TIMEOUT", "login failed": "CONNECTION", "": "UNKNOWN"}


def test_error_categories(spark):
    got = values(spark, "string", list(MESSAGES), text.error_category(F.col("v")))
    assert got == list(MESSAGES.values())
    assert [text.classify_exception(m) for m in MESSAGES] == list(MESSAGES.values())


def test_run_stamps(spark):
    runs = ["20240229T010203", "20241231"]
    assert values(spark, "string", runs, stamps.run_date(F.col("v"))) == [dt.date(2024, 2, 29), dt.date(2024, 12, 31)]
    assert values(spark, "string", ["2024", "99999999", None], stamps.run_date(F.col("v"), strict=False)) == [None] * 3
    for bad in ("2024", "20241399T000000"):
        with pytest.raises(Exception):
            values(spark, "string", [bad], stamps.run_date(F.col("v")))
    assert stamps.parse_run_date("20240229T010203") == dt.date(2024, 2, 29)
    for bad in ("2024", "20241399", None):
        with pytest.raises(ValueError):
            stamps.parse_run_date(bad)
    assert stamps.new_run_ts(dt.datetime(2024, 1, 2, 3, 4, 5, 678901)) == "20240102T030405678"
    assert values(spark, "bigint", [20251005022543449, 7], stamps.stamp17_to_timestamp(F.col("v"))) == [
        dt.datetime(2025, 10, 5, 2, 25, 43, 449000), None]


def test_hash_columns(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "∅")], "x string, y string")
    plain = [r.row_hash for r in rowhash.add_row_hash(df).collect()]
    split = [r.row_hash for r in rowhash.add_row_hash(df, separator=hashing.UNIT_SEPARATOR).collect()]
    assert plain[0] == plain[1] and split[0] != split[1]
    assert len(rowhash.add_row_hash(df, hash_algorithm="md5").first().row_hash) == 32
    swapped = rowhash.add_row_hash(df.select("y", "x")).select("row_hash").collect()
    assert [r.row_hash for r in swapped] == plain
    for bad in ({"include_cols": ["z"]}, {"exclude_cols": ["z"]}, {"exclude_cols": ["x", "y"]},
                {"hash_algorithm": "crc"}, {"hash_column": "x"}):
        with pytest.raises(ValueError):
            rowhash.add_row_hash(df, **bad)
    meta = df.selectExpr("*", "'r' _bronze_load_ts", "1 _load_id", "current_date() d", "timestamp_ntz'2024-01-01' t")
    kept = rowhash.add_business_hash(meta.drop("d", "t")).select("row_hash").collect()
    assert [r.row_hash for r in kept] == plain
    assert rowhash.business_columns(meta) == ["x", "y", "_load_id", "d", "t"]
    dated = rowhash.add_incremental_hash(meta.drop("_bronze_load_ts", "_load_id")).select("row_hash").collect()
    assert [r.row_hash for r in dated] == plain


def test_hash_validation(spark):
    df = rowhash.add_row_hash(spark.createDataFrame([(1,), (2,), (3,)], "k int"))
    assert rowhash.validate_hash_columns(df) and rowhash.validate_hash_columns(df, max_rows=1, expected_columns=["k"])
    late = df.withColumn("row_hash", F.when(F.col("k") < 3, F.col("row_hash")).otherwise("short"))
    for bad in (df.where("false"), late, df.withColumn("row_hash", F.when(F.col("k") > 1, F.col("row_hash"))),
                df.drop("row_hash"), df.withColumn("row_hash", F.lit(1))):
        with pytest.raises(ValueError):
            rowhash.validate_hash_columns(bad)
    with pytest.raises(ValueError):
        rowhash.validate_hash_columns(df, expected_columns=["z"])
