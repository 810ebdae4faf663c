"""Layout along a space-filling curve."""

import pytest
from pyspark.sql import functions as F

from lakeload.operators.zorder import zorder_key
from lakeload.sources.tables import shaped


def touched(df, column):
    """Files that a look-up of one value of a column would open, by their smallest and largest values."""
    ranges = df.groupBy(F.spark_partition_id().alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return ranges.where("low <= 300 AND high >= 300").count()


def test_both_columns_skip_files(spark):
    rows = spark.range(20000).select((F.xxhash64("id") % 1000 + 1000).alias("a"), (F.xxhash64(F.col("id") + 7) % 1000).alias("b"))
    rows = rows.select((F.col("a") % 1000).alias("a"), F.abs("b").alias("b"))
    ranged, curved = shaped(rows, ["a", "b"], files=64), shaped(rows, files=64, zorder_by=["a", "b"])
    assert touched(ranged, "b") == 64 and touched(curved, "b") <= 32 and touched(curved, "a") <= 32
    assert curved.count() == 20000


def test_keys_of_every_type(spark):
    rows = spark.sql("""SELECT * FROM VALUES (1, 'a', DATE'2024-01-01', 1.5BD, X'00', TIMESTAMP'2024-01-01 00:00:00', true, array(1)),
        (2, 'b', DATE'2024-01-02', 2.5BD, X'01', TIMESTAMP'2024-01-02 00:00:00', false, array(2)),
        (null, null, null, null, null, null, null, null) t(i, s, d, n, x, t, b, l)""")
    for name in rows.columns[:6]:
        got = [r[0] for r in rows.orderBy(F.col(name).asc_nulls_first()).select(zorder_key(rows, [name])).collect()]
        assert got == sorted(got) and got[0] < got[2], name
    assert rows.select(zorder_key(rows, rows.columns).alias("k")).where("k IS NULL").count() == 0
    assert rows.where("false").select(zorder_key(rows.where("false"), ["i", "s"])).count() == 0
    with pytest.raises(ValueError):
        zorder_key(rows, [])
