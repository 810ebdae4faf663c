"""Versioned tables: each run writes a complete new version, a view points at the newest.

Plain parquet has no in-place merge, and Spark refuses to overwrite a table that the same plan
reads. So a version is an ordinary managed table ``<name>__v<run_ts>_<attempt>`` and
``<name>`` itself is a view on the published version:

* readers never see a half-written state: the view moves after the write has finished;
* a crashed run is harmless: every attempt writes a table of its own, and a table enters the
  catalog only when it is complete;
* the view always shows the newest run: repeating an older one replaces that run's version and
  leaves the view alone;
* no version is dropped but on request (:func:`remove_old_versions`), and never the published one;
* versions are bucketed by the merge keys. The next merge reads its large side as it lies,
  without a shuffle; only the incoming rows are moved.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeload.sources.tables import described, drop_table, ensure_schema_of, quoted, shaped, table_exists

# A bucket is sorted and joined by one task.
# Stored bytes per bucket: aimed at, and accepted to stay with the session's partitioning.
BUCKET_BYTES = 256 << 20
BUCKET_BYTES_RANGE = (16 << 20, 512 << 20)
# Rows per bucket of a merge, its two sides together: aimed at, and the most. Narrow rows take a fraction of their memory on disk.
BUCKET_ROWS, MOST_BUCKET_ROWS = 250_000, 1_000_000
MAX_BUCKETS = 100_000  # Spark's own limit
ROWS_PROPERTY = "lakeload.rows"
_RUN_TS = re.compile("[0-9]{8}[Tt][0-9]+")
_NAME = re.compile(r"__v(?P<run_ts>[0-9]{8}t[0-9]+)_(?P<attempt>[0-9a-f]{8})$")


@dataclass(frozen=True)
class Version:
    table: str
    run_ts: str


def _split(name: str) -> tuple[str, str]:
    schema, _, table = name.rpartition(".")
    return schema or "default", table


def versions(spark: SparkSession, name: str) -> list[Version]:
    """Complete versions, oldest first. Two attempts of one run: the published one counts as
    the later. The catalog keeps names in lower case, so all names here are."""
    schema, table = _split(name.lower())
    if not spark.catalog.databaseExists(schema):
        return []
    pattern = f"{table}__v*"
    listed = spark.sql(f"SHOW TABLES IN {quoted(schema)} LIKE '{pattern}'").collect()
    current = published(spark, name)
    found = []
    for row in listed:
        match = _NAME.search(row.tableName)
        if match and row.tableName[:match.start()] == table:
            found.append(Version(f"{schema}.{row.tableName}", match["run_ts"].upper()))
    return sorted(found, key=lambda v: (v.run_ts, v.table == current, v.table))


def published(spark: SparkSession, name: str) -> str | None:
    """Table behind the view, or None when nothing was published."""
    if not table_exists(spark, name):
        return None
    text = described(spark, name, "View Text")
    return text.rsplit(" ", 1)[1].replace("`", "").lower() if text else None


def version_before(spark: SparkSession, name: str, run_ts: str) -> Version | None:
    """Newest version strictly older than a run: what that run, or its replay, builds on."""
    older = [v for v in versions(spark, name) if v.run_ts < run_ts.upper()]
    return older[-1] if older else None


def version_as_of(spark: SparkSession, name: str, run_ts: str | None = None) -> Version | None:
    """Newest version, or the newest one not later than ``run_ts``."""
    known = [v for v in versions(spark, name) if run_ts is None or v.run_ts <= run_ts.upper()]
    return known[-1] if known else None


def version_properties(spark: SparkSession, version: Version) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(version.table)}").collect()}


def version_rows(spark: SparkSession, version: Version) -> int | None:
    """Row count of a version, as counted when it was written."""
    row = (spark.sql(f"SHOW TBLPROPERTIES {quoted(version.table)}")
           .where(F.col("key") == ROWS_PROPERTY).first())
    return int(row.value) if row else None


def read_version(spark: SparkSession, version: Version) -> DataFrame:
    return spark.table(quoted(version.table))


def read_as_of(spark: SparkSession, name: str, run_ts: str | None = None) -> DataFrame:
    version = version_as_of(spark, name, run_ts)
    if version is None:
        raise ValueError(f"{name} has no version at or before {run_ts}")
    return read_version(spark, version)


def stored_buckets(spark: SparkSession, version: Version | None) -> int:
    """Buckets a version was written in; 0 for none."""
    return int(described(spark, version.table, "Num Buckets") or 0) if version else 0


def bucket_count(spark: SparkSession, base: Version | None, expected_bytes: int | None = None,
                 expected_rows: int | None = None) -> int:
    """Buckets of the next version, given the stored size and the rows to expect.

    They stay those of the version it builds on, so that the merge finds both sides alike,
    until buckets would get too large; then they double (one merge pays a shuffle for it). A
    first version takes the session's shuffle partitions where these give buckets of a sensible
    size, and otherwise as many as the size asks for: one for a small table, thousands for a
    huge one. It takes more where the rows of a bucket, which one task sorts, would be too many.
    """
    smallest, largest = BUCKET_BYTES_RANGE
    buckets = stored_buckets(spark, base)
    if not buckets:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if expected_bytes is not None and not smallest * buckets <= expected_bytes <= largest * buckets:
            buckets = max(1, -(-expected_bytes // BUCKET_BYTES))
        return min(MAX_BUCKETS, max(buckets, -(-(expected_rows or 0) // BUCKET_ROWS)))
    while ((expected_bytes or 0) > buckets * largest or (expected_rows or 0) > buckets * MOST_BUCKET_ROWS) and buckets < MAX_BUCKETS:
        buckets = min(buckets * 2, MAX_BUCKETS)
    return buckets


def write_version(spark: SparkSession, name: str, df: DataFrame, run_ts: str,
                  bucket_by: Sequence[str] = (), buckets: int | None = None,
                  partition_by: Sequence[str] = (), metrics: Sequence[Column] = (),
                  drop_columns: Sequence[str] = (), max_rows_per_file: int | None = None,
                  laid_out: bool = False, properties: Mapping[str, str] | None = None) -> dict[str, int]:
    """Write one version; returns its row count ``rows`` and the given metrics. It is published
    unless a later run has a version already.

    Rows are brought together by bucket first, so that each bucket is one file and not one per
    task. ``laid_out`` says they already are, as the result of a merge on the same keys.

    Metrics are aggregates over ``df`` computed by the writing stage itself: counting costs no
    second pass, and since that stage is the last one, rows of a lost executor's repeated tasks
    are not counted twice.
    """
    if not _RUN_TS.fullmatch(run_ts):
        raise ValueError(f"run stamp {run_ts!r} is not yyyyMMddTHHmmss")
    ensure_schema_of(spark, name)
    buckets = buckets or bucket_count(spark, None)
    if bucket_by and not laid_out:
        df = df.repartition(buckets, *bucket_by)
    observation = Observation(uuid.uuid4().hex)
    counted = df.observe(observation, F.count(F.lit(1)).alias("rows"), *metrics)
    target = f"{name}__v{run_ts}_{uuid.uuid4().hex[:8]}".lower()
    writer = counted.drop(*drop_columns).write.format("parquet")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by)
    writer.saveAsTable(quoted(target))
    observed = observation.get
    known = {ROWS_PROPERTY: str(observed["rows"]), **(properties or {})}
    entries = ", ".join(f"'{k}' = '{v}'" for k, v in known.items())
    spark.sql(f"ALTER TABLE {quoted(target)} SET TBLPROPERTIES ({entries})")
    known = versions(spark, name)
    if not any(v.run_ts > run_ts.upper() for v in known) or published(spark, name) is None:
        publish(spark, name, target)
    for other in known:
        if other.run_ts == run_ts.upper() and other.table != ".".join(_split(target)):
            spark.sql(f"DROP TABLE IF EXISTS {quoted(other.table)}")
    return observed


def publish(spark: SparkSession, name: str, target: str) -> None:
    """Point the view at a complete version. A plain table of that name gives way only now, so
    the version may have been computed from it."""
    if table_exists(spark, name) and described(spark, name, "Type") != "VIEW":
        drop_table(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS SELECT * FROM {quoted(target)}")


def later_versions(spark: SparkSession, name: str, run_ts: str) -> list[Version]:
    """Versions of runs after ``run_ts``, oldest first."""
    return [v for v in versions(spark, name) if v.run_ts > run_ts.upper()]


def remove_old_versions(spark: SparkSession, name: str, retention_hours: int = 168,
                        now: dt.datetime | None = None) -> list[str]:
    """Drop versions older than the retention; never the newest nor the published one."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    limit = (now - dt.timedelta(hours=retention_hours)).strftime("%Y%m%dT%H%M%S")
    keep = published(spark, name)
    dropped = []
    for version in versions(spark, name)[:-1]:
        if version.run_ts < limit and version.table != keep:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(version.table)}")
            dropped.append(version.table)
    return dropped


def drop_versioned(spark: SparkSession, name: str) -> bool:
    """Drop the view and every version."""
    known = versions(spark, name)
    spark.sql(f"DROP VIEW IF EXISTS {quoted(name)}")
    for version in known:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(version.table)}")
    return bool(known)


def compact(spark: SparkSession, name: str, cluster_by: Sequence[str] = (), files: int | None = None) -> None:
    """Rewrite the newest version into fewer, optionally clustered, files. Partition columns and
    buckets stay as they are, so a later merge still reads a compacted silver table in place."""
    version = version_as_of(spark, name)
    if version is None:
        raise ValueError(f"{name} has no version to compact")
    rows = read_version(spark, version)
    columns = spark.catalog.listColumns(quoted(version.table))
    partition_by = [c.name for c in columns if c.isPartition]
    bucket_by = [c.name for c in columns if c.isBucket]
    if bucket_by or partition_by:
        rows = rows if bucket_by else rows.hint("rebalance", *[F.col(c) for c in partition_by])
        if cluster_by and not bucket_by:
            rows = rows.sortWithinPartitions(*partition_by, *cluster_by)
    else:
        rows = shaped(rows, cluster_by, files)
    write_version(spark, name, rows, version.run_ts, bucket_by=bucket_by,
                  buckets=stored_buckets(spark, version) or None, partition_by=partition_by)
