"""Which bronze files a silver version covers: a relation of partition, file and length, kept per run.

Files never change: every write has names of its own. So a history has only grown since a version when all files
that the version covers are still there and no other files stand in the partitions of its runs. No clock is asked,
so it does not matter when a run was written, or how long its commit took.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators.current import LOAD_COLUMN
from lakeload.session import scratch_path
from lakeload.sources import bronze
from lakeload.sources.tables import partition_columns, quoted, table_exists, table_location

SUFFIX = "__covered"
FILES = "load string, partition string, file string, length long"


def listed_now(spark: SparkSession, table: str, until: str) -> DataFrame:
    """Files in the registered partitions of a load history, runs up to ``until``; listed when it is read."""
    columns = partition_columns(spark, table)
    parts = spark.sql(f"SHOW PARTITIONS {quoted(table)}").select("partition")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(table_location(spark, table)).select("path", "length"))
    folder = "/".join(f"{c}=[^/]*" for c in columns)
    found = files.select(
        F.regexp_extract("path", f"{LOAD_COLUMN}=([^/]*)", 1).alias("load"), F.regexp_extract("path", f"({folder})/[^/]*$", 1).alias("partition"),
        F.regexp_extract("path", "[^/]*$", 0).alias("file"), "length")
    return found.join(parts, "partition", "left_semi").where(F.col("load") <= until).select("load", "partition", "file", "length")


def listed_files(spark: SparkSession, table: str, until: str) -> DataFrame:
    """:func:`listed_now`, kept as the listing was."""
    kept = f"{scratch_path(spark, 'listing')}"
    listed_now(spark, table, until).write.parquet(kept)
    return spark.read.schema(FILES).parquet(kept)


def covered_files(spark: SparkSession, silver: str, run_ts: str) -> DataFrame | None:
    """Files that the version of a run covers, or None when that was not recorded."""
    name = silver + SUFFIX
    if not table_exists(spark, name):
        return None
    kept = spark.table(quoted(name)).where(F.col(LOAD_COLUMN) <= run_ts)
    runs = kept.select(LOAD_COLUMN, "whole").distinct().collect()
    if run_ts not in {r[0] for r in runs}:
        return None
    first = max((r[0] for r in runs if r["whole"]), default=None)
    return kept.where((F.col(LOAD_COLUMN) >= first) & F.col("file").isNotNull()).select("load", "partition", "file", "length") if first else None


def only_grown(listing: DataFrame, covered: DataFrame | None, run_ts: str) -> bool:
    """Whether the files of runs up to a version are those that it covers."""
    if covered is None:
        return False
    return _same(listing.where(F.col("load") <= run_ts), covered)


def _same(one: DataFrame, other: DataFrame) -> bool:
    both = one.select("*", F.lit(1).alias("n")).unionByName(other.select("*", F.lit(-1).alias("n")))
    return both.groupBy("load", "partition", "file", "length").agg(F.sum("n").alias("n")).where("n <> 0").isEmpty()


def record_covered(spark: SparkSession, silver: str, table: str, run_ts: str, listing: DataFrame, base: DataFrame | None) -> None:
    """Keep what the version of a run covers: the files beyond those of the version that it builds on.

    ``base`` is None where the whole history was read. Nothing is kept, and the next merge reads the whole history,
    where files came or went while the merge ran.
    """
    name = silver + SUFFIX
    if not _same(listing, listed_now(spark, table, run_ts)):
        if table_exists(spark, name):
            later = spark.sql(f"SHOW PARTITIONS {quoted(name)}").where(F.col("partition") == f"{LOAD_COLUMN}={run_ts}").collect()
            bronze.drop_partitions(spark, name, [{LOAD_COLUMN: run_ts}] if later else [])
        return
    fresh = listing if base is None else listing.join(base.select("partition", "file"), ["partition", "file"], "left_anti")
    # A row without a file says that the run was recorded, even when it covers nothing new.
    mark = spark.createDataFrame([(None, None, None, None)], FILES)
    rows = fresh.select("load", "partition", "file", "length").unionByName(mark).withColumn("whole", F.lit(base is None))
    bronze.append_run(spark, name, rows, run_ts)


def replace_files(spark: SparkSession, silver: str, old: DataFrame, new: DataFrame) -> None:
    """Records of covered files after partitions were rewritten or removed: ``old`` files give way to ``new`` ones.

    A run's record of a partition changes only where it holds all old files of that partition and no others. Any other
    record no longer fits the listing, and the next merge reads the whole history.
    """
    name = silver + SUFFIX
    if not table_exists(spark, name):
        return
    kept = spark.table(quoted(name))
    n_old = old.groupBy("partition").agg(F.count("file").alias("n_old"))
    found = kept.join(old.select("partition", "file", "length", F.lit(1).alias("hit")), ["partition", "file", "length"], "left")
    exact = (found.groupBy(LOAD_COLUMN, "partition").agg(F.count("file").alias("n"), F.count("hit").alias("hits"))
             .join(n_old, "partition").where("n = n_old AND hits = n_old").select(LOAD_COLUMN, "partition"))
    # One row per silver run and load.
    place = scratch_path(spark, "exact")
    exact.write.parquet(place)
    exact = spark.read.schema(exact.schema).parquet(place)
    for row in exact.select(LOAD_COLUMN).distinct().orderBy(LOAD_COLUMN).collect():
        run = row[0]
        mine, parts = kept.where(F.col(LOAD_COLUMN) == run), exact.where(F.col(LOAD_COLUMN) == run).select("partition")
        whole = mine.select("whole").first()[0]
        rows = (mine.join(parts, "partition", "left_anti").select("load", "partition", "file", "length")
                .unionByName(new.join(parts, "partition", "left_semi").select("load", "partition", "file", "length")))
        bronze.append_run(spark, name, rows.withColumn("whole", F.lit(whole)), run)
