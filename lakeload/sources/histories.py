"""Upkeep of load histories: small files joined, loads removed that silver has taken over."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.operators.current import LOAD_COLUMN
from lakeload.sources import bronze, covered, versioned
from lakeload.sources.files import partition_values
from lakeload.sources.tables import partition_columns, quoted, table_location, table_properties

TARGET_BYTES = 128 << 20
# Sorts after every run stamp.
ALL_RUNS = "~"
# Property of a history: the newest load that was removed from it.
REMOVED = "lakeload.loads_removed"


def packed_files(listing: DataFrame, target_bytes: int) -> DataFrame:
    """``listing`` (see :func:`covered.listed_files`) with the ``bin`` of each file: files of a partition in the order of
    their names, a new bin wherever the sizes before a file pass a multiple of ``target_bytes``."""
    earlier = Window.partitionBy("partition").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(earlier), F.lit(0))
    return listing.withColumn("bin", F.floor(before / F.lit(target_bytes)))


def compact_history(spark: SparkSession, target: str, target_bytes: int = TARGET_BYTES, until: str = ALL_RUNS,
                    silver: Sequence[str] = ()) -> int:
    """Join the small files of every load up to ``until`` into files of about ``target_bytes``; returns the number of
    partitions rewritten.

    A partition is left alone when it has no more files than bins. The others are rewritten in one job, one task and file
    per bin, to a folder of this attempt; then each partition switches to it. One that was loaded again meanwhile keeps
    the new load. ``silver`` names the tables merged from this history: their records of covered files follow, so that
    their next merge still reads new loads only; it reads the whole history where a table is not named. Rows keep no order
    across files.
    """
    columns = partition_columns(spark, target)
    listing = covered.listed_files(spark, target, until)
    bins = packed_files(listing, target_bytes)
    crowded = bins.groupBy("partition").agg(F.count("file").alias("files"), F.countDistinct("bin").alias("bins")).where("files > bins")
    # One row per load.
    chosen = sorted(r.partition for r in crowded.select("partition").collect())
    if not chosen:
        return 0
    places = {p: bronze.partition_location(spark, target, partition_values(p)) for p in chosen}
    attempt = f"{table_location(spark, target)}/{bronze.ATTEMPTS}/{uuid.uuid4().hex}"
    loads = sorted({partition_values(p)[LOAD_COLUMN] for p in chosen})
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(f"`{c}`")) for c in columns])
    rows = spark.table(quoted(target)).where(F.col(LOAD_COLUMN).isin(loads)).select(
        F.struct("*").alias("row"), folder.alias("partition"), F.col("_metadata.file_name").alias("file"))
    chosen_bins = bins.where(F.col("partition").isin(chosen)).select("partition", "file", "bin")
    (rows.where(F.col("partition").isin(chosen)).join(chosen_bins, ["partition", "file"], "left")
     .repartition("partition", F.coalesce("bin", F.lit(0))).select("row.*").write.partitionBy(*columns).parquet(attempt))
    same = [p for p in chosen if bronze.partition_location(spark, target, partition_values(p)) == places[p]]
    bronze.switch_partitions(spark, target, attempt, same, set(same))
    old = listing.where(F.col("partition").isin(same))
    new = covered.listed_files(spark, target, until).where(F.col("partition").isin(same))
    for name in silver:
        covered.replace_files(spark, name, old, new)
    return len(same)


def removed_until(spark: SparkSession, target: str) -> str | None:
    """Newest load that :func:`remove_covered_loads` took away."""
    return table_properties(spark, target).get(REMOVED)


def remove_covered_loads(spark: SparkSession, target: str, before: str, silver: Sequence[str]) -> list[str]:
    """Remove loads of runs before ``before`` that every table of ``silver`` covers; returns their run stamps.

    Loads go oldest first and only up to the first one with a file that some published silver version does not cover, so
    what stays is always newer than what went. Without ``silver`` nothing goes. Afterwards merges of runs up to the newest
    removed load are refused, and full merges delete no keys: those of removed loads live on in silver alone.
    """
    listing = covered.listed_files(spark, target, ALL_RUNS)
    open_from = [before] if silver else [""]
    for name in silver:
        newest = versioned.version_as_of(spark, name)
        known = covered.covered_files(spark, name, newest.run_ts) if newest else None
        if known is None:
            return []
        missing = listing.join(known.select("partition", "file", "length"), ["partition", "file", "length"], "left_anti")
        first = missing.agg(F.min("load")).first()[0]
        open_from += [first] if first is not None else []
    gone = listing.where(F.col("load") < min(open_from)).select("load", "partition").distinct().collect()
    if not gone:
        return []
    newest = max(r.load for r in gone)
    # The mark first: a merge that runs from here on deletes no keys.
    spark.sql(f"ALTER TABLE {quoted(target)} SET TBLPROPERTIES ('{REMOVED}' = '{newest}')")
    bronze.remove_partitions(spark, target, sorted(r.partition for r in gone))
    old = listing.where(F.col("load") <= newest)
    for name in silver:
        covered.replace_files(spark, name, old, old.where("false"))
    return sorted({r.load for r in gone})


def refuse_removed(spark: SparkSession, target: str, run_ts: str, base: versioned.Version | None, listing: DataFrame) -> bool:
    """Whether loads were removed from a history; raises where a merge would need them."""
    newest = removed_until(spark, target)
    if newest is None:
        return False
    if base is None or base.run_ts < newest:
        raise ValueError(f"loads of {target} up to {newest} were removed: run {run_ts} cannot be merged without them")
    late = listing.where(F.col("load") <= newest).select("load").distinct().orderBy("load").limit(5).collect()
    if late:
        raise ValueError(f"loads of {target} up to {newest} were removed, but there are files of {[r.load for r in late]}")
    return True

