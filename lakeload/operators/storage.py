"""Storage use of landed files by folder level."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Meaning of the folder levels below the landing root.
LEVELS = {1: "source", 2: "year", 3: "month", 4: "day", 5: "run_ts", 6: "table"}


def file_sizes(spark: SparkSession, base_path: str) -> DataFrame:
    """Every file below a path with its folder levels; contents are not read."""
    base = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base_path)
    # Stored paths carry scheme and authority; the given one may not.
    folder = re.sub(r"^[A-Za-z0-9]+:(//[^/]*)?", "", base_path).rstrip("/")
    below = F.regexp_extract("path", rf"^(?:[A-Za-z0-9]+:)?(?://[^/]*)?\Q{folder}\E/(.*)$", 1)
    parts = F.split(below, "/")
    return base.select(
        "path", F.col("length").alias("size_bytes"), F.slice(parts, F.lit(1), F.size(parts) - 1).alias("levels"))


def filter_levels(files: DataFrame, level_filters: dict[int, str] | None) -> DataFrame:
    """Files whose folder at each given level has the given name; folders above that level
    pass."""
    for level, value in sorted((level_filters or {}).items()):
        at = F.get("levels", F.lit(level - 1))
        files = files.where(at.isNull() | (at == value))
    return files


def size_by_level(files: DataFrame, level: int) -> DataFrame:
    """Bytes and file count per folder of one level."""
    folder = F.array_join(F.slice("levels", 1, level), "/")
    return files.groupBy(folder.alias("folder")).agg(
        F.sum("size_bytes").alias("size_bytes"), F.count(F.lit(1)).alias("n_files"))


def largest_folders(sizes: DataFrame, n: int = 20) -> DataFrame:
    return sizes.orderBy(F.col("size_bytes").desc(), "folder").limit(n).select(
        "folder", "n_files", F.round(F.col("size_bytes") / (1 << 20), 2).alias("size_mb"),
        F.round(F.col("size_bytes") / (1 << 30), 2).alias("size_gb"))


def size_totals(sizes: DataFrame) -> DataFrame:
    return sizes.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"),
                     F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"), F.count(F.lit(1)).alias("n_folders"))
