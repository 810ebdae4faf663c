"""Folders of a file system that Spark reaches: listing names and removing what is no longer used."""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

# Fixed value: how partition folders spell a missing value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; no file is opened."""
    place, system = _place(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(place) or []]


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder and all below it; False when there was none."""
    place, system = _place(spark, path)
    return system.delete(place, True)


def partition_folder(values: dict) -> str:
    """Folder name of a partition, as Spark spells it for plain values such as run stamps."""
    return "/".join(f"{c}={NO_VALUE if v is None else quote(str(v), safe='')}" for c, v in values.items())


def partition_values(folder: str) -> dict[str, str | None]:
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {column: None if value == NO_VALUE else unquote(value) for column, value in pairs}
