"""Catalog tables: existence, location, statistics, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators.zorder import zorder_key

# Section headers of an extended description.
_PARTITIONS, _DETAILS = "# Partition Information", "# Detailed Table Information"


def quoted(name: str) -> str:
    """``db.table`` with back-ticks around each part."""
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}")


def ensure_schema_of(spark: SparkSession, table: str) -> None:
    if "." in table:
        ensure_schema(spark, table.rsplit(".", 1)[0])


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(quoted(table))


def description(spark: SparkSession, table: str) -> tuple[dict[str, str], list[str]]:
    """Entries of the extended description, such as Location or Type, and the partition columns. One call to the catalog, no job;
    columns of those names are told from the entries by their section."""
    entries: dict[str, str] = {}
    parts: list[str] = []
    section = None
    for row in spark.sql(f"DESCRIBE EXTENDED {quoted(table)}").collect():
        if section == _DETAILS:
            entries.setdefault(row.col_name, row.data_type)
        elif row.col_name in (_PARTITIONS, _DETAILS, ""):
            section = row.col_name
        elif section == _PARTITIONS and row.col_name != "# col_name":
            parts.append(row.col_name)
    return entries, parts


def described(spark: SparkSession, table: str, label: str) -> str | None:
    """One entry of the extended description."""
    return description(spark, table)[0].get(label)


def _view_target(entries: dict[str, str]) -> str | None:
    text = entries.get("View Text") if entries.get("Type") == "VIEW" else None
    return text.rsplit(" ", 1)[1].replace("`", "").lower() if text else None


def stored_table(spark: SparkSession, table: str) -> str:
    """Table that holds the rows: the newest version behind the view of a versioned table, otherwise the table itself."""
    return (_view_target(description(spark, table)[0]) if table_exists(spark, table) else None) or table


def table_location(spark: SparkSession, table: str) -> str | None:
    """Folder of a table; of a versioned table, the one of its newest version."""
    if not table_exists(spark, table):
        return None
    entries = description(spark, table)[0]
    target = _view_target(entries)
    return described(spark, target, "Location") if target else entries.get("Location")


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return description(spark, table)[1]


def is_view(spark: SparkSession, table: str) -> bool:
    return table_exists(spark, table) and described(spark, table, "Type") == "VIEW"


def drop_table(spark: SparkSession, table: str) -> bool:
    """Drop a table of any form, with all its versions; False when there was none."""
    if not table_exists(spark, table):
        return False
    if is_view(spark, table):
        from lakeload.sources.versioned import drop_versioned

        drop_versioned(spark, table)
        return True
    spark.sql(f"DROP TABLE {quoted(table)}")
    return True


def row_count(spark: SparkSession, table: str) -> int | None:
    return spark.table(quoted(table)).count() if table_exists(spark, table) else None


def analyze(spark: SparkSession, table: str, columns: bool = True) -> None:
    """Statistics for the optimizer (join order, broadcast decisions); of a versioned table, on its newest version."""
    tail = " FOR ALL COLUMNS" if columns else ""
    spark.sql(f"ANALYZE TABLE {quoted(stored_table(spark, table))} COMPUTE STATISTICS{tail}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a folder; contents are not read. 0 for a missing folder."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first().n


def table_bytes(spark: SparkSession, table: str, partition: str = "") -> int | None:
    """Stored size of a table, or of one partition folder of it. None for a view."""
    entries = description(spark, table)[0] if table_exists(spark, table) else {}
    location = None if entries.get("Type") == "VIEW" else entries.get("Location")
    return folder_bytes(spark, f"{location}/{partition}".rstrip("/")) if location else None


def shaped(df: DataFrame, cluster_by: Sequence[str] = (), files: int | None = None,
           single_file: bool = False, zorder_by: Sequence[str] = ()) -> DataFrame:
    """Lay rows out for writing.

    ``zorder_by`` makes files hold narrow ranges of each of these columns (see :func:`zorder_key`, which scans the rows
    once); it goes before ``cluster_by``.

    ``cluster_by`` makes files hold ranges of these columns. A hash of the row ends the range
    key, so that one value with a third of the rows still spreads over many tasks.

    ``single_file`` asks adaptive execution for as few files as its advisory size allows: one
    for a small table, several for a table that should not pass through one task.
    """
    if single_file:
        return df.hint("rebalance")
    if cluster_by or zorder_by:
        columns: list[Column] = [zorder_key(df, zorder_by)] if zorder_by else [F.col(c) for c in cluster_by]
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        ranged = (df.repartitionByRange(files, *columns, spread) if files
                  else df.repartitionByRange(*columns, spread))
        return ranged.sortWithinPartitions(*columns)
    if files:
        return df.repartition(files)
    return df


def export_parquet(spark: SparkSession, table: str, path: str, mode: str = "overwrite") -> None:
    """Copy a table to parquet files."""
    spark.table(quoted(table)).write.mode(mode).parquet(path)
