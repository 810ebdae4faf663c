"""Writers of bronze tables, one per load mode. Each returns the number of rows written."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeload.operators.current import LOAD_COLUMN
from lakeload.sources import versioned
from lakeload.sources.files import delete_folder, matching_paths, partition_folder, partition_values
from lakeload.sources.tables import (
    drop_table, ensure_schema_of, is_view, partition_columns, quoted, shaped, table_exists, table_location)

# Fixed values.
LOAD_MODES = ("snapshot", "window", "incremental")
DEFAULT_WINDOW_COLUMN = "Boek_Datum"
YEAR_COLUMN, MONTH_COLUMN = "p_year", "p_month"


# A stream adds its micro-batch to the partitions of a load history; a batch load into such a
# history writes this one.
BATCH_COLUMN, BATCH_LOAD = "_bronze_batch", "load"
# Partitions that a load wrote lie in a folder of that attempt below this one.
ATTEMPTS = "attempts"


class SchemaConflict(ValueError):
    """The rows do not fit the target table."""


class FormConflict(SchemaConflict):
    """The target holds what a table of another load mode keeps, and would lose it."""


@dataclass(frozen=True)
class FileShape:
    """How a table's files are laid out."""

    single_file: bool = False
    max_rows_per_file: int | None = None
    cluster_by: Sequence[str] = field(default_factory=tuple)
    zorder_by: Sequence[str] = field(default_factory=tuple)

    def apply(self, df: DataFrame) -> DataFrame:
        return shaped(df, self.cluster_by, single_file=self.single_file, zorder_by=self.zorder_by)


def add_month_columns(df: DataFrame, date_column: str = DEFAULT_WINDOW_COLUMN,
                      year_column: str = YEAR_COLUMN, month_column: str = MONTH_COLUMN) -> DataFrame:
    """Year and month of a date column as partition columns; unchanged without that column."""
    if date_column not in df.columns:
        return df
    return df.withColumns({year_column: F.year(date_column), month_column: F.month(date_column)})


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together before a partitioned write.

    ``rebalance`` lets adaptive execution split partitions that are too large and join those
    that are too small, so a month with a third of the rows is written by many tasks and a
    thin month by one.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def drop_target(spark: SparkSession, target: str) -> None:
    """Remove a table of any form: plain, view, or versioned."""
    if table_exists(spark, target) and not is_view(spark, target):
        drop_table(spark, target)
    versioned.drop_versioned(spark, target)


def _refuse_history(spark: SparkSession, target: str) -> None:
    if table_exists(spark, target) and not is_view(spark, target) and LOAD_COLUMN in partition_columns(spark, target):
        raise FormConflict(f"{target} is a load history; replacing it would lose its earlier runs")


def write_snapshot(spark: SparkSession, target: str, df: DataFrame, run_ts: str,
                   partition_by: Sequence[str] = (), shape: FileShape = FileShape(),
                   keep_versions: bool = True, retention_hours: int | None = None) -> int:
    """Replace a table and its schema; a load history is refused (:class:`FormConflict`).

    By default the new contents are a new version behind a view, so readers see the old table
    until the new one is complete, and a failed write changes nothing. Older versions stay, for
    reading as of a run and for repeating merges, unless ``retention_hours`` is given: then those
    of runs before that time go (see :func:`versioned.remove_old_versions`). ``keep_versions=False``
    overwrites a plain table in place.
    """
    _refuse_history(spark, target)
    rows = shape.apply(df) if not partition_by else by_partition(df, partition_by)
    if keep_versions:
        written = versioned.write_version(
            spark, target, rows, run_ts, partition_by=partition_by,
            max_rows_per_file=shape.max_rows_per_file)["rows"]
        if retention_hours is not None:
            versioned.remove_old_versions(spark, target, retention_hours)
        return written
    ensure_schema_of(spark, target)
    if is_view(spark, target):
        versioned.drop_versioned(spark, target)
    counted, observation = _counted(rows)
    writer = counted.write.format("parquet").mode("overwrite")
    if shape.max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", shape.max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(quoted(target))
    return observation.get["rows"]


def write_window(spark: SparkSession, target: str, df: DataFrame, run_ts: str,
                 date_column: str = DEFAULT_WINDOW_COLUMN, by_month: bool = False,
                 year_column: str = YEAR_COLUMN, month_column: str = MONTH_COLUMN,
                 shape: FileShape = FileShape(), keep_versions: bool = True,
                 retention_hours: int | None = None) -> int:
    """Replace a table by the reloaded window, optionally partitioned by year and month."""
    partition_by: list[str] = []
    if by_month:
        df = add_month_columns(df, date_column, year_column, month_column)
        if year_column not in df.columns:
            raise ValueError(f"{target}: no column {date_column!r} to partition by month")
        partition_by = [year_column, month_column]
    return write_snapshot(spark, target, df, run_ts, partition_by, shape, keep_versions, retention_hours)


def replace_months(spark: SparkSession, target: str, df: DataFrame, date_column: str = DEFAULT_WINDOW_COLUMN,
                   year_column: str = YEAR_COLUMN, month_column: str = MONTH_COLUMN,
                   shape: FileShape = FileShape()) -> int:
    """Replace only the months that occur in ``df``; all other months stay."""
    months = add_month_columns(df, date_column, year_column, month_column)
    columns = [year_column, month_column]
    _ensure_partitioned(spark, target, months, columns)
    return _overwrite_partitions(spark, target, by_partition(months, columns), columns, shape)


def append_run(spark: SparkSession, target: str, df: DataFrame, run_ts: str, evolve: bool = False,
               shape: FileShape = FileShape()) -> int:
    """Add one run to a table's load history, partitioned by run stamp.

    Only this run's partition is written, so repeating a run replaces its rows instead of
    doubling them, and no other run is touched.
    """
    place = {LOAD_COLUMN: run_ts}
    if table_exists(spark, target) and BATCH_COLUMN in partition_columns(spark, target):
        place[BATCH_COLUMN] = BATCH_LOAD
    stamped = df.withColumns({name: F.lit(value) for name, value in place.items()})
    _ensure_partitioned(spark, target, stamped, list(place), evolve)
    return _overwrite_partitions(spark, target, shape.apply(stamped), list(place), shape, static=place)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    observation = Observation(uuid.uuid4().hex)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def _ensure_partitioned(spark: SparkSession, target: str, df: DataFrame, columns: Sequence[str],
                        evolve: bool = False) -> None:
    """Create the partitioned table, or check that the rows fit it."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if not table_exists(spark, target):
        ensure_schema_of(spark, target)
        order = [c for c in df.columns if c not in columns] + list(columns)
        layout = ", ".join(f"`{c}` {kinds[c]}" for c in order)
        parts = ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"CREATE TABLE {quoted(target)} ({layout}) USING parquet PARTITIONED BY ({parts})")
        return
    if is_view(spark, target) or partition_columns(spark, target) != list(columns):
        raise FormConflict(f"{target} is not a table partitioned by {list(columns)}")
    known = {f.name: f.dataType.simpleString() for f in spark.table(quoted(target)).schema.fields}
    changed = sorted(c for c in kinds if c in known and kinds[c] != known[c])
    missing = sorted(c for c in known if c not in kinds)
    added = [c for c in kinds if c not in known]
    if changed or (missing and not evolve) or (added and not evolve):
        raise SchemaConflict(
            f"schema mismatch for {target}: other type {changed}, missing {missing}, new {sorted(added)}")
    if added:
        extra = ", ".join(f"`{c}` {kinds[c]}" for c in added)
        spark.sql(f"ALTER TABLE {quoted(target)} ADD COLUMNS ({extra})")


def _overwrite_partitions(spark: SparkSession, target: str, df: DataFrame, columns: Sequence[str],
                          shape: FileShape, static: dict[str, str] | None = None) -> int:
    """Write partitions to a folder of this attempt, then point the catalog at it and remove the old folders.

    Until the write is complete readers see the old rows, and a failed one changes nothing. Each partition
    switches at once; an attempt that ends halfway through several leaves old and new ones, all of them whole,
    and is made good by the next.
    """
    known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {quoted(target)}").collect()}
    attempt = f"{table_location(spark, target)}/{ATTEMPTS}/{uuid.uuid4().hex}"
    counted, observation = _counted(df)
    writer = counted.drop(*(columns if static else ())).write
    if shape.max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", shape.max_rows_per_file)
    if static:
        written = [partition_folder(static)]
        writer.parquet(f"{attempt}/{written[0]}")
    else:
        writer.partitionBy(*columns).parquet(attempt)
        places = matching_paths(spark, "/".join([attempt, *(f"{c}=*" for c in columns)]))
        written = sorted(p[p.index(f"/{columns[0]}=") + 1:] for p in places)
    switch_partitions(spark, target, attempt, written, known)
    return observation.get["rows"]


def switch_partitions(spark: SparkSession, target: str, attempt: str, folders: Sequence[str], known: set[str]) -> None:
    """Point the catalog at the complete folders of an attempt; of those ``known`` already the old folders go."""
    old = []
    for folder in folders:
        values = partition_values(folder)
        if folder in known:
            old.append(partition_location(spark, target, values))
            change = f"{_partition(values)} SET LOCATION"
        else:
            change = f"ADD {_partition(values)} LOCATION"
        spark.sql(f"ALTER TABLE {quoted(target)} {change} '{attempt}/{folder}'")
    spark.catalog.refreshTable(quoted(target))
    for place in old:
        delete_folder(spark, place)


def remove_partitions(spark: SparkSession, target: str, folders: Sequence[str]) -> None:
    """Remove partitions and their files, wherever these lie."""
    places = [partition_location(spark, target, partition_values(f)) for f in folders]
    drop_partitions(spark, target, [partition_values(f) for f in folders])
    for place in places:
        delete_folder(spark, place)


def partition_location(spark: SparkSession, target: str, values: dict) -> str | None:
    """Folder of one partition."""
    row = (spark.sql(f"DESCRIBE EXTENDED {quoted(target)} {_partition(values)}")
           .where("col_name = 'Location'").select("data_type").first())
    return row.data_type if row else None


def run_folders(spark: SparkSession, target: str, run_ts: str) -> list[str]:
    """Folders of one run of a load history: one, or one for each micro-batch of a stream."""
    found = spark.sql(f"SHOW PARTITIONS {quoted(target)}").where(F.split("partition", "/")[0] == f"{LOAD_COLUMN}={run_ts}")
    return [partition_location(spark, target, partition_values(r.partition)) for r in found.collect()]


def _partition(values: dict) -> str:
    def text(value) -> str:
        return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return "PARTITION (" + ", ".join(f"`{c}` = {text(v)}" for c, v in values.items()) + ")"


def add_partitions(spark: SparkSession, target: str, values: Sequence[dict]) -> None:
    """Make partition folders known to the catalog."""
    for at in range(0, len(values), 500):
        specs = " ".join(_partition(v) for v in values[at:at + 500])
        spark.sql(f"ALTER TABLE {quoted(target)} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(quoted(target))


def drop_partitions(spark: SparkSession, target: str, values: Sequence[dict]) -> None:
    """Remove partitions and their files."""
    for at in range(0, len(values), 500):
        specs = ", ".join(_partition(v) for v in values[at:at + 500])
        spark.sql(f"ALTER TABLE {quoted(target)} DROP IF EXISTS {specs}")
    spark.catalog.refreshTable(quoted(target))
