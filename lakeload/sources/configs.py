"""Configuration files as DataFrames: table registries, watermark maps, run plans."""

from __future__ import annotations

import functools
import re
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators.registry import normalise_tables
from lakeload.schemas import REGISTRY_SCHEMA, RUNPLAN_SCHEMA, WATERMARK_SCHEMA
from lakeload.sources.landed import is_missing_path


def read_registry(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per table of all given registry files, spellings normalised, with the settings
    of its source."""
    documents = spark.read.schema(REGISTRY_SCHEMA).option("multiLine", True).json(path)
    return normalise_tables(documents)


def read_registry_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The raw documents, one per file, for validation."""
    return spark.read.schema(REGISTRY_SCHEMA).option("multiLine", True).json(path)


def read_watermark_map(spark: SparkSession, path: str) -> DataFrame:
    """Stored watermarks as (source, table_name, watermark); values are text or NULL."""
    documents = spark.read.schema(WATERMARK_SCHEMA).option("multiLine", True).json(path)
    sources = documents.select(F.explode("source").alias("s"))
    return sources.select(F.col("s.name").alias("source"), F.explode("s.tables").alias("table_name", "watermark"))


def mark_folder(root: str, run_ts: str, source: str) -> str:
    """Folder of a mark store that one source owns for one run."""
    return f"{root.rstrip('/')}/run={quote(run_ts, safe='')}/source={quote(source, safe='')}"


def write_source_marks(marks: DataFrame, root: str, run_ts: str, source: str) -> None:
    """Marks of one source after one run (``table_name, watermark``), to a file of their own: jobs of other sources write
    elsewhere, and a repeated run replaces its own file only."""
    own = marks.select(F.lit(source).alias("source"), "table_name", "watermark")
    write_document(watermark_document(own), mark_folder(root, run_ts, source))


def read_mark_store(spark: SparkSession, root: str, stored_path: str | None = None) -> DataFrame:
    """Marks of all sources as (source, table_name, watermark): per table the one of the newest run that has it.

    ``stored_path`` is a map (see :func:`read_watermark_map`) that counts as older than every run. Run stamps sort as text.
    """
    def marks(path: str, run) -> DataFrame:
        documents = spark.read.schema(WATERMARK_SCHEMA).option("multiLine", True).json(path).select(run.alias("run"), F.explode("source").alias("s"))
        return documents.select("run", F.col("s.name").alias("source"), F.explode("s.tables").alias("table_name", "watermark"))

    parts = [marks(stored_path, F.lit(""))] if stored_path else []
    try:
        parts.append(marks(f"{root.rstrip('/')}/run=*/source=*", F.url_decode(F.regexp_extract("_metadata.file_path", "/run=([^/]*)/source=", 1))))
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
    if not parts:
        return spark.createDataFrame([], "source string, table_name string, watermark string")
    return functools.reduce(DataFrame.unionByName, parts).groupBy("source", "table_name").agg(F.max_by("watermark", "run").alias("watermark"))


def source_watermarks(marks: DataFrame, source: str) -> DataFrame:
    return marks.where(F.col("source") == source).select("table_name", "watermark")


def table_watermark(marks: DataFrame, source: str, table: str) -> str | None:
    row = source_watermarks(marks, source).where(F.col("table_name") == table).select("watermark").first()
    return row.watermark if row else None


def _json_value(column):
    """A text column as JSON: quoted and escaped, or null."""
    return F.regexp_extract(F.to_json(F.array(column)), r"(?s)^\[(.*)\]$", 1)


def watermark_document(marks: DataFrame) -> DataFrame:
    """The whole map as one JSON document (one row, one entry per table). Whole numbers that fit
    a long are written as numbers, everything else (leading zeros included) as text."""
    name, mark = F.col("table_name"), F.col("watermark")
    value = F.when(mark.rlike("^(0|[1-9][0-9]{0,17})$"), mark).otherwise(
        F.when(mark.isNull(), "null").otherwise(_json_value(mark)))
    entries = marks.groupBy("source").agg(
        F.array_sort(F.collect_list(F.concat_ws(": ", _json_value(name), value))).alias("entries"))
    one = F.concat(F.lit('{"name": '), _json_value(F.col("source")), F.lit(', "tables": {'),
                   F.array_join("entries", ", "), F.lit("}}"))
    return entries.agg(F.concat(
        F.lit('{"source": ['), F.array_join(F.array_sort(F.collect_list(one)), ", "), F.lit("]}")).alias("value"))


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row document as a folder with one text file."""
    document.coalesce(1).write.mode("overwrite").text(path)


# Kind of a mark by the type of its column; decimals of any precision are numbers, other types are compared as text.
KIND_OF_TYPE = {"bigint": "stamp17", "int": "stamp17", "smallint": "stamp17", "tinyint": "stamp17", "float": "double",
                "double": "double", "timestamp": "datetime", "timestamp_ntz": "datetime", "date": "date"}


def kind_of_type(name: str) -> str:
    return "number" if name.startswith("decimal") else KIND_OF_TYPE.get(name, "text")


def read_runtime_watermarks(spark: SparkSession, run_path: str, unreadable: list[str] | None = None) -> DataFrame | None:
    """Watermarks an extraction run left as ``<run_path>/<table>/*.parquet``: ``table_name``, the
    mark as text, and its ``kind``. None when the run left nothing.

    Folders may differ in the type of their marks: file footers are read per table first, then the
    folders of one type in one scan. A folder without the column has no mark; one that cannot be
    read is named in ``unreadable``, and fails the call where that is not given.
    """
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    try:
        listed = spark.read.format("binaryFile").load(f"{run_path.rstrip('/')}/*/*.parquet")
        # One row per table of the run.
        names = [r[0] for r in listed.select(F.element_at(F.split("path", "/"), -2)).distinct().orderBy(F.lit(1)).collect()]
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise
    kinds: dict[str, list[str]] = {}
    for name in sorted(names):
        try:
            types = dict(spark.read.parquet(f"{run_path.rstrip('/')}/{_glob(name)}").dtypes)
        except Exception:
            if unreadable is None:
                raise
            unreadable.append(name)
            continue
        if "watermark" in types:
            kinds.setdefault(types["watermark"], []).append(f"{run_path.rstrip('/')}/{_glob(name)}")
    parts = [spark.read.parquet(*paths).select(
        F.url_decode(folder).alias("table_name"), F.col("watermark").cast("string").alias("watermark"),
        F.lit(kind_of_type(kind)).alias("kind")) for kind, paths in sorted(kinds.items())]
    return functools.reduce(DataFrame.unionByName, parts) if parts else None


def _glob(name: str) -> str:
    """A folder name as a path pattern that matches it alone."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", name)


def read_runplan(spark: SparkSession, path: str) -> DataFrame:
    """Planned runs; empty when there is no file."""
    try:
        return spark.read.schema(RUNPLAN_SCHEMA).option("multiLine", True).json(path)
    except AnalysisException as error:
        if is_missing_path(error):
            return spark.createDataFrame([], RUNPLAN_SCHEMA)
        raise


def source_schedule(runplan: DataFrame, source: str) -> DataFrame:
    return runplan.where(F.col("source") == source)
