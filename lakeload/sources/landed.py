"""Files an extractor landed: ``<root>/<source>/<yyyy>/<MM>/<dd>/<run_ts>/<table>/*.parquet``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.stamps import parse_run_date

def landed_path(root: str, source: str, run_ts: str, table: str) -> str:
    """Folder of one table of one run; the date folders come from the run stamp."""
    day = parse_run_date(run_ts)
    return f"{root.rstrip('/')}/{source}/{day:%Y/%m/%d}/{run_ts}/{table}"


def is_missing_path(error: BaseException) -> bool:
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"


def read_landed(spark: SparkSession, root: str, source: str, run_ts: str, table: str) -> DataFrame | None:
    """The landed rows, or None when this run has no files for the table. Other read errors
    are raised."""
    try:
        return spark.read.parquet(landed_path(root, source, run_ts, table) + "/*.parquet")
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise


def add_load_metadata(df: DataFrame, run_ts: str) -> DataFrame:
    """Add the run stamp and each row's file name. ``df`` must come straight from files."""
    return df.withColumns({
        "_bronze_load_ts": F.lit(run_ts),
        "_bronze_filename": F.col("_metadata.file_path"),
    })


def read_files(spark: SparkSession, kind: str, path: str | list[str], **options) -> DataFrame:
    """Parquet, JSON or CSV files with reader options."""
    if kind not in ("parquet", "json", "csv"):
        raise ValueError(f"unsupported file kind {kind!r}")
    return spark.read.options(**options).format(kind).load(path)


def landed_run(file_path: str = "_metadata.file_path"):
    """Run stamp column taken from a landed file's path (second folder above the file)."""
    return F.element_at(F.split(F.col(file_path), "/"), -3)
