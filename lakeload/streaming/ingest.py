"""Append newly landed files to a bronze history, each file exactly once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeload.operators.current import LOAD_COLUMN
from lakeload.sources.bronze import BATCH_COLUMN
from lakeload.sources.landed import landed_run
from lakeload.sources.tables import ensure_schema_of, quoted, table_exists

PARTITIONS = (LOAD_COLUMN, BATCH_COLUMN)


def landed_stream(spark: SparkSession, root: str, source: str, table: str, schema: StructType | str,
                  max_files_per_batch: int | None = None, **options) -> DataFrame:
    """Stream over all runs of one landed table; each row gets the run stamp of its folder.

    Further file-source options pass through; ``cleanSource="archive"`` with a
    ``sourceArchiveDir`` keeps the listing short where years of runs would pile up.
    """
    reader = spark.readStream.schema(schema).options(**options)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    rows = reader.parquet(f"{root.rstrip('/')}/{source}/*/*/*/*/{table}")
    return rows.select("*", F.col("_metadata.file_path").alias("_bronze_filename")).withColumn(
        LOAD_COLUMN, landed_run("_bronze_filename"))


def ensure_history(spark: SparkSession, target: str, rows: DataFrame) -> None:
    """Create the history table, partitioned by run stamp and micro-batch."""
    if table_exists(spark, target):
        return
    ensure_schema_of(spark, target)
    fields = [f for f in rows.schema.fields if f.name not in PARTITIONS]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = ", ".join(f"`{c}` string" for c in PARTITIONS)
    spark.sql(f"CREATE TABLE {quoted(target)} ({columns}, {parts}) USING parquet "
              f"PARTITIONED BY ({', '.join(f'`{c}`' for c in PARTITIONS)})")


def write_batch(rows: DataFrame, batch_id: int, target: str) -> dict:
    """Write one micro-batch into its own partitions.

    A batch that is repeated after a crash has the same id and the same files, so it overwrites
    exactly what it wrote before; other batches of the same run are not touched.
    """
    session = rows.sparkSession
    # The stream's own session: the setting does not leak into other queries.
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    observation = Observation(uuid.uuid4().hex)
    order = session.table(quoted(target)).columns
    stamped = rows.withColumn(BATCH_COLUMN, F.lit(f"{batch_id:012d}"))
    counted = stamped.observe(observation, F.count(F.lit(1)).alias("rows"), F.max(LOAD_COLUMN).alias("newest_run"))
    counted.select(*order).write.insertInto(quoted(target), overwrite=True)
    return observation.get


def ingest(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str,
           after_batch: Callable[[dict], object] | None = None, continuous: str | None = None) -> StreamingQuery:
    """Start the ingest: all files landed since the last start, then stop (or keep running with
    a ``continuous`` trigger interval).

    ``after_batch`` gets the batch's ``rows`` and ``newest_run`` and may merge into silver. The
    checkpoint folder must be on shared storage; it holds the position in the landed files.
    """
    ensure_history(spark, target, stream)

    def process(rows: DataFrame, batch_id: int) -> None:
        facts = write_batch(rows, batch_id, target)
        if after_batch is not None and facts["rows"]:
            after_batch(facts)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()
