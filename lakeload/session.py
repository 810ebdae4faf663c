"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Row hashes depend on the session time zone (timestamps are
# hashed as text), dates before 1582 must survive a parquet round trip unchanged, and run
# stamps used as partition values must stay strings.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app_name: str = "lakeload", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`SESSION_CONF` applied.

    Cluster size, memory and the catalog belong to the deployment (``spark-submit``), so they
    are only set when given in ``extra``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


@functools.cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="lakeload-")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without the
    setting gets a temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    return _local_root(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below :func:`checkpoint_root`."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def reliable_checkpoint(spark: SparkSession, df):
    """Cut lineage with a checkpoint that survives the loss of executors."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)
