"""Bring the stored watermark map up to date with what an extraction run reported."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeload.operators import watermarks
from lakeload.session import reliable_checkpoint
from lakeload.sources.configs import (
    read_mark_store, read_runtime_watermarks, read_watermark_map, watermark_document, write_document, write_source_marks)


def merge_watermarks(spark: SparkSession, run_path: str, stored_path: str, source: str, run_id: str,
                     target_path: str | None = None, kind: str | Mapping[str, str] | None = None,
                     monotonic: bool = False, store_path: str | None = None, run_ts: str | None = None) -> dict:
    """Newest watermark per table of one run, compared with and merged into the stored map.

    Marks are compared in ``kind``: one for all tables, or a mapping from table name to kind for
    tables whose files hold text; the others' kind follows from the type in their files. Tables
    whose files cannot be read are listed under ``unreadable`` and keep their marks.

    The new map goes to ``target_path`` (another folder than it was read from); without one
    nothing is written. With ``store_path``, a mark store, jobs of several sources may run at once: marks are those of the
    store over the stored map, and the source's merged ones go to its own file of run ``run_ts`` there, nowhere else. The
    returned changes are one entry per updated table.
    """
    if store_path and not run_ts:
        raise ValueError("a mark store needs the run stamp of the run")
    everything = read_mark_store(spark, store_path, stored_path) if store_path else read_watermark_map(spark, stored_path)
    mine = everything.where(F.col("source") == source)
    if mine.isEmpty():
        raise ValueError(f"source {source!r} is not in the watermark map")
    result = {"source": source, "run_id": run_id, "updates_processed": 0, "watermarks_changed": 0,
              "config_updated": False, "changes": [], "unreadable": []}
    updates = read_runtime_watermarks(spark, run_path, result["unreadable"])
    if updates is None:
        return result
    if not isinstance(kind, str):
        # One row per table of the run.
        kind = {r.table_name: r.kind for r in updates.select("table_name", "kind").distinct().collect()} | dict(kind or {})
    newest = watermarks.max_watermarks(updates, kind)
    stored = mine.select("table_name", "watermark")
    compared = watermarks.compare_watermarks(stored, newest).orderBy("table_name").collect()
    changed = [r for r in compared if r.status != watermarks.MATCH]
    result.update(
        updates_processed=len(compared), watermarks_changed=len(changed), config_updated=bool(changed),
        changes=[{"table": r.table_name, "old": r.old_watermark, "new": r.new_watermark, "status": r.status}
                 for r in changed])
    merged = watermarks.merged_watermarks(stored, newest, monotonic_kind=kind if monotonic else None)
    if changed and store_path:
        # Read before it is written: a repeated run replaces the file that its own marks come from.
        write_source_marks(reliable_checkpoint(spark, merged), store_path, run_ts, source)
    elif changed and target_path:
        others = everything.where(F.col("source") != source)
        write_document(watermark_document(
            others.unionByName(merged.withColumn("source", F.lit(source)))), target_path)
    return result
