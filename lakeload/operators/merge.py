"""Merge of a current bronze state into a silver state with soft deletes.

| previous row | new row | hash    | outcome      | inserted | updated | deleted / flag |
|--------------|---------|---------|--------------|----------|---------|----------------|
| none         | yes     |         | INSERT       | run      | run     | NULL / false   |
| active       | yes     | same    | UNCHANGED    | kept     | kept    | kept           |
| active       | yes     | differs | UPDATE       | kept     | run     | NULL / false   |
| deleted      | yes     | any     | RESURRECT    | kept     | run     | NULL / false   |
| active       | none    |         | DELETE *     | kept     | kept    | run / true     |
| deleted      | none    |         | STILL_DELETED| kept     | kept    | kept / true    |

(*) only when deletes are synchronised, otherwise UNCHANGED.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.operators.changes import DELETE, INSERT, UNCHANGED, UPDATE
from lakeload.operators.current import latest_rows
from lakeload.operators.rowhash import add_row_hash, business_columns

RESURRECT, STILL_DELETED = "RESURRECT", "STILL_DELETED"
CHANGE = "_change"
IN_SOURCE = "_in_source"
HASH = "row_hash"
# Silver metadata columns.
SILVER_COLUMNS = {
    "_silver_inserted_ts": "string",
    "_silver_updated_ts": "string",
    "_silver_deleted_ts": "string",
    "is_deleted": "boolean",
}


def any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that cannot be merged because part of their key is missing."""
    return df.where(any_null(keys))


def hashed_source(bronze: DataFrame, keys: Sequence[str], order: Sequence[Column] = (),
                  hash_column: str = HASH, unique_order: bool = False) -> DataFrame:
    """Bronze rows ready to merge: business columns, their hash, one row per complete key.

    ``order`` ranks versions of one key (first wins) and the hash breaks remaining ties. When
    the order is known to be total, ``unique_order`` hashes only the surviving rows.
    De-duplication partitions by the merge keys, and the merge join reuses that layout, so it
    costs no further shuffle.
    """
    business = business_columns(bronze)
    complete = bronze.where(~any_null(keys))
    if unique_order:
        latest = latest_rows(complete, keys, order).select(*business)
        return add_row_hash(latest, hash_column)
    hashed = add_row_hash(complete, hash_column, include_cols=business)
    return latest_rows(hashed, keys, [*order, F.col(hash_column).desc()]).select(*business, hash_column)


def initial_silver(source: DataFrame, run_ts: str) -> DataFrame:
    """First load: every row is an insert of this run."""
    return source.withColumns({
        "_silver_inserted_ts": F.lit(run_ts),
        "_silver_updated_ts": F.lit(run_ts),
        "_silver_deleted_ts": F.lit(None).cast("string"),
        "is_deleted": F.lit(False),
        CHANGE: F.lit(INSERT),
        IN_SOURCE: F.lit(True),
    })


def merge_silver(previous: DataFrame | None, source: DataFrame, keys: Sequence[str], run_ts: str,
                 sync_deletes: bool = True, hash_column: str = HASH) -> DataFrame:
    """The new silver state, with the outcome per row in ``_change`` and whether the source had
    the row in ``_in_source``.

    ``source`` comes from :func:`hashed_source`. One full outer join yields inserts, updates,
    resurrections, deletes and untouched rows together; each input is read once. Columns that
    only one side has are filled with NULL on the other.
    """
    if previous is None:
        return initial_silver(source, run_ts)
    keys = list(keys)
    old_names = [c for c in previous.columns if c not in SILVER_COLUMNS]
    new_names = [c for c in source.columns if c not in old_names]
    output = [c for c in [*old_names, *new_names] if c != hash_column] + [hash_column]

    # Flat prefixed columns and a presence flag per side; only keys keep their names.
    old = previous.select(
        *keys, F.lit(True).alias("_in_old"),
        *[F.col(f"`{c}`").alias(f"_old_{c}") for c in previous.columns if c not in keys])
    new = source.select(
        *keys, F.lit(True).alias("_in_new"),
        *[F.col(f"`{c}`").alias(f"_new_{c}") for c in source.columns if c not in keys])

    has_old, has_new = F.col("_in_old").isNotNull(), F.col("_in_new").isNotNull()
    was_deleted = F.coalesce(F.col("_old_is_deleted"), F.lit(False))
    same = F.col(f"_old_{hash_column}").eqNullSafe(F.col(f"_new_{hash_column}"))
    change = (F.when(~has_old, INSERT)
              .when(has_new & was_deleted, RESURRECT)
              .when(has_new & ~same, UPDATE)
              .when(has_new, UNCHANGED)
              .when(was_deleted, STILL_DELETED)
              .when(F.lit(sync_deletes), DELETE)
              .otherwise(UNCHANGED))
    taken = F.col(CHANGE).isin(INSERT, UPDATE, RESURRECT)
    gone = F.col(CHANGE) == DELETE
    run = F.lit(run_ts)

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(f"`{name}`")
        from_new = F.col(f"`_new_{name}`") if name in source.columns else F.lit(None)
        from_old = F.col(f"`_old_{name}`") if name in previous.columns else F.lit(None)
        return F.when(taken, from_new).otherwise(from_old).alias(name)

    joined = old.join(new, keys, "full_outer").withColumns({CHANGE: change, IN_SOURCE: has_new})
    return joined.select(
        *[pick(name) for name in output],
        F.coalesce(F.col("_old__silver_inserted_ts"), run).alias("_silver_inserted_ts"),
        F.when(taken, run).otherwise(F.col("_old__silver_updated_ts")).alias("_silver_updated_ts"),
        F.when(gone, run).when(taken, F.lit(None)).otherwise(
            F.col("_old__silver_deleted_ts")).alias("_silver_deleted_ts"),
        F.when(gone, True).when(taken, False).otherwise(was_deleted).alias("is_deleted"),
        CHANGE, IN_SOURCE)


def merge_metrics(change: Column | None = None) -> list[Column]:
    """Exact counts of a merge, for one aggregate or for an observation on its write."""
    change = F.col(CHANGE) if change is None else change

    def count(*kinds: str) -> Column:
        return F.count_if(change.isin(*kinds))

    return [
        count(INSERT).alias("rows_inserted"),
        count(UPDATE, RESURRECT).alias("rows_updated"),
        count(DELETE).alias("rows_deleted"),
        count(UNCHANGED).alias("rows_unchanged"),
        F.count(F.lit(1)).alias("total_silver_rows"),
        F.count_if(F.col(IN_SOURCE)).alias("bronze_rows"),
    ]
