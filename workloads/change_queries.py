"""Row hashes, current state, change detection and merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.functions import hashing
from lakeload.operators import changes, current, merge, rowhash
from workloads import fixtures as fx
from workloads.book import query

ORDER_KEY = ["o_orderkey"]


# Hashing ------------------------------------------------------------------------------------

@query("row_hash_sha256", money=("o_totalprice",), ctes=(fx.TYPED_ORDERS,),
       sql=f"SELECT *, sha256({fx.ORDERS_HASH_TEXT}) AS row_hash FROM typed_orders")
def row_hash_sha256(spark, sf_dir):
    return rowhash.add_row_hash(fx.typed_orders(spark, sf_dir))


@query("row_hash_md5", money=("o_totalprice",), ctes=(fx.TYPED_ORDERS,),
       sql=f"SELECT *, md5({fx.ORDERS_HASH_TEXT}) AS row_hash FROM typed_orders")
def row_hash_md5(spark, sf_dir):
    return rowhash.add_row_hash(fx.typed_orders(spark, sf_dir), hash_algorithm="md5")


@query("row_hash_separator", ctes=(fx.TYPED_ORDERS,),
       sql="""SELECT o_orderkey, sha256(concat_ws(chr(31), coalesce(CAST(o_orderdate AS VARCHAR), 'none'),
                coalesce(o_orderpriority, 'none'), coalesce(o_orderstatus, 'none'))) AS fingerprint
              FROM typed_orders""")
def row_hash_separator(spark, sf_dir):
    hashed = rowhash.add_row_hash(
        fx.typed_orders(spark, sf_dir), "fingerprint",
        include_cols=["o_orderstatus", "o_orderpriority", "o_orderdate", "o_custkey"],
        exclude_cols=["o_custkey"], null_token="none", separator=hashing.UNIT_SEPARATOR)
    return hashed.select("o_orderkey", "fingerprint")


@query("row_hash_partitioned", ctes=(fx.TYPED_ORDERS,),
       sql=f"""SELECT o_custkey, count(*) AS n_rows, count(DISTINCT sha256({fx.ORDERS_HASH_TEXT})) AS n_hashes
               FROM typed_orders GROUP BY o_custkey""")
def row_hash_partitioned(spark, sf_dir):
    hashed = rowhash.add_row_hash_partitioned(fx.typed_orders(spark, sf_dir), ["o_custkey"])
    return hashed.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_hash").alias("n_hashes"))


@query("business_hash", money=("value",), ctes=(fx.EVENT_HISTORY,),
       sql=f"SELECT *, sha256({fx.EVENT_HASH_TEXT}) AS row_hash FROM event_history")
def business_hash(spark, sf_dir):
    return rowhash.add_business_hash(fx.event_history(spark, sf_dir))


@query("incremental_hash", money=("o_totalprice",), ctes=(fx.TYPED_ORDERS,),
       sql="""SELECT *, sha256(concat_ws('|', coalesce(CAST(o_custkey AS VARCHAR), '∅'),
                coalesce(CAST(o_orderkey AS VARCHAR), '∅'), coalesce(o_orderpriority, '∅'),
                coalesce(o_orderstatus, '∅'), coalesce(CAST(o_totalprice AS VARCHAR), '∅'))) AS row_hash
              FROM typed_orders""")
def incremental_hash(spark, sf_dir):
    return rowhash.add_incremental_hash(fx.typed_orders(spark, sf_dir))


@query("hash_sample", money=("o_totalprice",), ctes=(fx.TYPED_ORDERS,),
       sql=f"SELECT *, sha256({fx.ORDERS_HASH_TEXT}) AS row_hash FROM typed_orders ORDER BY row_hash LIMIT 100")
def hash_sample(spark, sf_dir):
    """The same hundred rows on every run."""
    return rowhash.hash_sample(rowhash.add_row_hash(fx.typed_orders(spark, sf_dir)), 100)


@query("hash_validation", ctes=(fx.TYPED_ORDERS,),
       sql=f"""SELECT count(*) AS total_rows, count(*) FILTER (h IS NULL) AS null_hashes,
                 count(*) FILTER (length(h) NOT IN (32, 64)) AS bad_lengths,
                 CAST(min(length(h)) AS INTEGER) AS min_length, CAST(max(length(h)) AS INTEGER) AS max_length
               FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL
                            WHEN o_orderpriority = '5-LOW' THEN substr(sha256({fx.ORDERS_HASH_TEXT}), 1, 40)
                            ELSE sha256({fx.ORDERS_HASH_TEXT}) END AS h FROM typed_orders)""")
def hash_validation(spark, sf_dir):
    hashed = rowhash.add_row_hash(fx.typed_orders(spark, sf_dir))
    damaged = hashed.withColumn(
        "row_hash", F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(F.col("o_orderpriority") == "5-LOW", F.substring("row_hash", 1, 40))
        .otherwise(F.col("row_hash")))
    return rowhash.hash_quality(damaged)


# Current state --------------------------------------------------------------------------------

@query("current_state", money=("value",), ctes=(fx.EVENT_HISTORY,),
       sql="""SELECT * FROM event_history
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _bronze_load_ts DESC, event_id DESC) = 1""")
def current_state(spark, sf_dir):
    return current.latest_versions(
        fx.event_history(spark, sf_dir), ["user_id"], tie_breakers=[F.col("event_id").desc()])


@query("current_state_as_of", money=("value",), ctes=(fx.EVENT_HISTORY,),
       sql=f"""SELECT * FROM event_history WHERE _bronze_load_ts <= '{fx.AS_OF_RUN}'
               QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                                          ORDER BY _bronze_load_ts DESC, event_id DESC) = 1""")
def current_state_as_of(spark, sf_dir):
    return current.latest_versions(
        fx.event_history(spark, sf_dir), ["user_id", "event_type"], run_ts=fx.AS_OF_RUN,
        tie_breakers=[F.col("event_id").desc()])


# Change detection -----------------------------------------------------------------------------

def _states(spark, sf_dir):
    new = rowhash.add_row_hash(fx.bronze_now(spark, sf_dir))
    return new, fx.silver_before(spark, sf_dir)


@query("cdc_inserts", ctes=(fx.ORDER_STATES,),
       sql="SELECT o_orderkey, row_hash FROM bronze_now n WHERE NOT EXISTS "
           "(SELECT 1 FROM silver_before s WHERE s.o_orderkey = n.o_orderkey)")
def cdc_inserts(spark, sf_dir):
    return changes.insert_keys(*_states(spark, sf_dir), ORDER_KEY)


@query("cdc_deletes", ctes=(fx.ORDER_STATES,),
       sql="SELECT o_orderkey FROM silver_before s WHERE NOT is_deleted AND NOT EXISTS "
           "(SELECT 1 FROM bronze_now n WHERE s.o_orderkey = n.o_orderkey)")
def cdc_deletes(spark, sf_dir):
    return changes.delete_keys(*_states(spark, sf_dir), ORDER_KEY)


@query("cdc_updates", ctes=(fx.ORDER_STATES,),
       sql="SELECT n.o_orderkey FROM bronze_now n JOIN silver_before s USING (o_orderkey) "
           "WHERE n.row_hash <> s.row_hash")
def cdc_updates(spark, sf_dir):
    return changes.update_keys(*_states(spark, sf_dir), ORDER_KEY)


@query("cdc_unchanged", ctes=(fx.ORDER_STATES,),
       sql="SELECT n.o_orderkey FROM bronze_now n JOIN silver_before s USING (o_orderkey) "
           "WHERE n.row_hash = s.row_hash")
def cdc_unchanged(spark, sf_dir):
    return changes.unchanged_keys(*_states(spark, sf_dir), ORDER_KEY)


CLASSIFIED = """
classified AS (
  SELECT coalesce(n.o_orderkey, s.o_orderkey) AS o_orderkey,
         CASE WHEN s.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE'
              WHEN n.row_hash <> s.row_hash THEN 'UPDATE' ELSE 'UNCHANGED' END AS change_type
  FROM bronze_now n FULL JOIN silver_before s ON n.o_orderkey = s.o_orderkey),
counted AS (
  SELECT count(*) FILTER (change_type = 'INSERT') AS inserts, count(*) FILTER (change_type = 'UPDATE') AS updates,
         count(*) FILTER (change_type = 'DELETE') AS deletes, count(*) FILTER (change_type = 'UNCHANGED') AS unchanged
  FROM classified)"""


@query("change_types", ctes=(fx.ORDER_STATES, CLASSIFIED), sql="SELECT * FROM classified")
def change_types(spark, sf_dir):
    return changes.classify_changes(*_states(spark, sf_dir), ORDER_KEY)


@query("change_counts", ctes=(fx.ORDER_STATES, CLASSIFIED), sql="SELECT * FROM counted")
def change_counts(spark, sf_dir):
    return changes.change_counts(*_states(spark, sf_dir), ORDER_KEY)


@query("cdc_statistics", ctes=(fx.ORDER_STATES, CLASSIFIED),
       sql="""SELECT inserts + updates + deletes + unchanged AS total_rows, inserts + updates + deletes AS total_changes,
                inserts, updates, deletes, unchanged,
                CAST(inserts + updates + deletes AS DOUBLE) / (inserts + updates + deletes + unchanged) * 100
                  AS change_rate_pct
              FROM counted""")
def cdc_statistics(spark, sf_dir):
    return changes.cdc_statistics(changes.change_counts(*_states(spark, sf_dir), ORDER_KEY))


# Merge ------------------------------------------------------------------------------------------

def merged_sql(sync_deletes: bool) -> str:
    lost = "'DELETE'" if sync_deletes else "'UNCHANGED'"
    return f"""
merged AS (
  SELECT n, s,
         CASE WHEN s.o_orderkey IS NULL THEN 'INSERT'
              WHEN n.o_orderkey IS NOT NULL AND s.is_deleted THEN 'RESURRECT'
              WHEN n.o_orderkey IS NOT NULL AND n.row_hash <> s.row_hash THEN 'UPDATE'
              WHEN n.o_orderkey IS NOT NULL THEN 'UNCHANGED'
              WHEN s.is_deleted THEN 'STILL_DELETED' ELSE {lost} END AS change
  FROM bronze_now n FULL JOIN silver_before s ON n.o_orderkey = s.o_orderkey),
new_silver AS (
  SELECT coalesce(s.o_orderkey, n.o_orderkey) AS o_orderkey,
         {", ".join(f"CASE WHEN change IN ('INSERT','UPDATE','RESURRECT') THEN n.{c} ELSE s.{c} END AS {c}"
                    for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
                              "row_hash"))},
         coalesce(s._silver_inserted_ts, '{fx.THIS_RUN}') AS _silver_inserted_ts,
         CASE WHEN change IN ('INSERT','UPDATE','RESURRECT') THEN '{fx.THIS_RUN}'
              ELSE s._silver_updated_ts END AS _silver_updated_ts,
         CASE WHEN change = 'DELETE' THEN '{fx.THIS_RUN}' WHEN change IN ('INSERT','UPDATE','RESURRECT') THEN NULL
              ELSE s._silver_deleted_ts END AS _silver_deleted_ts,
         CASE WHEN change = 'DELETE' THEN true WHEN change IN ('INSERT','UPDATE','RESURRECT') THEN false
              ELSE s.is_deleted END AS is_deleted,
         change AS _change, n.o_orderkey IS NOT NULL AS _in_source
  FROM merged)"""


def _merge(spark, sf_dir, sync_deletes):
    source = merge.hashed_source(fx.bronze_now(spark, sf_dir), ORDER_KEY)
    return merge.merge_silver(fx.silver_before(spark, sf_dir), source, ORDER_KEY, fx.THIS_RUN, sync_deletes)


@query("silver_merge", money=("o_totalprice",), ctes=(fx.ORDER_STATES, merged_sql(True)), sql="SELECT * FROM new_silver")
def silver_merge(spark, sf_dir):
    return _merge(spark, sf_dir, sync_deletes=True)


@query("silver_merge_snapshot", money=("o_totalprice",), ctes=(fx.ORDER_STATES, merged_sql(False)), sql="SELECT * FROM new_silver")
def silver_merge_snapshot(spark, sf_dir):
    return _merge(spark, sf_dir, sync_deletes=False)


@query("silver_merge_metrics", ctes=(fx.ORDER_STATES, merged_sql(True)),
       sql="""SELECT count(*) FILTER (_change = 'INSERT') AS rows_inserted,
                count(*) FILTER (_change IN ('UPDATE', 'RESURRECT')) AS rows_updated,
                count(*) FILTER (_change = 'DELETE') AS rows_deleted,
                count(*) FILTER (_change = 'UNCHANGED') AS rows_unchanged, count(*) AS total_silver_rows,
                count(*) FILTER (_in_source) AS bronze_rows
              FROM new_silver""")
def silver_merge_metrics(spark, sf_dir):
    return _merge(spark, sf_dir, sync_deletes=True).agg(*merge.merge_metrics())


@query("silver_initial", money=("value",), ctes=(fx.EVENT_HISTORY,),
       sql=f"""SELECT user_id, event_id, event_type, value, props, sha256({fx.EVENT_HASH_TEXT}) AS row_hash,
                 '{fx.THIS_RUN}' AS _silver_inserted_ts, '{fx.THIS_RUN}' AS _silver_updated_ts,
                 CAST(NULL AS VARCHAR) AS _silver_deleted_ts, false AS is_deleted, 'INSERT' AS _change, true AS _in_source
               FROM event_history
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _bronze_load_ts DESC, event_id DESC) = 1""")
def silver_initial(spark, sf_dir):
    source = merge.hashed_source(
        fx.event_history(spark, sf_dir), ["user_id"],
        [F.col("_bronze_load_ts").desc(), F.col("event_id").desc()])
    return merge.merge_silver(None, source, ["user_id"], fx.THIS_RUN)


HISTORY_STATES = f"""
versions AS (
  SELECT *, sha256({fx.EVENT_HASH_TEXT}) AS row_hash,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY _bronze_load_ts DESC, event_id DESC) AS rn
  FROM event_history),
earlier AS (
  SELECT *, sha256({fx.EVENT_HASH_TEXT}) AS row_hash FROM event_history WHERE _bronze_load_ts <= '{fx.AS_OF_RUN}'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY _bronze_load_ts DESC, event_id DESC) = 1)"""


@query("silver_history_merge", money=("value",), ctes=(fx.EVENT_HISTORY, HISTORY_STATES), sql=f"""
SELECT v.user_id, v.event_id, v.event_type, v.value, v.props, v.row_hash,
       CASE WHEN e.user_id IS NULL THEN '{fx.THIS_RUN}' ELSE '{fx.AS_OF_RUN}' END AS _silver_inserted_ts,
       CASE WHEN e.row_hash = v.row_hash THEN '{fx.AS_OF_RUN}' ELSE '{fx.THIS_RUN}' END AS _silver_updated_ts,
       CAST(NULL AS VARCHAR) AS _silver_deleted_ts, false AS is_deleted,
       CASE WHEN e.user_id IS NULL THEN 'INSERT' WHEN e.row_hash = v.row_hash THEN 'UNCHANGED'
            ELSE 'UPDATE' END AS _change, true AS _in_source
FROM versions v LEFT JOIN earlier e ON v.user_id = e.user_id AND v.event_type = e.event_type
WHERE v.rn = 1""")
def silver_history_merge(spark, sf_dir):
    """Two runs over the event history: first load as of one day, then the rest merged in."""
    keys = ["user_id", "event_type"]
    order = [F.col("_bronze_load_ts").desc(), F.col("event_id").desc()]
    history = fx.event_history(spark, sf_dir)
    first = merge.initial_silver(
        merge.hashed_source(current.loads_until(history, fx.AS_OF_RUN), keys, order), fx.AS_OF_RUN)
    return merge.merge_silver(first.drop(merge.CHANGE, merge.IN_SOURCE), merge.hashed_source(history, keys, order), keys, fx.THIS_RUN)
