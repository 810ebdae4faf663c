"""The table registry: one row per table with its load settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
ENABLED_VALUES = ("true", "True", "1")
LOAD_MODES = ("snapshot", "incremental", "window")
DEFAULT_LOAD_MODE = "snapshot"
DEFAULT_SIZE_CLASS = "S"
DEFAULT_BRONZE_SCHEMA, DEFAULT_SILVER_SCHEMA = "bronze", "silver"
# Landing folder below the lake's root, and stored watermarks.
DEFAULT_BASE_FILES = "greenhouse_sources"
DEFAULT_WATERMARKS_PATH = "config/watermarks.json"
INCREMENTAL_SCHEMA = "column STRING, filter_column STRING, kind STRING"
TABLE_KEYS = ("source", "schema_name", "obj_name")


def normalise_tables(documents: DataFrame) -> DataFrame:
    """Explode registry documents to one row per table and settle the spellings: incremental
    columns come as object, as JSON text, or in an older object; window columns under two
    names."""
    exploded = documents.select(
        "source",
        F.coalesce("base_files", F.lit(DEFAULT_BASE_FILES)).alias("base_files"),
        F.coalesce("watermarks_path", F.lit(DEFAULT_WATERMARKS_PATH)).alias("watermarks_path"),
        "connection_name", "defaults", F.posexplode("tables").alias("position", "t"))
    settings = F.from_json("t.incremental_column", INCREMENTAL_SCHEMA)
    return exploded.select(
        "source", "base_files", "watermarks_path", "connection_name", "defaults", "position",
        *[F.col(f"t.{c}").alias(c) for c in (
            "name", "enabled", "size_class", "load_mode", "delta_schema", "delta_table", "base_query",
            "business_keys", "zorder", "partitioning", "single_file", "sync_deletes", "concurrency",
            "max_rows_per_file")],
        F.coalesce("t.incremental.column", settings["column"], settings["filter_column"]).alias("incremental_column"),
        F.coalesce("t.incremental.type", settings["kind"]).alias("incremental_kind"),
        F.coalesce("t.window.column", "t.window.partition_column").alias("window_column"),
        F.col("t.window.granularity").alias("window_granularity"),
        F.col("t.window.lookback_months").alias("lookback_months"),
        F.col("t.window.late_arrival_facts").alias("late_arrival_facts"))


def registry_violations(documents: DataFrame) -> DataFrame:
    """What is wrong with registry documents: (source, position, problem, fatal). An unknown
    load mode is only a warning."""
    size = F.coalesce(F.size("tables"), F.lit(0))
    no_source = F.col("source").isNull() | (F.trim("source") == "")
    whole = F.array(
        F.when(no_source, F.lit("source is missing or empty")),
        F.when(F.col("tables").isNull(), F.lit("tables is missing")),
        F.when(F.col("tables").isNotNull() & (size == 0), F.lit("no tables are defined")))
    head = documents.select(
        "source", F.lit(None).cast("int").alias("position"), F.explode(F.array_compact(whole)).alias("problem"),
        F.lit(True).alias("fatal"))
    tables = documents.select("source", F.posexplode("tables").alias("position", "t"))
    mode = F.lower("t.load_mode")

    def problem(text: Column, fatal: bool) -> Column:
        return F.struct(text.alias("problem"), F.lit(fatal).alias("fatal"))

    rows = tables.select("source", "position", F.explode(F.array_compact(F.array(
        F.when(F.col("t.name").isNull(), problem(F.lit("table without name"), True)),
        F.when(~mode.isin(*LOAD_MODES), problem(F.concat(F.lit("unsupported load mode "), mode), False))))).alias("v"))
    return head.unionByName(rows.select("source", "position", "v.problem", "v.fatal"))


def validate_registry(documents: DataFrame) -> list[str]:
    """Raise on fatal violations; return the warnings. Bounded by the size of the registry."""
    found = registry_violations(documents).collect()
    fatal = [f"{r.source}: {r.problem}" for r in found if r.fatal]
    if fatal:
        raise ValueError("; ".join(sorted(fatal)))
    return sorted(f"{r.source}: {r.problem}" for r in found)


def is_enabled(flag: Column) -> Column:
    """A missing flag means enabled."""
    return F.coalesce(flag.cast("string"), F.lit("true")).isin(*ENABLED_VALUES)


def load_mode_of(mode: Column) -> Column:
    return F.lower(F.coalesce(mode, F.lit(DEFAULT_LOAD_MODE)))


def enabled_tables(tables: DataFrame) -> DataFrame:
    return tables.where(is_enabled(F.col("enabled")))


def retry_tables(tables: DataFrame, retry: DataFrame | None) -> DataFrame:
    """Only the tables named in ``retry`` (column name); all of them when there is no list."""
    return tables if retry is None else tables.join(retry.select("name"), ["name"], "left_semi")


def unknown_retries(tables: DataFrame, retry: DataFrame) -> DataFrame:
    """Names to retry that no table has."""
    return retry.select("name").distinct().join(tables.select("name"), ["name"], "left_anti")


def tables_by_load_mode(tables: DataFrame, mode: str) -> DataFrame:
    return tables.where(load_mode_of(F.col("load_mode")) == mode.lower())


def tables_to_process(tables: DataFrame, retry: DataFrame | None = None, only_enabled: bool = True) -> DataFrame:
    return retry_tables(enabled_tables(tables) if only_enabled else tables, retry)


def with_targets(tables: DataFrame, bronze_schema: str = DEFAULT_BRONZE_SCHEMA,
                 silver_schema: str = DEFAULT_SILVER_SCHEMA) -> DataFrame:
    """Add ``bronze_table`` and ``silver_table``. A qualified target name wins over the schema;
    a silver table is named after its table unless the target already is in silver."""
    target = F.coalesce("delta_table", "name")
    return tables.withColumns({
        "bronze_table": F.when(F.contains(target, F.lit(".")), target).otherwise(
            F.concat_ws(".", F.coalesce("delta_schema", F.lit(bronze_schema)), target)),
        "silver_table": F.when(F.startswith("delta_table", F.lit("silver.")), F.col("delta_table")).otherwise(
            F.concat_ws(".", F.lit(silver_schema), F.col("name"))),
    })


def with_unambiguous_silver(tables: DataFrame) -> DataFrame:
    """Put the source into silver names that several sources share."""
    shared = tables.groupBy("silver_table").agg(F.countDistinct("source").alias("_sources"))
    joined = tables.join(shared, ["silver_table"], "left")
    return joined.withColumn(
        "silver_table",
        F.when(F.col("_sources") > 1, F.concat(
            F.substring_index("silver_table", ".", 1), F.lit("."), F.col("source"), F.lit("__"), F.col("name"))
        ).otherwise(F.col("silver_table"))).drop("_sources")


def target_schemas(tables: DataFrame) -> DataFrame:
    """Schemas that must exist before loading."""
    named = with_targets(tables)
    return named.select(F.substring_index("bronze_table", ".", 1).alias("schema_name")).distinct()


def registry_summary(tables: DataFrame) -> DataFrame:
    """Per source: all, enabled and disabled tables, and enabled tables per load mode."""
    on = is_enabled(F.col("enabled"))
    mode = load_mode_of(F.col("load_mode"))
    return tables.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(on).alias("enabled_tables"),
        F.count_if(~on).alias("disabled_tables"),
        *[F.count_if(on & (mode == m)).alias(f"{m}_tables") for m in LOAD_MODES],
        F.count_if(on & ~mode.isin(*LOAD_MODES)).alias("other_tables"))


def load_mode_counts(tables: DataFrame) -> DataFrame:
    """Enabled tables per source and load mode."""
    return enabled_tables(tables).groupBy("source", load_mode_of(F.col("load_mode")).alias("load_mode")).agg(
        F.count(F.lit(1)).alias("n_tables"))


def pending_tables(tables: DataFrame, successes: DataFrame) -> DataFrame:
    """Tables that have not succeeded yet in a run; ``successes`` is (source, table_name)."""
    done = successes.select("source", F.col("table_name").alias("name"))
    return tables.join(done, ["source", "name"], "left_anti")


def silver_candidates(tables: DataFrame, bronze_successes: DataFrame,
                      silver_successes: DataFrame | None = None) -> DataFrame:
    """Tables with business keys whose bronze load succeeded and whose merge has not.

    Read from the log, not from the session, so a resumed run merges what an earlier attempt
    loaded.
    """
    keyed = tables.where(F.size("business_keys") > 0)
    loaded = bronze_successes.select("source", F.col("table_name").alias("name"))
    ready = keyed.join(loaded, ["source", "name"], "left_semi")
    return ready if silver_successes is None else pending_tables(ready, silver_successes)


# Building a registry -----------------------------------------------------------------------------

def with_source(metadata: DataFrame, sources: DataFrame) -> DataFrame:
    """Column metadata with its ``source``; ``sources`` maps (server, database) to one."""
    mapped = sources.select("source", F.col("server").alias("server_name"), F.col("database").alias("db_name"))
    return metadata.join(mapped, ["server_name", "db_name"], "inner")


def registry_join(base_queries: DataFrame, disabled: DataFrame, sizes: DataFrame, load_modes: DataFrame,
                  windows: DataFrame, excluded: DataFrame, use_load_modes: bool = True) -> DataFrame:
    """Base queries with their settings; tables without a setting get the default, excluded
    tables are left out.

    All relations are keyed by (source, schema_name, obj_name). Join strategies are left to
    adaptive execution: a small configuration is broadcast by its measured size, a large one
    is not.
    """
    keys = list(TABLE_KEYS)

    def flag(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys).distinct().withColumn(name, F.lit(True))

    tables = (base_queries
              .join(flag(disabled, "_disabled"), keys, "left")
              .join(sizes.select(*keys, F.col("size_class").alias("_size")), keys, "left")
              .join(excluded.where("excluded <> 0").select(*keys).distinct(), keys, "left_anti"))
    if use_load_modes:
        tables = (tables
                  .join(load_modes.select(*keys, "load_mode", "filter_column", "kind"), keys, "left")
                  .join(windows.select(*keys, "partition_column", "granularity", "lookback_months"), keys, "left"))
    else:
        empty = {c: F.lit(None).cast("string") for c in
                 ("load_mode", "filter_column", "kind", "partition_column", "granularity")}
        tables = tables.withColumns({**empty, "lookback_months": F.lit(None).cast("int")})
    return tables.select(
        "source", "schema_name", F.col("obj_name").alias("name"),
        F.col("_disabled").isNull().alias("enabled"),
        F.coalesce("_size", F.lit(DEFAULT_SIZE_CLASS)).alias("size_class"),
        F.coalesce("load_mode", F.lit(DEFAULT_LOAD_MODE)).alias("load_mode"),
        "base_query", "filter_column", "kind", "partition_column", "granularity", "lookback_months")


def table_records(tables: DataFrame) -> DataFrame:
    """One JSON object per table; window and incremental settings only where they apply."""
    mode = F.col("load_mode")
    record = F.struct(
        "name", "enabled", "size_class", "load_mode",
        F.col("source").alias("delta_schema"), F.col("name").alias("delta_table"), "base_query",
        F.when(mode == "window", F.struct("partition_column", "granularity", "lookback_months")).alias("window"),
        F.when(mode == "incremental", F.struct(F.col("filter_column").alias("column"), "kind"))
        .alias("incremental_column"))
    return tables.select("source", "name", F.to_json(record).alias("record"))


# Defaults written into every generated registry.
GENERATED_DEFAULTS = {
    "concurrency_large": 2,
    "concurrency_small": 8,
    "max_rows_per_file_large": 15_000_000,
    "max_rows_per_file_small": 1_000_000,
}


def registry_documents(tables: DataFrame) -> DataFrame:
    """One JSON document per source: its settings and its tables ordered by name. A document
    holds one record per table of the source, so its size is that of the source's catalogue."""
    records = table_records(tables)
    grouped = records.groupBy("source").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("name", "record"))), lambda r: r["record"]).alias("records"))
    settings = F.to_json(F.struct(
        "source", F.lit(None).cast("string").alias("run_date_utc"),
        F.lit(DEFAULT_WATERMARKS_PATH).alias("watermarks_path"), F.lit(DEFAULT_BASE_FILES).alias("base_files"),
        F.concat(F.lit("connection_"), F.col("source"), F.lit("_prod")).alias("connection_name"),
        F.struct(*[F.lit(v).alias(k) for k, v in GENERATED_DEFAULTS.items()]).alias("defaults")),
        {"ignoreNullFields": "false"})
    head = F.regexp_replace(settings, r"\}$", "")
    return grouped.select(
        "source", F.concat(head, F.lit(',"tables":['), F.array_join("records", ","), F.lit("]}")).alias("value"))
