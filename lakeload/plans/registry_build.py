"""Build registry documents from source column metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeload.operators import metadata, registry


def build_registry(columns: DataFrame, sources: DataFrame, disabled: DataFrame, sizes: DataFrame,
                   load_modes: DataFrame, windows: DataFrame, excluded: DataFrame,
                   use_load_modes: bool = False, source: str | None = None, wide: bool = False) -> DataFrame:
    """One registry document per source (or for one source), as (source, value).

    The whole way from column metadata to JSON text is one plan; nothing passes the driver
    except the result of the metadata check.
    """
    mapped = sources if source is None else sources.where(sources["source"] == source)
    described = registry.with_source(metadata.validate_metadata(columns), mapped)
    queries = metadata.base_queries(described, registry.TABLE_KEYS, wide=wide)
    tables = registry.registry_join(queries, disabled, sizes, load_modes, windows, excluded, use_load_modes)
    return registry.registry_documents(tables)


def write_registries(documents: DataFrame, path: str) -> None:
    """One JSON document per source, below ``<path>/source=<name>/``."""
    documents.write.mode("overwrite").partitionBy("source").text(path)
