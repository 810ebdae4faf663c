"""Near-duplicate queries over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeload.llm.book import query
from lakeload.llm.common import table
from lakeload.llm.embedding_dedup import embedding_components
from lakeload.llm.jaccard_join import jaccard_components
from lakeload.llm.substring_dedup import repeated_passages


@query("op4_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))


@query("op5_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op7_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("spans")
