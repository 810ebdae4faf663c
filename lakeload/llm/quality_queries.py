"""Toxicity and benchmark decontamination over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.book import query
from lakeload.llm.common import table
from lakeload.llm.decontaminate import benchmark_hits
from lakeload.llm.toxicity import fit_toxicity, held_out, score_toxicity

THRESHOLD = 0.3


@query("op1_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@query("op2_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and test item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select(
        "doc_id", "hit.item_id", "hit.score", "hit.question_overlap", "hit.answer_overlap")
