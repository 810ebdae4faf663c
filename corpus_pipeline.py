"""The corpus pipeline: five stages from raw documents to a mixture.

Each stage takes the documents its predecessor kept, all of them, and returns documents. ``run`` writes every stage to
the shared folder before the next one reads it, so a lost executor or driver costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.common import fresh, stored, table
from lakeload.llm.decontaminate import benchmark_hits
from lakeload.llm.jaccard_join import jaccard_components
from lakeload.llm.line_dedup import drop_repeated_lines
from lakeload.llm.mixing import mix_sources
from lakeload.llm.toxicity import fit_toxicity, score_toxicity

TOXIC = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring below the threshold. Null and empty texts have no evidence against them and stay."""
    model = fit_toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return score_toxicity(docs, model, score).where(F.col(score) < TOXIC).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, rid of repeated lines; ``n_chars`` follows where a document lost some."""
    lines, dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    kept = drop_repeated_lines(docs, n_lines=lines, n_dropped=dropped)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col(dropped) > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; repeated rows of it stay together."""
    name = fresh(docs, "gone")
    gone = (jaccard_components(docs.select("doc_id", "text"))
            .where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct())
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item was found."""
    hits = fresh(docs, "hits")
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"), hits)
    return found.where(F.size(hits) == 0).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture with ``size, source_size, target, epochs, taken``; those of which nothing is taken go."""
    return mix_sources(docs).where("taken > 0")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# Learned scores and block-max WAND have no SQL form; the tests run the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
