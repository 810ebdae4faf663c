"""Exact dedup, embedding whitening and tokenizer alignment over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.book import query
from lakeload.llm.common import table
from lakeload.llm.exact_dedup import exact_duplicates
from lakeload.llm.token_alignment import align_tokenizers
from lakeload.llm.whitening import whiten

EXACT_SQL = """
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS body
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(body) AS text_sha256
FROM plain
WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST)
"""

TOKENIZERS = "/opt/tokenizers"


@query("op11_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


@query("op13_exact_dedup", EXACT_SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whiten(table(spark, sf_dir, "embeddings"))
    return done.withColumn("deviation", F.col("deviation").try_cast("long"))
