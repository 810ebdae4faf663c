"""All queries of this package, and the pipeline."""

import corpus_pipeline
from lakeload.llm import corpus_queries, near_dup_queries, quality_queries, text_queries  # noqa: F401
from lakeload.llm.book import ORACLES, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
