"""Queries over the test tables, each with the DuckDB text it is checked against."""

from workloads import (  # noqa: F401
    change_queries, config_queries, job_queries, log_queries, round_trip_queries, storage_queries, tuning_queries)
from workloads.book import ORACLES, QUERIES  # noqa: F401
