"""All tuning views of the run history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.operators import tuning


def tuning_report(summaries: DataFrame, source: str | None = None, lookback_runs: int = 20) -> dict[str, DataFrame]:
    """Named DataFrames over the last runs of every source (or of one)."""
    chosen = summaries if source is None else summaries.where(F.col("source") == source)
    ties = [F.col("run_id").desc()]
    runs = tuning.throughput(tuning.last_runs(chosen, lookback_runs, ties))
    per_workers = tuning.by_workers(runs)
    recommended = tuning.recommend_workers(chosen, tie_breakers=ties)
    latest = tuning.throughput(tuning.last_runs(chosen, 1, ties))
    return {
        "runs": runs,
        "by_workers": per_workers,
        "best_workers": tuning.best_workers(per_workers),
        "speedup": tuning.speedup(per_workers),
        "recommended_throughput": recommended,
        "recommended_efficiency": tuning.recommend_workers(chosen, optimize_for="efficiency", tie_breakers=ties),
        "by_volume": tuning.by_volume(runs),
        "timeline": tuning.timeline(runs),
        "expected_gain": tuning.expected_gain(latest, per_workers, recommended),
    }
