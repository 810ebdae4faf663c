"""Worker tuning over the run history."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.operators import tuning
from workloads import fixtures as fx
from workloads.book import query


def newest():
    return [F.col("run_id").desc()]


def _runs(spark, sf_dir):
    return tuning.throughput(fx.run_history(spark, sf_dir))


RUNS = (fx.RUN_HISTORY, """
runs AS (
  SELECT source, run_id, run_start AS run_time, workers, total_rows, duration_seconds, efficiency_pct,
         CAST(total_rows AS DOUBLE) / duration_seconds AS throughput_rows_per_sec,
         round(CAST(total_rows AS DOUBLE) / 1000000, 2) AS total_rows_millions
  FROM run_history)""")
PER_WORKERS = RUNS + ("""
per_workers AS (
  SELECT source, workers, count(*) AS num_runs, round(avg(throughput_rows_per_sec), 0) AS avg_throughput,
         round(avg(efficiency_pct), 1) AS avg_efficiency_pct, round(avg(duration_seconds), 0) AS avg_duration_sec,
         round(avg(total_rows_millions), 2) AS avg_rows_millions
  FROM runs GROUP BY source, workers)""",)


@query("throughput", ctes=RUNS, sql="SELECT * FROM runs")
def throughput(spark, sf_dir):
    return _runs(spark, sf_dir)


@query("last_runs", ctes=(fx.RUN_HISTORY,), sql="""
SELECT * FROM run_history
QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_start DESC, run_id DESC) <= 5""")
def last_runs(spark, sf_dir):
    return tuning.last_runs(fx.run_history(spark, sf_dir), 5, newest())


@query("by_workers", ctes=PER_WORKERS, sql="SELECT * FROM per_workers")
def by_workers(spark, sf_dir):
    return tuning.by_workers(_runs(spark, sf_dir))


@query("by_volume", ctes=RUNS, sql="""
SELECT source, CASE WHEN total_rows < 100000 THEN 'Tiny (<100k)' WHEN total_rows < 1000000 THEN 'Small (<1M)'
                    WHEN total_rows < 10000000 THEN 'Medium (<10M)' ELSE 'Large (≥10M)' END AS volume_category,
       workers, count(*) AS runs, round(avg(throughput_rows_per_sec), 0) AS avg_throughput,
       round(avg(efficiency_pct), 1) AS avg_efficiency
FROM runs GROUP BY ALL""")
def by_volume(spark, sf_dir):
    return tuning.by_volume(_runs(spark, sf_dir))


@query("best_workers", ctes=PER_WORKERS, sql="""
SELECT source,
       first(workers ORDER BY avg_throughput DESC, workers) AS best_throughput_workers, max(avg_throughput) AS best_throughput,
       first(workers ORDER BY avg_efficiency_pct DESC, workers) AS best_efficiency_workers,
       max(avg_efficiency_pct) AS best_efficiency
FROM per_workers GROUP BY source""")
def best_workers(spark, sf_dir):
    return tuning.best_workers(tuning.by_workers(_runs(spark, sf_dir)))


@query("speedup", ctes=PER_WORKERS, sql="""
SELECT p.source, p.workers, p.num_runs, p.avg_throughput, round(p.avg_throughput / b.avg_throughput, 2) AS speedup_vs_1worker,
       p.avg_efficiency_pct, p.avg_duration_sec
FROM per_workers p JOIN per_workers b ON p.source = b.source AND b.workers = 1""")
def speedup(spark, sf_dir):
    return tuning.speedup(tuning.by_workers(_runs(spark, sf_dir)))


@query("timeline", ctes=RUNS, sql="""
SELECT source, strftime(run_time, '%Y-%m-%d %H:%M') AS run_date, run_id, workers, total_rows_millions, duration_seconds,
       round(throughput_rows_per_sec, 0) AS throughput, round(efficiency_pct, 1) AS efficiency
FROM runs ORDER BY run_date DESC, source, run_id""")
def timeline(spark, sf_dir):
    return tuning.timeline(_runs(spark, sf_dir))


def recommend_ctes(metric: str, caps: str) -> tuple[str, ...]:
    return (fx.RUN_HISTORY, f"""
recent AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY run_start DESC, run_id DESC) AS age FROM run_history
  QUALIFY age <= 5),
usable AS (SELECT *, {metric} AS metric FROM recent WHERE duration_seconds > 0 AND total_rows > 0 AND efficiency_pct >= 20),
per_count AS (SELECT source, workers, avg(metric) AS metric FROM usable GROUP BY source, workers),
best AS (SELECT source, max(metric) AS best FROM per_count GROUP BY source),
goal AS (
  SELECT source, best, min(workers) AS smallest FROM per_count JOIN best USING (source)
  WHERE metric >= 0.95 * best GROUP BY source, best),
medians AS (SELECT source, CAST(trunc(quantile_cont(total_rows, 0.5)) AS BIGINT) AS median_rows FROM usable GROUP BY source),
last_run AS (SELECT source, workers AS last_workers FROM recent WHERE age = 1),
target AS (
  SELECT source, best, median_rows, greatest(2, least(12, smallest, {caps})) AS target_workers
  FROM goal JOIN medians USING (source)),
recommended AS (
  SELECT l.source, median_rows, round(best, 0) AS best_metric, last_workers, target_workers,
         CASE WHEN target_workers IS NULL THEN last_workers
              WHEN target_workers > last_workers THEN least(last_workers + 2, target_workers, 12)
              WHEN target_workers < last_workers THEN greatest(last_workers - 2, target_workers, 2)
              ELSE last_workers END AS recommended_workers
  FROM last_run l LEFT JOIN target t ON l.source = t.source)""")


THROUGHPUT_METRIC = "CAST(total_rows AS DOUBLE) / duration_seconds"
CAPS = ("CASE WHEN median_rows < 100000 THEN 2 WHEN median_rows < 1000000 THEN 4 "
        "WHEN median_rows < 10000000 THEN 8 ELSE 12 END")
OLDER_CAPS = "CASE WHEN median_rows < 100000 THEN 4 WHEN median_rows < 1000000 THEN 8 ELSE 12 END"


@query("recommend_workers", ctes=recommend_ctes(THROUGHPUT_METRIC, CAPS), sql="SELECT * FROM recommended")
def recommend_workers(spark, sf_dir):
    return tuning.recommend_workers(fx.run_history(spark, sf_dir), tie_breakers=newest())


@query("recommend_workers_efficiency", ctes=recommend_ctes("efficiency_pct", CAPS), sql="SELECT * FROM recommended")
def recommend_workers_efficiency(spark, sf_dir):
    return tuning.recommend_workers(
        fx.run_history(spark, sf_dir), optimize_for="efficiency", tie_breakers=newest())


@query("recommend_workers_older", ctes=recommend_ctes(THROUGHPUT_METRIC, OLDER_CAPS), sql="SELECT * FROM recommended")
def recommend_workers_older(spark, sf_dir):
    return tuning.recommend_workers(
        fx.run_history(spark, sf_dir), caps=tuning.VOLUME_CAPS_OLDER, tie_breakers=newest())


@query("band_workers", ctes=(fx.RUN_HISTORY,), sql="""
SELECT source, workers, efficiency_pct,
       greatest(2, least(12, workers + CASE WHEN efficiency_pct < 40 THEN -2 WHEN efficiency_pct < 60 THEN 0 ELSE 2 END))
         AS recommended_workers
FROM run_history QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_ts DESC, run_id DESC) = 1""")
def band_workers(spark, sf_dir):
    return tuning.band_workers(fx.run_history(spark, sf_dir), tie_breakers=newest())


@query("expected_gain", ctes=PER_WORKERS + recommend_ctes(THROUGHPUT_METRIC, CAPS)[1:], sql="""
SELECT l.source, l.workers AS current_workers, r.recommended_workers, round(l.throughput_rows_per_sec, 0) AS current_throughput,
       p.avg_throughput AS expected_throughput,
       round((p.avg_throughput - l.throughput_rows_per_sec) / l.throughput_rows_per_sec * 100, 1) AS gain_pct
FROM (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_time DESC, run_id DESC) = 1) l
JOIN recommended r ON l.source = r.source AND l.workers <> r.recommended_workers
JOIN per_workers p ON p.source = l.source AND p.workers = r.recommended_workers""")
def expected_gain(spark, sf_dir):
    history = fx.run_history(spark, sf_dir)
    latest = tuning.throughput(tuning.last_runs(history, 1, newest()))
    return tuning.expected_gain(
        latest, tuning.by_workers(tuning.throughput(history)),
        tuning.recommend_workers(history, tie_breakers=newest()))
