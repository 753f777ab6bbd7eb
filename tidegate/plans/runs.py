"""Queries over a table of runs: leaderboard, comparison, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.operators.latest import best_row


def leaderboard(runs: DataFrame, metric: str, n: int = 10, *, descending: bool = True, origin: str | None = None) -> DataFrame:
    """Top runs that have the metric, ties by run id."""
    rows = runs.filter(F.col("training_origin") == origin) if origin else runs
    order = F.desc(metric) if descending else F.asc(metric)
    return rows.filter(F.col(metric).isNotNull()).orderBy(order, "run_id").limit(n)


def unscored(runs: DataFrame, metric: str, origin: str | None = None) -> DataFrame:
    rows = runs.filter(F.col("training_origin") == origin) if origin else runs
    return rows.agg(F.expr(f"count_if({metric} IS NULL)").alias("n_unscored"), F.count("*").alias("n_runs"))


def compare_runs(metrics: DataFrame, first, second) -> DataFrame:
    """Metric values of two runs over the union of their metric names, with the difference."""
    side = lambda run, name: metrics.filter(F.col("run_id") == run).select("metric", F.col("value").alias(name))
    return side(first, "a").join(side(second, "b"), "metric", "full").selectExpr("metric", "a", "b", "b - a AS delta")


def experiment_summary(runs: DataFrame, metric: str) -> DataFrame:
    """Per experiment: runs by status, next number and best run, in one aggregate."""
    return runs.groupBy("experiment_id").agg(
        F.count("*").alias("n_runs"), F.expr("count_if(status = 'FINISHED')").alias("n_finished"),
        F.expr("count_if(status = 'FAILED')").alias("n_failed"),
        F.expr("coalesce(max(run_number), 0) + 1").alias("next_number"),
        F.max(metric).alias("best_value"),
        F.expr(f"max_by(run_id, IF({metric} IS NULL, NULL, struct({metric}, -run_id)))").alias("best_run_id"))


def strategy_counts(runs: DataFrame) -> DataFrame:
    return runs.filter("coalesce(strategy, '') <> ''").groupBy("strategy").agg(F.count("*").alias("n_runs"))


def recent_failures(runs: DataFrame, n: int = 3) -> DataFrame:
    return runs.filter("status = 'FAILED'").orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def latest_run_per_trial(runs: DataFrame) -> DataFrame:
    return best_row(runs.select("trial_id", "run_id", "started_at"), ["trial_id"], ["started_at", "run_id"])


def dataset_usage(runs: DataFrame) -> DataFrame:
    return runs.groupBy("dataset_id").agg(F.count("*").alias("n_runs"), F.max("started_at").alias("last_used"))
