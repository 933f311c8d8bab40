"""Collector run metrics: per run, per collector, and one collector against another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.maths import round_half_even

# The compared figures with display names; lower is better in all of them.
METRICS = [
    ("avg_execution_time", "Execution Time (seconds)"),
    ("avg_cpu_across_runs", "Average CPU Usage (%)"),
    ("avg_max_cpu", "Max CPU Usage (%)"),
    ("avg_memory_across_runs", "Average Memory (MB)"),
    ("avg_max_memory", "Max Memory (MB)"),
]
# Decimals kept in a run row and in a summary row.
RUN_DIGITS = {
    "execution_time_seconds": 2,
    "avg_cpu_percent": 1,
    "max_cpu_percent": 1,
    "avg_memory_mb": 2,
    "max_memory_mb": 2,
}
SUMMARY_DIGITS = {
    "avg_execution_time": 2,
    "min_execution_time": 2,
    "max_execution_time": 2,
    "avg_cpu_across_runs": 1,
    "avg_max_cpu": 1,
    "avg_memory_across_runs": 2,
    "avg_max_memory": 2,
}
# How far from 1 a ratio must be to count as an advantage.
BETTER, WORSE = 1.1, 0.9


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: round_half_even(F.col(c), d) for c, d in digits.items() if c in df.columns})


def run_usage(samples: DataFrame, by: list[str], rounded: bool = True) -> DataFrame:
    """Mean and maximum of the positive CPU and memory samples of each run; 0 without any."""

    def over(agg, c: str) -> Column:
        return F.coalesce(agg(F.when(F.col(c) > 0, F.col(c))), F.lit(0.0))

    usage = samples.groupBy(*by).agg(
        over(F.avg, "cpu_percent").alias("avg_cpu_percent"),
        over(F.max, "cpu_percent").alias("max_cpu_percent"),
        over(F.avg, "memory_mb").alias("avg_memory_mb"),
        over(F.max, "memory_mb").alias("max_memory_mb"),
    )
    return _rounded(usage, RUN_DIGITS) if rounded else usage


def run_summary(runs: DataFrame, rounded: bool = True) -> DataFrame:
    """One row per collector over its runs."""
    summary = runs.groupBy("scraper").agg(
        F.avg("execution_time_seconds").alias("avg_execution_time"),
        F.min("execution_time_seconds").alias("min_execution_time"),
        F.max("execution_time_seconds").alias("max_execution_time"),
        F.avg("avg_cpu_percent").alias("avg_cpu_across_runs"),
        F.avg("max_cpu_percent").alias("avg_max_cpu"),
        F.avg("avg_memory_mb").alias("avg_memory_across_runs"),
        F.avg("max_memory_mb").alias("avg_max_memory"),
    )
    return _rounded(summary, SUMMARY_DIGITS) if rounded else summary


def compare(summary: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """Figure by figure: difference, percent, improvement ratio and verdict.

    A figure that is 0 or missing on either side is left out.
    """
    names = [m for m, _ in METRICS]
    long = summary.select("scraper", *names).unpivot("scraper", names, "metric", "value")

    def side(name: str) -> Column:
        return F.max(F.when(F.col("scraper") == name, F.col("value")))

    title = F.create_map(*[F.lit(x) for pair in METRICS for x in pair])
    pairs = (
        long.groupBy("metric")
        .agg(side(baseline).alias("baseline"), side(candidate).alias("candidate"))
        .filter((F.col("baseline") != 0) & (F.col("candidate") != 0))
    )
    diff = F.col("candidate") - F.col("baseline")
    gain = F.col("baseline") / F.col("candidate")
    verdict = F.when(gain > 1, candidate).when(gain < 1, baseline).otherwise("equal")
    return pairs.select(
        "metric",
        title[F.col("metric")].alias("display_name"),
        "baseline",
        "candidate",
        diff.alias("difference"),
        (diff / F.col("baseline") * 100).alias("difference_percent"),
        gain.alias("improvement_ratio"),
        verdict.alias("better"),
    )


def tally(comparison: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """How many figures favour each side beyond the dead band, and the overall verdict."""
    gain = F.col("improvement_ratio")
    counts = comparison.agg(
        F.count_if(gain > BETTER).alias("candidate_advantages"),
        F.count_if(gain < WORSE).alias("baseline_advantages"),
        F.count_if(gain.between(WORSE, BETTER)).alias("comparable"),
    )
    c, b = F.col("candidate_advantages"), F.col("baseline_advantages")
    overall = F.when(c > b, candidate).when(b > c, baseline).otherwise("comparable")
    return counts.withColumn("overall", overall)
