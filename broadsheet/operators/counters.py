"""Pipeline counters and cumulative histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket bounds for durations in seconds and for batch sizes.
DURATION_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
BATCH_SIZE_BUCKETS = [float(1 + 10 * k) for k in range(20)]


def histogram(df: DataFrame, value: str, bounds: list[float], by: list[str] | None = None) -> DataFrame:
    """Cumulative count of values up to each bound, the last bound being infinity.

    One aggregate with a counter per bound; the rows are read once and not multiplied.
    """
    x = F.col(value)
    counters = [
        F.struct(F.lit(b).alias("le"), F.count_if(x <= b).alias("n")) for b in bounds
    ] + [F.struct(F.lit(float("inf")).alias("le"), F.count(x).alias("n"))]
    wide = df.groupBy(*(by or [])).agg(F.array(*counters).alias("_b"))
    return wide.select(*(by or []), F.explode("_b").alias("_b")).select(*(by or []), "_b.le", "_b.n")


def stage_counters(df: DataFrame, accepted: Column) -> DataFrame:
    """Rows in, accepted and refused, as one row per batch."""
    return df.agg(
        F.count(F.lit(1)).alias("scraped"),
        F.count_if(accepted).alias("validated"),
        F.count_if(~accepted).alias("validation_errors"),
    )


def observed(df: DataFrame, name: str, accepted: Column | None = None) -> DataFrame:
    """Attach counters to a plan; they arrive with each batch's progress under ``name``."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if accepted is not None:
        metrics += [F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("refused")]
    return df.observe(name, *metrics)
