"""Exact ranks without one task per group.

``running_index`` numbers the rows of each key in order. Rows are split by range
over (key, order), so a key holding a third of the table spans a third of the
partitions; only per-partition counts meet in one place.

``newest`` keeps the newest N rows of each key. It ranks in two steps, first
within a slice of the input partitions, so a hot key never meets in one task
before it has been cut to N rows per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.session import materialise

_PARTITION_SHIFT = 33  # layout of monotonically_increasing_id: partition above, row below


def running_index(
    df: DataFrame, keys: list[str], order: list[str], name: str = "rn", partitions: int | None = None
) -> DataFrame:
    """Add the 1-based position of each row within its key, ordered by ``order``.

    ``order`` must end in a unique column. The range-split rows are written to a
    table, because a second sampling of the range bounds could cut them
    elsewhere. So are the counts: their known size decides whether they are
    broadcast or joined by a shuffle.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in [*keys, *order]]
    numbered = (
        df.repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = materialise(numbered, "placed").withColumn("_part", F.shiftright("_at", _PARTITION_SHIFT))
    # at most one row per key and partition
    spans = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = (
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = spans.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    spans = spans.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"), "_first", "_before"
    )
    spans = materialise(spans, "spans")
    on = F.col("_part") == F.col("_p")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return placed.join(spans, on).select(
        *[F.col(c) for c in df.columns],
        (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name),
    )


def newest(df: DataFrame, keys: list[str], order: list[Column], n: int, slices: int = 256) -> DataFrame:
    """The first ``n`` rows of each key in ``order``, which must be total."""

    def cut(rows: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")

    sliced = df.withColumn("_slice", F.spark_partition_id() % slices)
    return cut(cut(sliced, [*keys, "_slice"]).drop("_slice"), keys)


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key in ``order``, with their rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
