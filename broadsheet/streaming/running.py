"""Running window statistics: every micro-batch tells how the windows it touched stand, before they close.

``stream_pane_updates`` is an update-mode aggregation: per batch, the totals so far of every
pane and source that got rows. The sink keeps them under the number of their batch, so a
retried batch replaces itself, and a window is read as of any batch: its last version
equals the closed window, the earlier ones are what a live view showed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.config import StreamSpec, WindowSpec
from broadsheet.operators import windows as batch
from broadsheet.streaming import sinks

VERSION = "batch_id"


def stream_pane_updates(articles: DataFrame, spec: WindowSpec, stream: StreamSpec = StreamSpec()) -> DataFrame:
    """Totals so far per pane and source, for output mode ``update``."""
    marked = articles.withWatermark("ts", stream.watermark)
    pane = F.window("ts", f"{spec.pane_s} seconds").alias("_pane")
    totals = batch.lengths(marked).groupBy(pane, "source").agg(*batch.measures())
    return totals.select(F.col("_pane.start").alias("pane"), "source", *batch.SUMS, "last_at")


def write_updates(updates: DataFrame, path: str, checkpoint: str, stream: StreamSpec = StreamSpec()) -> StreamingQuery:
    """Keep the updates of each batch under its number."""
    return sinks.start(updates, sinks.parquet_sink(path), checkpoint, stream, mode="update")


def read_updates(spark: SparkSession, path: str, updates: DataFrame) -> DataFrame:
    """All updates written so far, with the number of their batch."""
    return spark.read.schema(updates.schema.simpleString()[7:-1].replace(":", " ") + f", {VERSION} long").parquet(path)


def latest(updates: DataFrame, as_of: int | None = None) -> DataFrame:
    """The newest totals of each pane and source, up to a batch."""
    rows = updates if as_of is None else updates.filter(F.col(VERSION) <= as_of)
    last = F.max_by(F.struct(*batch.SUMS, "last_at"), VERSION).alias("_t")
    return rows.groupBy("pane", "source").agg(last).select("pane", "source", "_t.*")


def running_stats(updates: DataFrame, spec: WindowSpec, as_of: int | None = None) -> DataFrame:
    """Statistics of all windows as they stood after a batch, or stand now."""
    windows = batch.to_windows(latest(updates, as_of), spec)
    sums = [F.sum(c).alias(c) for c in batch.SUMS]
    per_source = windows.groupBy("window_start", "source").agg(*sums, F.max("last_at").alias("last_at"))
    return batch.with_end(per_source.groupBy("window_start").agg(*batch.stats_columns(spec)), spec)


def window_versions(updates: DataFrame, spec: WindowSpec) -> DataFrame:
    """Every version of every window: ``version`` from 1, and whether it is the ``latest``.

    Totals become differences per batch, which are small once summed per window; a window's
    versions are their running sums, in order of the batches.
    """
    by_source = Window.partitionBy("pane", "source").orderBy(VERSION)
    steps = {c: F.col(c) - F.coalesce(F.lag(c).over(by_source), F.lit(0)) for c in batch.SUMS}
    changes = updates.select("pane", "source", VERSION, "last_at", *[v.alias(c) for c, v in steps.items()])
    sums = [F.sum(c).alias(c) for c in batch.SUMS]
    per_source = batch.to_windows(changes, spec).groupBy("window_start", "source", VERSION).agg(
        *sums, F.max("last_at").alias("last_at")
    )
    first = F.row_number().over(Window.partitionBy("window_start", "source").orderBy(VERSION)) == 1
    per_batch = per_source.withColumn("_new", first.cast("long")).groupBy("window_start", VERSION).agg(
        *sums, F.sum("_new").alias("_new"), F.max("last_at").alias("last_at")
    )
    order = Window.partitionBy("window_start").orderBy(VERSION)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    unit, n = spec.length_unit, F.sum("n").over(so_far)
    rows = per_batch.select(
        "window_start",
        F.row_number().over(order).alias("version"),
        VERSION,
        n.alias("total_articles"),
        F.sum("_new").over(so_far).alias("sources_count"),
        (F.sum(f"title_{unit}").over(so_far) / n).alias("avg_title_length"),
        (F.sum(f"desc_{unit}").over(so_far) / n).alias("avg_description_length"),
        (n / F.lit(spec.minutes)).alias("rate_per_min"),
        F.max("last_at").over(so_far).alias("last_article_at"),
        F.lead(VERSION).over(order).isNull().alias("latest"),
    )
    return batch.with_end(rows, spec)
