"""Window statistics on a stream, equal to the batch operators on closed windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.config import StreamSpec, WindowSpec
from broadsheet.operators import windows as batch


def _flat(df: DataFrame, column: str = "w") -> DataFrame:
    return df.withColumns(
        {"window_start": F.col(f"{column}.start"), "window_end": F.col(f"{column}.end")}
    ).drop(column)


def stream_window_stats(articles: DataFrame, spec: WindowSpec, stream: StreamSpec = StreamSpec()) -> DataFrame:
    """One row per closed window, as ``window_stats``.

    Three aggregations follow each other: panes per source, windows per source,
    windows. State is kept per pane and source, not per article. ``ts`` must be
    a timestamp with zone; late rows beyond the watermark are not counted.
    """
    marked = articles.withWatermark("ts", stream.watermark)
    pane = F.window("ts", f"{spec.pane_s} seconds").alias("pane")
    panes = batch.lengths(marked).groupBy(pane, "source").agg(*batch.measures())
    sums = [F.sum(c).alias(c) for c in batch.SUMS]
    per_source = panes.groupBy(F.window("pane", spec.size, spec.slide).alias("w"), "source").agg(
        *sums, F.max("last_at").alias("last_at")
    )
    stats = _flat(per_source.groupBy("w").agg(*batch.stats_columns(spec)))
    rate = batch.rate_per_sec(F.col("total_articles"), F.col("window_start"), F.col("last_article_at"))
    return stats.withColumn("rate_per_sec", rate)


def stream_key_counts(
    articles: DataFrame, spec: WindowSpec, kinds: tuple[str, ...], stream: StreamSpec = StreamSpec(), panes: bool = False
) -> DataFrame:
    """Count per closed window, kind and key, as ``window_key_counts``.

    ``panes`` gives the counts per closed pane instead, as ``pane, kind, key, n``. State is then one row per pane and key,
    none per window that holds the pane; ``closed_key_counts`` sums the emitted panes into windows.
    """
    marked = articles.withWatermark("ts", stream.watermark)
    pane = F.window("ts", f"{spec.pane_s} seconds").alias("pane")
    rows = batch.key_rows(marked, kinds)
    if panes:
        # a single kind need not stand in the state
        by, kind = (["key"], F.lit(kinds[0]).alias("kind")) if len(kinds) == 1 else (["kind", "key"], F.col("kind"))
        counts = rows.groupBy(pane, *by).agg(F.count(F.lit(1)).alias("n"))
        return counts.select(F.col("pane.start").alias("pane"), kind, "key", "n")
    counts = rows.groupBy(pane, "kind", "key").agg(F.count(F.lit(1)).alias("n"))
    w = F.window("pane", spec.size, spec.slide).alias("w")
    return _flat(counts.groupBy(w, "kind", "key").agg(F.sum("n").alias("n")))


def closed_key_counts(panes: DataFrame, spec: WindowSpec, closed: str | None) -> DataFrame:
    """Counts of the closed windows from the panes that a stream emitted, as ``window_key_counts``."""
    counts = batch.with_end(batch.sum_windows(panes, spec, ["kind", "key"]), spec)
    counts = counts.select("window_start", "window_end", "kind", "key", "n")
    # a pane is emitted before all windows that hold it are closed
    return counts if closed is None else counts.filter(F.col("window_end") <= F.lit(closed).cast("timestamp"))


def stream_unique_links(articles: DataFrame, keep_for: str, key: str = "link", salts: int = 16) -> DataFrame:
    """One arrival of each link; a link is remembered for ``keep_for`` of event time.

    Copies are first dropped within salted groups, so the copies of one link
    meet in one task only after at most ``salts`` of them are left.
    """
    salted = articles.withWatermark("ts", keep_for).withColumn("_salt", F.pmod(F.xxhash64("ts"), F.lit(salts)))
    few = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return few.dropDuplicatesWithinWatermark([key])


def capped_closed_windows(closed: DataFrame, articles: DataFrame, spec: WindowSpec, tie: str = "link") -> DataFrame:
    """Capped statistics of closed windows, from the stored articles of their time range.

    For use on the batches of ``stream_window_stats``: a stream cannot rank, but
    a closed window gets no more rows.
    """
    lo = closed.agg(F.min("window_start")).scalar()
    hi = closed.agg(F.max("window_end")).scalar()
    rows = articles.filter((F.col("ts") >= lo) & (F.col("ts") < hi))
    return batch.capped_window_stats(rows, spec, tie).join(closed.select("window_start"), "window_start", "left_semi")


def write_table(df: DataFrame, path: str, checkpoint: str, stream: StreamSpec = StreamSpec()) -> StreamingQuery:
    """Append closed windows to a Parquet table, each exactly once."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**stream.trigger)
        .start()
    )


def closed_until(query: StreamingQuery, emitted: DataFrame, end: Column | str = "window_end") -> str | None:
    """The time up to which windows have been emitted: the watermark of the last batch.

    A run without new input has no watermark to tell, so the answer is never earlier than the latest
    ``end`` of the rows ``emitted`` so far; None means that nothing was emitted yet.
    """
    marks = [p.get("eventTime", {}).get("watermark") for p in query.recentProgress]
    stored = emitted.agg(F.date_format(F.max(end), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).first()[0]
    return max((m for m in (*marks, stored) if m), default=None)


def finalize(articles: DataFrame, spec: WindowSpec, closed: str | None) -> DataFrame:
    """Statistics of the windows a stopped stream still held open, from the stored articles.

    Only rows that can fall into such a window are read. Articles that the stream refused as late count here
    if their window was still open.
    """
    if closed is None:
        return batch.window_stats(articles, spec)
    until = F.lit(closed).cast("timestamp")
    tail = articles.filter(F.col("ts") >= until - F.expr(f"INTERVAL {spec.size}"))
    return batch.window_stats(tail, spec).filter(F.col("window_end") > until)


def finalize_key_counts(
    articles: DataFrame, spec: WindowSpec, kinds: tuple[str, ...], closed: str | None
) -> DataFrame:
    if closed is None:
        return batch.window_key_counts(articles, spec, kinds)
    until = F.lit(closed).cast("timestamp")
    tail = articles.filter(F.col("ts") >= until - F.expr(f"INTERVAL {spec.size}"))
    return batch.window_key_counts(tail, spec, kinds).filter(F.col("window_end") > until)


def aggregators(
    articles: DataFrame, specs: dict[str, WindowSpec], stream: StreamSpec | None = None
) -> dict[str, DataFrame]:
    """Several named aggregators over one input, batch or stream, each a frame of its own.

    Where one result with the aggregator's name in a column will do, ``roll_up`` of ``batch.lattice``, or of
    ``stream_lattice``, reads the input once.
    """
    if articles.isStreaming:
        return {name: stream_window_stats(articles, s, stream or StreamSpec()) for name, s in specs.items()}
    panes = batch.lattice(articles, specs)
    return {name: batch.roll_up(panes, {name: s}).drop("aggregator") for name, s in specs.items()}


def stream_lattice(articles: DataFrame, specs: dict[str, WindowSpec], stream: StreamSpec = StreamSpec()) -> DataFrame:
    """Measures per closed pane and source, of panes that all specs share, for ``roll_up``: one state for all."""
    marked = articles.withWatermark("ts", stream.watermark)
    pane = F.window("ts", f"{batch.lattice_s(specs.values())} seconds").alias("_pane")
    totals = batch.lengths(marked).groupBy(pane, "source").agg(*batch.measures())
    return totals.select(F.col("_pane.start").alias("pane"), "source", *batch.SUMS, "last_at")


def finalize_lattice(articles: DataFrame, specs: dict[str, WindowSpec], closed: str | None) -> DataFrame:
    """The panes that a stopped stream still held open, from the stored articles."""
    width = F.expr(f"INTERVAL {batch.lattice_s(specs.values())} SECONDS")
    if closed is None:
        return batch.lattice(articles, specs)
    until = F.lit(closed).cast("timestamp")
    return batch.lattice(articles.filter(F.col("ts") >= until - width), specs).filter(F.col("pane") + width > until)
