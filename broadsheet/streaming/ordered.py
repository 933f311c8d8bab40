"""Streams whose state holds articles for a while: count windows in event order, the newest articles of a pane.

Both keep rows in list state until the watermark has passed them, and act on event-time
timers. ``ordered_count_windows`` releases its rows in the order of (time, tie), so its
windows do not depend on the order of arrival; it holds what arrives within the watermark
delay. ``newest_per_pane`` never holds more than the cap per pane and shard, and counts
what it evicts.

Keys are shared out by a shard column (``with_shards``, or the broker partition), so that
a source or a pane with a third of all rows has its state in several tasks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from broadsheet.config import StreamSpec, WindowSpec
from broadsheet.operators import windows as batch
from broadsheet.operators.ranking import newest, top_k

SHARD = "shard"
_COUNTED = (
    "window_no long, total_articles long, avg_title_length double, avg_description_length double, "
    "first_article_at timestamp, last_article_at timestamp, closed boolean"
)
_KEPT = "arrived long, evicted long, us long, tie string, article_source string, " + ", ".join(f"{c} long" for c in batch.SUMS[1:])


def with_shards(articles: DataFrame, n: int, by: str = "link") -> DataFrame:
    """Add the shard of each article, from a hash of a column with many values."""
    return articles.withColumn(SHARD, F.pmod(F.xxhash64(by), F.lit(n)).cast("int"))


def _types(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)


class _Timed(StatefulProcessor):
    """Keeps one event-time timer per key, at the earliest time asked for."""

    def init(self, handle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "ms long")

    def wake(self, ms: int) -> None:
        held = self.timer.get()
        if held is not None:
            if held[0] <= ms:
                return
            self.handle.deleteTimer(held[0])
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def close(self) -> None:
        pass


class _OrderedCounts(_Timed):
    def __init__(self, size: int, columns: list[str]):
        self.size, self.columns = size, columns

    def init(self, handle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", "us long, tie string, title long, description long")
        self.open = handle.getValueState("open", "number long, n long, title long, description long, first long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = math.inf
        for part in rows:
            first = min(first, int(part["us"].min()))
            self.waiting.appendList(list(part[["us", "tie", "title", "description"]].itertuples(index=False, name=None)))
        if first < math.inf:
            self.wake(-(-first // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        rows = sorted(tuple(r) for r in self.waiting.get())
        later = [r for r in rows if r[0] > until]
        number, n, title, description, first, last = self.open.get() or (0, 0, 0, 0, 0, 0)
        out = []
        for us, _, t, d in rows[: len(rows) - len(later)]:
            first = us if n == 0 else first
            n, title, description, last = n + 1, title + t, description + d, us
            if n == self.size:
                when = [pd.Timestamp(x, unit="us") for x in (first, last)]
                out.append((*key, number, n, title / n, description / n, *when, True))
                number, n, title, description = number + 1, 0, 0, 0
        self.open.update((number, n, title, description, first, last))
        if later:
            self.waiting.put(later)
            self.wake(-(-later[0][0] // 1000))
        else:
            self.waiting.clear()
        if out:
            yield pd.DataFrame(out, columns=self.columns)


def ordered_count_windows(
    articles: DataFrame, size: int, keys: list[str], tie: str = "link", length_unit: str = "bytes", stream: StreamSpec = StreamSpec()
) -> DataFrame:
    """A row for every ``size`` articles of a key in the order of (time, tie), as ``windows.count_windows``.

    ``tie`` orders articles of one time and should be unique; numbers are compared as numbers. Windows
    appear once the watermark has passed their last article. Late articles are not counted.
    """
    unit = length_unit
    marked = articles.withWatermark("ts", stream.watermark)
    rows = batch.lengths(marked, *keys, tie).select(
        *keys, "ts", F.unix_micros("ts").alias("us"), _sortable(articles, tie).alias("tie"),
        F.coalesce(f"title_{unit}", F.lit(0)).cast("long").alias("title"),
        F.coalesce(f"desc_{unit}", F.lit(0)).cast("long").alias("description"),
    )
    columns = [*keys, *(c.split()[0] for c in _COUNTED.split(", "))]
    return rows.groupBy(*keys).transformWithStateInPandas(
        _OrderedCounts(size, columns), f"{_types(rows, keys)}, {_COUNTED}", "append", "EventTime"
    )


def _sortable(articles: DataFrame, tie: str) -> Column:
    """A text that sorts as the tie column does; whole numbers keep their order."""
    kind = dict(articles.dtypes)[tie]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        # sign first, then digits of equal width
        shifted = F.col(tie).cast("decimal(38,0)") + F.lit(str(2**63)).cast("decimal(38,0)")
        return F.lpad(F.coalesce(shifted.cast("string"), F.lit("")), 20, "0")
    return F.coalesce(F.col(tie).cast("string"), F.lit(""))


def open_count_windows(
    articles: DataFrame, closed: DataFrame, size: int, keys: list[str], tie: str = "link", length_unit: str = "bytes"
) -> DataFrame:
    """The windows a stopped stream had not emitted, from the stored articles; the last of a key may be unfilled."""
    rows = batch.count_windows(articles, size, keys, tie, length_unit)
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*keys, "window_no")]
    return rows.alias("r").join(closed.select(*keys, "window_no").alias("c"), on, "left_anti")


class _Newest(_Timed):
    def __init__(self, cap: int, pane_us: int, columns: list[str]):
        self.cap, self.pane_us, self.columns = cap, pane_us, columns
        self.fields = ["us", "tie", "article_source", *batch.SUMS[1:]]

    def init(self, handle) -> None:
        super().init(handle)
        kinds = "us long, tie string, article_source string, " + ", ".join(f"{c} long" for c in batch.SUMS[1:])
        self.kept = handle.getListState("kept", kinds)
        self.arrived = handle.getValueState("arrived", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept, seen = list(map(tuple, self.kept.get())), 0
        order = lambda r: (r[0], r[1])
        for part in rows:
            seen += len(part)
            both = kept + list(part[self.fields].itertuples(index=False, name=None))
            kept = heapq.nlargest(self.cap, both, key=order)
        if seen:
            self.kept.put(kept)
            self.arrived.update(((self.arrived.get() or (0,))[0] + seen,))
            self.wake((key[0] + self.pane_us) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        kept, arrived = list(map(tuple, self.kept.get())), self.arrived.get()[0]
        for state in (self.kept, self.arrived, self.timer):
            state.clear()
        yield pd.DataFrame([(*key, arrived, arrived - len(kept), *r) for r in kept], columns=self.columns)


def _pane(spec: WindowSpec) -> Column:
    return F.window("ts", f"{spec.pane_s} seconds").start


def newest_per_pane(articles: DataFrame, spec: WindowSpec, tie: str = "link", stream: StreamSpec = StreamSpec()) -> DataFrame:
    """The newest ``max_articles`` articles of each closed pane and shard, with how many arrived and were evicted.

    Rows of ``pane, shard, arrived, evicted, ts, tie, source`` and lengths, for ``windows_of_newest``. Articles
    without a shard column are one shard.
    """
    if SHARD not in articles.columns:
        articles = articles.withColumn(SHARD, F.lit(0))
    marked = articles.withWatermark("ts", stream.watermark)
    rows = batch.lengths(marked, SHARD, tie).select(
        F.unix_micros(_pane(spec)).alias("pane_us"), F.col(SHARD).cast("int").alias(SHARD), "ts", F.unix_micros("ts").alias("us"),
        _sortable(articles, tie).alias("tie"), F.col("source").alias("article_source"),
        *[F.col(c).cast("long").alias(c) for c in batch.SUMS[1:]],
    )
    columns = ["pane_us", SHARD, *(c.split()[0] for c in _KEPT.split(", "))]
    kept = rows.groupBy("pane_us", SHARD).transformWithStateInPandas(
        _Newest(spec.max_articles, spec.pane_s * 1_000_000, columns), f"pane_us long, {SHARD} int, {_KEPT}", "append", "EventTime"
    )
    return _panes(kept)


def _panes(kept: DataFrame) -> DataFrame:
    return kept.select(
        F.timestamp_micros("pane_us").alias("pane"), SHARD, "arrived", "evicted", F.timestamp_micros("us").alias("ts"), "tie",
        F.col("article_source").alias("source"), *batch.SUMS[1:],
    )


def stored_newest_per_pane(articles: DataFrame, spec: WindowSpec, since: str | None, tie: str = "link") -> DataFrame:
    """The same rows for the panes that a stopped stream still held open, from the stored articles."""
    rows = batch.lengths(articles, tie).select(_pane(spec).alias("pane"), "ts", _sortable(articles, tie).alias("tie"), "source", *batch.SUMS[1:])
    if since is not None:
        end = F.col("pane") + F.expr(f"INTERVAL {spec.pane_s} SECONDS")
        rows = rows.filter(end > F.lit(since).cast("timestamp"))
    cut = newest(rows, ["pane"], [F.desc("ts"), F.desc("tie")], spec.max_articles)
    counted = rows.groupBy("pane").agg(F.count(F.lit(1)).alias("arrived"))
    kept = cut.join(counted, "pane")
    n = F.least(F.col("arrived"), F.lit(spec.max_articles).cast("long"))
    return kept.select(
        "pane", F.lit(0).alias(SHARD), "arrived", (F.col("arrived") - n).alias("evicted"), "ts", "tie", "source", *batch.SUMS[1:]
    )


def windows_of_newest(kept: DataFrame, spec: WindowSpec) -> DataFrame:
    """Capped statistics per window, with articles arrived, kept and dropped, from the newest of its panes.

    At most the cap per pane and shard is multiplied into the windows.
    """
    counts = kept.select("pane", SHARD, "arrived").distinct().groupBy("pane").agg(F.sum("arrived").alias("arrived"))
    arrived = batch.to_windows(counts, spec).groupBy("window_start").agg(F.sum("arrived").alias("arrived"))
    cut = top_k(
        batch.to_windows(kept.drop(SHARD, "arrived", "evicted"), spec), ["window_start"], [F.desc("ts"), F.desc("tie")], spec.max_articles
    )
    stats = cut.groupBy("window_start", "source").agg(*batch.measures()).groupBy("window_start").agg(
        *batch.stats_columns(spec)
    )
    joined = stats.join(arrived, "window_start").withColumns(
        {"kept": F.col("total_articles"), "dropped": F.col("arrived") - F.col("total_articles")}
    )
    return batch.with_end(joined.drop("total_articles"), spec)
