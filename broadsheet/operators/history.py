"""Views over the table of stored windows (one row per window)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.maths import pct_change, trend_class

WINDOWS_PER_HOUR = 12
HISTORY_HOURS = (1, 6, 12, 24, 48)


def history_slice(stats: DataFrame, as_of: Column, hours: int = 24, limit: int = 100) -> DataFrame:
    """The newest windows of the last ``hours``, at most ``limit`` and at most twelve per hour."""
    since = as_of - F.expr(f"INTERVAL {hours} HOURS")
    rows = stats.filter(F.col("window_start") >= since)
    return rows.orderBy(F.desc("window_start")).limit(min(limit, hours * WINDOWS_PER_HOUR))


def last_windows(stats: DataFrame, n: int = 100) -> DataFrame:
    return stats.orderBy(F.desc("window_start")).limit(n)


def list_windows(stats: DataFrame) -> DataFrame:
    return stats.select("window_start", "window_end", F.col("total_articles").alias("article_count"))


def number_windows(stats: DataFrame, name: str = "rn") -> DataFrame:
    """Add the 1-based position of each window in time, and the number of windows.

    Windows lie on a fixed grid, so a day holds a bounded number of them: rows
    are ranked within their day, and only one count per day is summed in order.
    """
    day = F.floor(F.unix_seconds("window_start") / 86_400)
    rows = stats.withColumn("_day", day)
    per_day = rows.groupBy("_day").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_day = per_day.select(
        "_day",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("n_windows"),
    )
    in_day = F.row_number().over(Window.partitionBy("_day").orderBy("window_start"))
    return (
        rows.join(per_day, "_day")
        .withColumn(name, F.col("_before") + in_day)
        .drop("_day", "_before")
    )


def moving_average(stats: DataFrame, value: str = "total_articles", frame: int = 5, block: int = 4096) -> DataFrame:
    """Centred mean over ``frame`` windows; NULL where the frame is not full.

    Nothing is drawn for a history of ``frame`` windows or fewer. Rows are cut
    into blocks of consecutive windows, each with copies of the rows just
    outside its edges, so blocks are averaged in parallel.
    """
    half = frame // 2
    numbered = number_windows(stats.select("window_start", value))
    home = F.floor((F.col("rn") - 1) / block)
    reach = F.array_distinct(
        F.array(
            home,
            F.greatest(F.floor((F.col("rn") - 1 - half) / block), F.lit(0).cast("long")),
            F.floor((F.col("rn") - 1 + half) / block),
        )
    )
    spread = numbered.withColumn("_home", home).withColumn("_block", F.explode(reach))
    w = Window.partitionBy("_block").orderBy("rn").rowsBetween(-half, frame - 1 - half)
    full = (F.count(F.lit(1)).over(w) == frame) & (F.col("n_windows") > frame)
    return (
        spread.withColumn("moving_avg", F.when(full, F.avg(value).over(w)))
        .filter("_block = _home")
        .select("window_start", value, "moving_avg")
    )


def rate_reference(stats: DataFrame, value: str = "rate_per_min") -> DataFrame:
    """Each window's rate beside the mean rate of the whole history."""
    mean = stats.agg(F.avg(value)).scalar()
    return stats.select("window_start", value, mean.alias("mean_rate"))


def trend(stats: DataFrame, value: str = "total_articles", recent: int = 6) -> DataFrame:
    """Mean of the newest windows against those before them, as percent and class.

    Reads at most ``2 * recent`` rows after the top-k step; no row below two windows.
    """
    newest = stats.select("window_start", value).orderBy(F.desc("window_start")).limit(2 * recent)
    ranked = newest.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("window_start"))))
    means = ranked.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("rn") <= recent, F.col(value))).alias("recent_avg"),
        F.avg(F.when(F.col("rn") > recent, F.col(value))).alias("older_avg"),
    ).filter("n >= 2")
    means = means.withColumn("older_avg", F.coalesce("older_avg", "recent_avg"))
    change = pct_change(F.col("recent_avg"), F.col("older_avg"))
    return means.select(
        trend_class(change).alias("trend"), F.abs(change).alias("trend_pct"), "recent_avg", "older_avg"
    )


def heatmap(stats: DataFrame, value: str = "total_articles", min_windows: int = 24) -> DataFrame:
    """Sum by date and hour of day, one row per cell; empty for a short history."""
    cells = stats.groupBy(
        F.to_date("window_start").alias("day"), F.hour("window_start").alias("hour")
    ).agg(F.sum(value).alias("articles"), F.count(F.lit(1)).alias("_n"))
    # the calendar bounds the cells: 24 rows a day
    total = F.sum("_n").over(Window.partitionBy())
    return cells.withColumn("_total", total).filter(F.col("_total") >= min_windows).drop("_n", "_total")


def heatmap_grid(cells: DataFrame, days: list[str]) -> DataFrame:
    """Cells as an hour by date grid for the given dates."""
    label = F.format_string("%02d:00", F.col("hour"))
    dated = cells.withColumn("day", F.col("day").cast("string"))
    return dated.groupBy(label.alias("hour")).pivot("day", days).agg(F.sum("articles"))
