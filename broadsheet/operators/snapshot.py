"""Figures over a set of articles, such as the trailing window "now"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.config import WindowSpec
from broadsheet.functions.maths import ratio
from broadsheet.functions.text import or_empty
from broadsheet.operators.articles import trailing
from broadsheet.operators.windows import lengths
from broadsheet.session import materialise


def source_counts(articles: DataFrame) -> DataFrame:
    return articles.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def snapshot(articles: DataFrame, as_of: Column, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """One row over the trailing window; zeros when it is empty."""
    rows = lengths(trailing(articles, as_of, spec.size))
    per_source = rows.withColumn("source", or_empty(F.col("source"))).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce(f"title_{spec.length_unit}", F.lit(0))).alias("title"),
        F.sum(F.coalesce(f"desc_{spec.length_unit}", F.lit(0))).alias("description"),
    )
    n = F.coalesce(F.sum("n"), F.lit(0))
    return per_source.agg(
        n.alias("total_articles"),
        F.count(F.lit(1)).alias("sources_count"),
        ratio(F.sum("title"), n).alias("avg_title_length"),
        ratio(F.sum("description"), n).alias("avg_description_length"),
        (n / F.lit(spec.minutes)).alias("rate_per_min"),
    ).withColumns({"window_start": as_of - F.expr(f"INTERVAL {spec.size}"), "window_end": as_of})


def levels_of(size_s: int, base: int = 60) -> list[int]:
    """Widths of panes, widest first, each dividing the one before; the widest fits the window several times."""
    widths = [1]
    while widths[-1] * base * 4 <= size_s:
        widths.append(widths[-1] * base)
    return widths[::-1]


def _steps(first: Column, stop: Column, width: int) -> Column:
    """Starts of the panes between two of them."""
    none = F.array().cast("array<bigint>")
    return F.when(first < stop, F.sequence(first, stop - width, F.lit(width).cast("long"))).otherwise(none)


def snapshots(articles: DataFrame, instants: DataFrame, spec: WindowSpec = WindowSpec(), as_of: str = "as_of") -> DataFrame:
    """``snapshot`` at every instant of a table, from one pass over the articles.

    Their times, sources and lengths are written once and summed per source in panes of a second, a minute and so on. A trailing window is a
    few panes of each width, and the articles of the two seconds at its edges, so an instant costs as
    many rows as it has panes, whatever the number of articles. ``instants`` has one row per instant.
    """
    unit, us = spec.length_unit, 1_000_000
    narrow = lengths(articles).select(
        F.unix_micros("ts").alias("us"), or_empty(F.col("source")).alias("source"),
        F.coalesce(f"title_{unit}", F.lit(0)).alias("title"), F.coalesce(f"desc_{unit}", F.lit(0)).alias("description"),
    )
    narrow = materialise(narrow, "arrivals")  # read for the panes and for the edges
    sums = [F.sum(c).cast("long").alias(c) for c in ("n", "title", "description")]
    widths = levels_of(spec.size_s)
    seconds = narrow.groupBy(F.floor(F.col("us") / us).alias("at"), "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("title").alias("title"), F.sum("description").alias("description")
    )
    level = F.explode(F.array(*[F.struct(F.lit(w).alias("width"), (F.floor(F.col("at") / w) * w).alias("pane")) for w in widths]))
    panes = seconds.select(level.alias("_l"), "source", "n", "title", "description").groupBy("_l.width", "_l.pane", "source").agg(*sums)

    asked = instants.select(as_of).distinct().withColumn("_hi", F.unix_micros(as_of))
    asked = asked.withColumn("_lo", F.col("_hi") - F.lit(spec.size_s * us))
    parts, inner = [], None
    for w in widths:
        # whole panes of this width between the edges, but those that wider ones cover
        first, stop = (F.ceil(F.col("_lo") / (w * us)) * w).cast("long"), (F.floor(F.col("_hi") / (w * us)) * w).cast("long")
        starts = _steps(first, stop, w)
        if inner is not None:
            sides = F.concat(_steps(first, inner[0], w), _steps(inner[1], stop, w))
            starts = F.when(inner[0] < inner[1], sides).otherwise(starts)
        parts.append(F.transform(starts, lambda p: F.struct(F.lit(w).alias("width"), p.alias("pane"))))  # noqa: B023 (called at once)
        inner = first, stop
    whole = asked.select(as_of, F.inline(F.concat(*parts))).join(panes, ["width", "pane"]).drop("width", "pane")
    # the edges: seconds that the window covers in part; its end belongs to it
    edges = F.array_distinct(F.array(F.floor(F.col("_lo") / us), F.floor(F.col("_hi") / us)))
    edge = asked.withColumn("at", F.explode(edges)).filter(
        (F.col("at") * us < F.col("_lo")) | (F.col("at") >= inner[1])
    )
    raw = edge.join(narrow.withColumn("at", F.floor(F.col("us") / us)), "at").filter(F.col("us").between(F.col("_lo"), F.col("_hi")))
    raw = raw.select(as_of, "source", F.lit(1).cast("long").alias("n"), "title", "description")
    per_source = whole.unionByName(raw).groupBy(as_of, "source").agg(*sums)
    totals = per_source.groupBy(as_of).agg(F.count(F.lit(1)).alias("sources_count"), *sums)
    n = F.coalesce(F.col("n"), F.lit(0).cast("long"))
    return asked.select(as_of).join(totals, as_of, "left").select(
        n.alias("total_articles"),
        F.coalesce("sources_count", F.lit(0).cast("long")).alias("sources_count"),
        ratio(F.col("title"), n).alias("avg_title_length"),
        ratio(F.col("description"), n).alias("avg_description_length"),
        (n / F.lit(spec.minutes)).alias("rate_per_min"),
        (F.col(as_of) - F.expr(f"INTERVAL {spec.size}")).alias("window_start"),
        F.col(as_of).alias("window_end"),
    )


def source_distribution(articles: DataFrame) -> DataFrame:
    """Sources by falling count; equal counts order by name."""
    return source_counts(articles).orderBy(F.desc("n"), F.asc("source"))


def top_source(articles: DataFrame) -> DataFrame:
    """Number of sources and the source with the most articles."""
    lead = F.min(F.struct((-F.col("n")).alias("n"), "source"))
    totals = source_counts(articles).agg(F.count(F.lit(1)).alias("total_sources"), lead.alias("_lead"))
    return totals.select(
        "total_sources", F.col("_lead.source").alias("top_source"), (-F.col("_lead.n")).alias("top_count")
    )


def top_sources_other(articles: DataFrame, k: int = 8) -> DataFrame:
    """The ``k`` largest sources and one ``Other`` row for the rest.

    The other side of the join is ``k`` rows, which is why it may be broadcast.
    """
    counts = source_counts(articles)
    leaders = (
        counts.orderBy(F.desc("n"), F.asc("source")).limit(k).select("source", F.lit(True).alias("_top"))
    )
    label = F.when(F.col("_top"), F.col("source")).otherwise("Other")
    return (
        counts.join(F.broadcast(leaders), "source", "left")
        .groupBy(F.coalesce(F.col("_top"), F.lit(False)).alias("is_top"), label.alias("source"))
        .agg(F.sum("n").alias("n"))
        .select("source", "n", (~F.col("is_top")).alias("is_other"))
    )
