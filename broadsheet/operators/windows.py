"""Window statistics from one pass over the articles.

Every statistic is a sum or an extremum, so articles are first counted per
*pane*, the widest interval that divides both window size and slide. A sliding
window is a union of panes: only the small pane counts are multiplied into
overlapping windows, never the articles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.config import WindowSpec
from broadsheet.functions.maths import round_half_even
from broadsheet.functions.text import keywords, text_length
from broadsheet.operators.ranking import newest, running_index, top_k

SUMS = ("n", "title_chars", "title_bytes", "desc_chars", "desc_bytes")


def _count() -> Column:
    return F.count(F.lit(1))


def with_lengths(texts: DataFrame) -> DataFrame:
    """Add the lengths of ``title`` and ``description``; taken before a join, they spare it the texts."""
    return texts.select(
        "*",
        text_length(F.col("title"), "chars").alias("title_chars"),
        text_length(F.col("title"), "bytes").alias("title_bytes"),
        text_length(F.col("description"), "chars").alias("desc_chars"),
        text_length(F.col("description"), "bytes").alias("desc_bytes"),
    )


def lengths(articles: DataFrame, *keep: str) -> DataFrame:
    """Text lengths in place of the texts, so that no text is shuffled. Lengths that are there are taken as they are."""
    if not set(SUMS[1:]) <= set(articles.columns):
        articles = with_lengths(articles)
    return articles.select(*dict.fromkeys((*keep, "ts", "source")), *SUMS[1:])


def measures() -> list[Column]:
    """Aggregates over rows of ``lengths``."""
    return [_count().alias("n"), *[F.sum(c).alias(c) for c in SUMS[1:]], F.max("ts").alias("last_at")]


def _keys_of(kind: str, columns: list[str]) -> Column:
    """The keys one article contributes to a breakdown, as an array. Keywords that are there are taken as they are."""
    return {
        "source": F.array_compact(F.array(F.col("source"))),
        "source_type": F.array_compact(F.array(F.col("source_type"))),
        "category": F.filter("categories", lambda c: c.isNotNull()),
        "keyword": F.col("title_keywords") if "title_keywords" in columns else keywords(F.col("title")),
    }[kind]


def key_rows(articles: DataFrame, kinds: tuple[str, ...], *keep: Column | str) -> DataFrame:
    """One row per article and key of each kind: ``ts`` or what else is to be kept, then ``kind, key``."""
    keep = keep or ("ts",)
    names = articles.select(*keep).columns
    if len(kinds) == 1:
        kind = kinds[0]
        if kind in ("source", "source_type"):
            return articles.filter(F.col(kind).isNotNull()).select(*keep, F.lit(kind).alias("kind"), F.col(kind).alias("key"))
        return articles.select(*keep, F.lit(kind).alias("kind"), F.explode(_keys_of(kind, articles.columns)).alias("key"))
    # the place of a key in the joined lists tells its kind
    lists = articles.select(*keep, *[_keys_of(k, articles.columns).alias(f"_l{i}") for i, k in enumerate(kinds)])
    ends, kind = F.lit(0), F.lit(kinds[-1])
    bounds = []
    for i in range(len(kinds) - 1):
        ends = ends + F.size(f"_l{i}")
        bounds.append(ends.alias(f"_e{i}"))
    placed = lists.select(*names, *bounds, F.posexplode(F.concat(*[F.col(f"_l{i}") for i in range(len(kinds))])).alias("_at", "key"))
    for i in reversed(range(len(kinds) - 1)):
        kind = F.when(F.col("_at") < F.col(f"_e{i}"), F.lit(kinds[i])).otherwise(kind)
    return placed.select(*names, kind.alias("kind"), "key")


def pane_totals(articles: DataFrame, spec: WindowSpec) -> DataFrame:
    """Count, length sums and last arrival per pane and source."""
    pane = F.window("ts", f"{spec.pane_s} seconds").start
    return lengths(articles).groupBy(pane.alias("pane"), "source").agg(*measures())


def pane_keys(articles: DataFrame, spec: WindowSpec, kinds: tuple[str, ...]) -> DataFrame:
    """Count per pane, kind and key."""
    # the pane is taken per article, not per key
    pane = F.window("ts", f"{spec.pane_s} seconds").start.alias("pane")
    rows = key_rows(articles, kinds, pane)
    by = ["pane", "kind", "key"] if len(kinds) > 1 else ["pane", "key"]
    return rows.groupBy(*by).agg(_count().alias("n"))


def to_windows(panes: DataFrame, spec: WindowSpec) -> DataFrame:
    """Assign each pane row to every window that contains it, named by its start."""
    if spec.size_s == spec.pane_s:
        return panes.withColumnRenamed("pane", "window_start")
    start = F.window("pane", spec.size, spec.slide).alias("_w")
    return panes.select("*", start).withColumn("window_start", F.col("_w.start")).drop("_w", "pane")


def with_end(df: DataFrame, spec: WindowSpec) -> DataFrame:
    """Add the end of each window. It follows from the start, so it is never a grouping key."""
    end = (F.col("window_start") + F.expr(f"INTERVAL {spec.size_s} SECONDS")).alias("window_end")
    rest = [c for c in df.columns if c != "window_start"]
    return df.select("window_start", end, *rest)


def sum_windows(panes: DataFrame, spec: WindowSpec, by: list[str]) -> DataFrame:
    """Sum of ``n`` per window and key from the counts per pane and key: ``window_start``, ``by``, ``n``.

    The panes are dealt out by key and multiplied into windows within a task, so the shuffle carries each pane once.
    There are as many more partitions as a pane has windows, so that a task sums no more rows than one of a shuffle.
    """
    if spec.size_s == spec.pane_s:
        return panes.select(F.col("pane").alias("window_start"), *by, "n")
    tasks = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions")) * -(-spec.size_s // spec.slide_s)
    dealt = panes.repartition(tasks, *by).select(F.explode(_starts(spec)).alias("_s"), *by, "n")
    sums = dealt.groupBy("_s", *by).agg(F.sum("n").alias("n"))
    return sums.select(F.timestamp_seconds("_s").alias("window_start"), *by, "n")


def window_key_counts(articles: DataFrame, spec: WindowSpec, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Count per window, kind and key: sources, source types, categories, keywords."""
    kinds = kinds or spec.kinds
    by = ["key"] if len(kinds) == 1 else ["kind", "key"]
    counts = sum_windows(pane_keys(articles, spec, kinds), spec, by)
    if len(kinds) == 1:
        counts = counts.withColumn("kind", F.lit(kinds[0]))
    return with_end(counts, spec).select("window_start", "window_end", "kind", "key", "n")


def window_source_totals(articles: DataFrame, spec: WindowSpec) -> DataFrame:
    """Measures per window and source."""
    windows = to_windows(pane_totals(articles, spec), spec)
    if spec.size_s == spec.pane_s:
        return windows
    return windows.groupBy("window_start", "source").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("last_at").alias("last_at")
    )


def stats_columns(spec: WindowSpec) -> list[Column]:
    """Window statistics of rows grouped per source."""
    unit = spec.length_unit
    n = F.sum("n")
    return [
        n.alias("total_articles"),
        _count().alias("sources_count"),
        (F.sum(f"title_{unit}") / n).alias("avg_title_length"),
        (F.sum(f"desc_{unit}") / n).alias("avg_description_length"),
        (n / F.lit(spec.minutes)).alias("rate_per_min"),
        F.max("last_at").alias("last_article_at"),
    ]


def rate_per_sec(n: Column, start: Column, last: Column) -> Column:
    """Rows per second up to the last arrival; 0 when no time has passed."""
    seconds = (F.unix_micros(last) - F.unix_micros(start)) / F.lit(1_000_000.0)
    return F.coalesce(F.try_divide(n.cast("double"), seconds), F.lit(0.0))


def window_stats(articles: DataFrame, spec: WindowSpec) -> DataFrame:
    """One row per non-empty window: volume, sources, mean lengths, rates, last arrival."""
    stats = window_source_totals(articles, spec).groupBy("window_start").agg(*stats_columns(spec))
    rate = rate_per_sec(F.col("total_articles"), F.col("window_start"), F.col("last_article_at"))
    return with_end(stats, spec).withColumn("rate_per_sec", rate)


def lattice_s(specs: Iterable[WindowSpec]) -> int:
    """Width of the panes that every window of every spec is a union of."""
    return gcd(*[s.pane_s for s in specs])


def lattice(articles: DataFrame, specs: dict[str, WindowSpec]) -> DataFrame:
    """Measures per pane and source, of panes that all specs share."""
    pane = F.window("ts", f"{lattice_s(specs.values())} seconds").start
    return lengths(articles).groupBy(pane.alias("pane"), "source").agg(*measures())


def _starts(spec: WindowSpec) -> Column:
    """Starts of the windows that hold a pane, in epoch seconds."""
    at, size, slide = F.unix_seconds("pane"), F.lit(spec.size_s).cast("long"), F.lit(spec.slide_s).cast("long")
    last = at - F.pmod(at, slide)
    first = at - size - F.pmod(at - size, slide) + slide
    return F.sequence(first, last, slide)


def roll_up(panes: DataFrame, specs: dict[str, WindowSpec]) -> DataFrame:
    """Statistics of every named aggregator from panes they share: ``aggregator``, and the columns of ``window_stats``.

    The panes are read once; a pane and source becomes one row per window of every spec that holds it.
    """
    def entries(name: str, spec: WindowSpec) -> Column:
        return F.transform(_starts(spec), lambda s: F.struct(F.lit(name).alias("aggregator"), s.alias("s")))

    named = [entries(name, s) for name, s in specs.items()]
    spread = panes.select("*", F.inline(F.concat(*named))).drop("pane")
    per_source = spread.groupBy("aggregator", "s", "source").agg(*[F.sum(c).alias(c) for c in SUMS], F.max("last_at").alias("last_at"))

    def by_name(value: Callable[[WindowSpec], Column]) -> Column:
        out = F.lit(None)
        for name, s in specs.items():
            out = F.when(F.col("aggregator") == name, value(s)).otherwise(out)
        return out

    n = F.sum("n")
    stats = per_source.groupBy("aggregator", "s").agg(
        n.alias("total_articles"),
        _count().alias("sources_count"),
        *[
            (F.sum(by_name(lambda s: F.col(f"{part}_{s.length_unit}"))) / n).alias(name)  # noqa: B023 (called at once)
            for part, name in (("title", "avg_title_length"), ("desc", "avg_description_length"))
        ],
        F.max("last_at").alias("last_article_at"),
    )
    start = F.timestamp_seconds("s").alias("window_start")
    end = F.timestamp_seconds(F.col("s") + by_name(lambda s: F.lit(s.size_s))).alias("window_end")
    rate = (F.col("total_articles") / by_name(lambda s: F.lit(s.minutes))).alias("rate_per_min")
    stats = stats.select("aggregator", start, end, *stats.columns[2:6], rate, "last_article_at")
    return stats.withColumn("rate_per_sec", rate_per_sec(F.col("total_articles"), F.col("window_start"), F.col("last_article_at")))


def window_leaders(articles: DataFrame, spec: WindowSpec) -> DataFrame:
    """Window statistics with the leading source of each window; equal counts go to the first name.

    The leader is a minimum over the per-source rows the statistics are made of,
    so it costs no further pass or shuffle.
    """
    lead = F.min(F.struct((-F.col("n")).alias("n"), "source")).alias("_lead")
    stats = window_source_totals(articles, spec).groupBy("window_start").agg(*stats_columns(spec), lead)
    stats = stats.select(
        "*", F.col("_lead.source").alias("top_source"), (-F.col("_lead.n")).alias("top_count")
    ).drop("_lead")
    return with_end(stats, spec)


def top_keywords(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent keywords of each window; equal counts order by word."""
    words = counts.filter("kind = 'keyword'").select(
        "window_start", "window_end", F.col("key").alias("word"), F.col("n").alias("frequency")
    )
    return top_k(words, ["window_start"], [F.desc("frequency"), F.asc("word")], k)


def _pairs(kind: str) -> Column:
    """Map of key to count for one kind within a group of ``kind, key, n`` rows."""
    entry = F.when(F.col("kind") == kind, F.struct(F.col("key"), F.col("n")))
    return F.map_from_entries(F.array_sort(F.collect_list(entry)))


def window_view(articles: DataFrame, spec: WindowSpec, rounded: bool = True) -> DataFrame:
    """Window rows with nested breakdowns: the shape stored and served.

    Keywords are cut to the top ``k`` before they are nested.
    """
    kinds = tuple(dict.fromkeys(("source", *spec.kinds)))
    counts = window_key_counts(articles, spec, kinds)
    nested = counts.filter("kind <> 'keyword'").select(
        "window_start", "kind", "key", "n", F.lit(0).alias("rank")
    )
    if "keyword" in kinds:
        best = top_keywords(counts, spec.top_keywords).select(
            "window_start",
            F.lit("keyword").alias("kind"),
            F.col("word").alias("key"),
            F.col("frequency").alias("n"),
            "rank",
        )
        nested = nested.unionByName(best)
    columns = [
        _pairs("source").alias("articles_per_source"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "source", F.col("key")))).alias("sources"),
    ]
    if "source_type" in kinds:
        columns.append(_pairs("source_type").alias("articles_per_type"))
    if "category" in kinds:
        columns.append(_pairs("category").alias("categories"))
    if "keyword" in kinds:
        ranked = F.when(
            F.col("kind") == "keyword",
            F.struct("rank", F.col("key").alias("word"), F.col("n").alias("frequency")),
        )
        words = F.transform(
            F.array_sort(F.collect_list(ranked)),
            lambda x: F.struct(x["word"].alias("word"), x["frequency"].alias("frequency")),
        )
        columns.append(words.alias("top_keywords"))
    breakdowns = nested.groupBy("window_start").agg(*columns)
    view = window_stats(articles, spec).join(breakdowns, "window_start")
    if rounded:
        for c in ("avg_title_length", "avg_description_length", "rate_per_min"):
            view = view.withColumn(c, round_half_even(F.col(c)))
    return view.withColumn(
        "metadata",
        F.struct(
            F.col("total_articles").alias("article_count"),
            (
                (F.unix_micros("last_article_at") - F.unix_micros("window_start")) / F.lit(1_000_000.0)
            ).alias("window_duration_seconds"),
            F.struct(
                F.lit(spec.size_s).alias("window_size"),
                F.lit(spec.slide_s).alias("slide"),
                F.lit(spec.max_articles).alias("max_window_size"),
                F.array(*[F.lit(k) for k in kinds]).alias("kinds"),
            ).alias("config"),
        ),
    )


def dense_windows(stats: DataFrame, spec: WindowSpec) -> DataFrame:
    """Every window between the first and the last one; windows without rows are zero.

    The calendar is built in steps of about a day, then in slides within a step.
    """
    slide = spec.slide_s
    stride = slide * max(1, 86_400 // slide)
    bounds = stats.agg(
        F.min(F.unix_seconds("window_start")).alias("lo"), F.max(F.unix_seconds("window_start")).alias("hi")
    ).filter("lo is not null")
    # unfolded in two steps so that the calendar is built in parallel
    spans = bounds.select("hi", F.explode(F.expr(f"sequence(lo, hi, {stride}L)")).alias("lo"))
    last = F.least(F.col("hi"), F.col("lo") + F.lit(stride - 1))
    starts = spans.repartition("lo").select(
        F.explode(F.sequence(F.col("lo"), last, F.lit(slide).cast("long"))).alias("s")
    )
    calendar = starts.select(F.timestamp_seconds("s").alias("window_start"))
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(t)) for c, t in stats.dtypes if t in ("bigint", "int", "double")}
    return with_end(calendar.join(stats.drop("window_end"), "window_start", "left"), spec).withColumns(zero)


def newest_in_windows(articles: DataFrame, spec: WindowSpec, tie: str = "link") -> DataFrame:
    """Window memberships of the newest ``max_articles`` rows of each window.

    A row that is among the newest N of a window is among the newest N of its
    pane, so panes are cut first and at most N rows per pane are multiplied.
    """
    order = [F.desc("ts"), F.desc(tie)]
    panes = articles.withColumn("pane", F.window("ts", f"{spec.pane_s} seconds").start)
    cut = newest(panes, ["pane"], order, spec.max_articles)
    members = to_windows(cut, spec)
    if spec.size_s == spec.pane_s:
        return members
    return top_k(members, ["window_start"], order, spec.max_articles, "_rn").drop("_rn")


def capped_window_stats(articles: DataFrame, spec: WindowSpec, tie: str = "link") -> DataFrame:
    """Window statistics over the newest ``max_articles`` rows only."""
    kept = newest_in_windows(lengths(articles, tie), spec, tie)
    per_source = kept.groupBy("window_start", "source").agg(*measures())
    return with_end(per_source.groupBy("window_start").agg(*stats_columns(spec)), spec)


def dropped_per_window(articles: DataFrame, spec: WindowSpec) -> DataFrame:
    """Rows arrived, kept and evicted per window under the cap."""
    counts = window_source_totals(articles, spec).groupBy("window_start").agg(F.sum("n").alias("arrived"))
    cap = F.lit(spec.max_articles).cast("long")
    return with_end(counts, spec).withColumns(
        {
            "kept": F.least(F.col("arrived"), cap),
            "dropped": F.greatest(F.col("arrived") - cap, F.lit(0).cast("long")),
        }
    )


def _batch_stats(rows: DataFrame, by: list[str], spec: WindowSpec) -> DataFrame:
    per_source = rows.groupBy(*by, "source").agg(*measures(), F.min("ts").alias("first_at"))
    return per_source.groupBy(*by).agg(*stats_columns(spec), F.min("first_at").alias("first_article_at"))


def count_windows(
    articles: DataFrame, size: int, keys: list[str] | None = None, tie: str = "link", length_unit: str = "bytes"
) -> DataFrame:
    """Windows of ``size`` consecutive rows per key; the last one may be unfilled."""
    keys = keys or []
    spec = WindowSpec(length_unit=length_unit)
    numbered = running_index(lengths(articles, *keys, tie), keys, ["ts", tie])
    rows = numbered.withColumn("window_no", F.floor((F.col("rn") - 1) / F.lit(size)).cast("long"))
    by = [*keys, "window_no"]
    if "source" in keys:
        stats = rows.groupBy(*by).agg(*measures(), F.min("ts").alias("first_article_at"))
        unit = length_unit
        stats = stats.select(
            *by,
            F.col("n").alias("total_articles"),
            (F.col(f"title_{unit}") / F.col("n")).alias("avg_title_length"),
            (F.col(f"desc_{unit}") / F.col("n")).alias("avg_description_length"),
            "first_article_at",
            F.col("last_at").alias("last_article_at"),
        )
    else:
        stats = _batch_stats(rows, by, spec).drop("rate_per_min")
    return stats.withColumn("closed", F.col("total_articles") == size)


def forced_close_windows(articles: DataFrame, spec: WindowSpec, tie: str = "link") -> DataFrame:
    """Time windows closed early after every ``max_articles`` rows."""
    start = F.window("ts", spec.size).start
    placed = lengths(articles, tie).withColumn("window_start", start)
    numbered = running_index(placed, ["window_start"], ["ts", tie])
    part = F.floor((F.col("rn") - 1) / F.lit(spec.max_articles)).cast("long")
    stats = _batch_stats(numbered.withColumn("part", part), ["window_start", "part"], spec).drop("rate_per_min")
    return with_end(stats, spec).withColumn("forced", F.col("total_articles") == spec.max_articles)
