"""Named queries: each takes a session and a folder of tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.config import StreamSpec, WindowSpec, kinds_for
from broadsheet.functions.dates import parse_iso, parse_published, rfc3339
from broadsheet.functions.html import sanitize_html
from broadsheet.functions.text import words
from broadsheet.functions.urls import clean_link, link_error
from broadsheet.operators import articles as art
from broadsheet.operators import counters, history, modules, registry, runs, snapshot, validate, windows
from broadsheet.plans import views
from broadsheet.schema import MICROSECONDS
from broadsheet.session import materialise, scratch_path, settings, state_settings
from broadsheet.sources import feeds, json_store, messages, pages, run_files, window_store
from broadsheet.streaming import ordered, running, sinks
from broadsheet.streaming import windows as stream_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SLIDING = WindowSpec()
HOURLY = WindowSpec.tumbling(3600, length_unit="bytes", max_articles=3)
FIVE_MINUTES = WindowSpec.tumbling(300)
DAILY = WindowSpec.tumbling(86_400)
SIX_HOURS = WindowSpec(size_s=21_600, slide_s=3_600, max_articles=5)
TTL_S = 6 * 3600


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, folder: views.plain(fn(spark, folder))
    return fn


# ---- articles -----------------------------------------------------------------


@query
def articles_view(spark, d):
    a = views.articles(spark, d)
    return a.select(
        "doc_id", "source", "source_type", "title", "link", F.length("description").alias("desc_chars"),
        "published", F.array_join("categories", ",").alias("categories"), "scraped_at",
    )


@query
def event_time(spark, d):
    """Scrape time missing for some articles and unreadable for others."""
    k = F.col("doc_id") % 3
    raw = F.when(k == 0, F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss")).when(k == 1, "yesterday")
    a = views.articles(spark, d).withColumn("scraped_at_raw", raw)
    a = a.withColumn("scraped_at", parse_iso(F.col("scraped_at_raw")))
    a = art.with_event_time(a, views.as_of())
    return a.select("doc_id", "ts", F.col("ts").isNull().alias("rejected"))


@query
def routed_sources(spark, d):
    """Articles per route when the collector does not know one of the types."""
    kind = F.when(F.col("doc_id") % 7 == 0, "atom").otherwise(F.col("source_type"))
    routed = art.route(views.articles(spark, d).select("doc_id", kind.alias("type")))
    tagged = [f.withColumn("route", F.lit(name)) for name, f in routed.items()]
    return art.gather(tagged).groupBy("route", "error").agg(F.count(F.lit(1)).alias("n"))


@query
def gathered_articles(spark, d):
    """Feed and page rows in one frame; page rows have no description column."""
    frames = art.route(views.articles(spark, d), "source_type")
    both = art.gather([frames["rss"], frames["html"].drop("description", "published")])
    return art.fill_defaults(both).select(
        "doc_id", "source_type", F.length("description").alias("desc_chars"), "published"
    )


@query
def unique_links(spark, d):
    p = views.table(spark, d, "pages").select("page_id", clean_link(F.col("url")).alias("link"))
    return art.unique_links(p, [F.asc("page_id")])


# ---- window statistics ----------------------------------------------------------


@query
def sliding_window_stats(spark, d):
    return windows.window_stats(views.articles(spark, d), SLIDING)


@query
def tumbling_window_stats(spark, d):
    return windows.window_stats(views.articles(spark, d), HOURLY)


@query
def minute_window_stats(spark, d):
    return windows.window_stats(views.articles(spark, d), WindowSpec.tumbling(60))


@query
def sliding_source_counts(spark, d):
    return windows.window_key_counts(views.articles(spark, d), SLIDING, ("source",))


@query
def tumbling_type_counts(spark, d):
    return windows.window_key_counts(views.articles(spark, d), HOURLY, ("source_type",))


@query
def category_counts(spark, d):
    return windows.window_key_counts(views.articles(spark, d), SIX_HOURS, ("category",))


@query
def window_keywords(spark, d):
    return windows.window_key_counts(views.articles(spark, d), SLIDING, ("keyword",))


@query
def window_breakdowns(spark, d):
    """All breakdowns of a window from one pass."""
    return windows.window_key_counts(views.articles(spark, d), SIX_HOURS)


@query
def selected_breakdowns(spark, d):
    kinds = kinds_for(["basic", "source_stats"])
    return windows.window_key_counts(views.articles(spark, d), HOURLY, kinds)


@query
def top_keywords(spark, d):
    counts = windows.window_key_counts(views.articles(spark, d), SIX_HOURS, ("keyword",))
    return windows.top_keywords(counts)


@query
def window_view_flat(spark, d):
    """The nested window rows, unfolded again."""
    v = windows.window_view(views.articles(spark, d), SIX_HOURS, rounded=False)

    def rows(kind, entries, key="key", n="value"):
        return F.transform(
            entries, lambda x: F.struct(F.lit(kind).alias("kind"), x[key].alias("key"), x[n].alias("n"))
        )

    sources = F.struct(
        F.lit("sources").alias("kind"), F.array_join("sources", ",").alias("key"),
        F.col("metadata.article_count").alias("n"),
    )
    parts = F.concat(
        rows("source", F.map_entries("articles_per_source")),
        rows("source_type", F.map_entries("articles_per_type")),
        rows("category", F.map_entries("categories")),
        rows("keyword", F.col("top_keywords"), "word", "frequency"),
        F.array(sources),
    )
    return v.select("window_start", F.inline(parts))


@query
def rounded_windows(spark, d):
    """The figures of window rows as they are stored, half-even to two places."""
    v = windows.window_view(views.articles(spark, d), SIX_HOURS)
    return v.select(
        "window_start", "avg_title_length", "avg_description_length", "rate_per_min",
        F.col("metadata.article_count").alias("article_count"),
    )


@query
def byte_vs_char_length(spark, d):
    per = windows.window_source_totals(views.articles(spark, d), HOURLY)
    sums = [F.sum(c).alias(c) for c in ("n", "title_chars", "title_bytes", "desc_chars", "desc_bytes")]
    return per.groupBy("window_start").agg(*sums)


@query
def top_source_per_window(spark, d):
    """Volume, rate and leading source of each sliding window."""
    leaders = windows.window_leaders(views.articles(spark, d), SLIDING)
    return leaders.select(
        "window_start", "window_end", "total_articles", "sources_count", "rate_per_min", "top_source", "top_count"
    )


@query
def capped_window_stats(spark, d):
    return windows.capped_window_stats(views.articles(spark, d), SIX_HOURS, "doc_id")


@query
def dropped_per_window(spark, d):
    return windows.dropped_per_window(views.articles(spark, d), SIX_HOURS)


@query
def dense_windows(spark, d):
    stats = windows.window_stats(views.articles(spark, d), SLIDING)
    return windows.dense_windows(stats, SLIDING)


@query
def count_windows(spark, d):
    a = views.articles(spark, d)
    return windows.count_windows(a, 7, ["source"], "doc_id")


@query
def count_windows_all(spark, d):
    return windows.count_windows(views.articles(spark, d), 50, [], "doc_id")


@query
def forced_close_windows(spark, d):
    return windows.forced_close_windows(views.articles(spark, d), HOURLY, "doc_id")


@query
def named_aggregators(spark, d):
    specs = {"hour": HOURLY, "six_hours": SIX_HOURS}
    rows = windows.roll_up(windows.lattice(views.articles(spark, d), specs), specs)
    return rows.select("aggregator", "window_start", "total_articles", "avg_title_length")


# ---- trailing window ------------------------------------------------------------


@query
def trailing_snapshot(spark, d):
    a = views.articles(spark, d)
    return snapshot.snapshot(a, views.latest_ts(a), SIX_HOURS)


@query
def trailing_snapshots(spark, d):
    """The trailing window at a thousand instants, evenly spaced from the first event to the last."""
    a = views.articles(spark, d)
    lo, hi = views.table(spark, d, "events").agg(F.min("ts"), F.max("ts")).select(
        F.unix_micros(F.col("min(ts)").cast("timestamp")), F.unix_micros(F.col("max(ts)").cast("timestamp"))
    ).first()
    step = F.expr(f"timestamp_micros({lo or 0} + (id * {(hi or 0) - (lo or 0)}) div 999)")
    return snapshot.snapshots(a, spark.range(1000).select(step.alias("as_of")), SIX_HOURS)


@query
def trailing_sources(spark, d):
    a = views.articles(spark, d)
    rows = art.trailing(a, views.latest_ts(a), "12 hours")
    return snapshot.source_counts(rows)


@query
def source_distribution(spark, d):
    return snapshot.source_distribution(views.articles(spark, d))


@query
def top_source(spark, d):
    return snapshot.top_source(views.articles(spark, d))


@query
def top_sources_other(spark, d):
    return snapshot.top_sources_other(views.articles(spark, d))


# ---- validation -----------------------------------------------------------------


@query
def validate_titles(spark, d):
    a = views.articles(spark, d)
    title = validate.clean_title(F.col("title"))
    return a.select("doc_id", title.alias("title"), validate.title_error(F.col("title")).alias("error"))


@query
def validate_links(spark, d):
    p = views.table(spark, d, "pages")
    # every third address is broken in one of two ways
    k = F.col("page_id") % 6
    url = F.when(k == 2, F.concat(F.lit("ftp"), F.col("url"))).when(k == 5, F.concat(F.lit(" "), F.col("url")))
    p = p.select("page_id", F.coalesce(url, F.col("url")).alias("url"))
    error = link_error(F.col("url"))
    return p.select("page_id", error.alias("error"), F.when(error.isNull(), clean_link(F.col("url"))).alias("link"))


@query
def sanitize_pages(spark, d):
    return views.table(spark, d, "pages").select("page_id", sanitize_html(F.col("html")).alias("text"))


@query
def validate_descriptions(spark, d):
    p = views.table(spark, d, "pages")
    text = validate.clean_description(F.col("html"))
    return p.select("page_id", F.octet_length(text).alias("n_bytes"), validate.description_error(text).alias("error"))


@query
def parse_dates(spark, d):
    e = _dated_events(spark, d)
    return e.select("event_id", parse_published(F.col("published"), views.as_of()).alias("parsed"))


@query
def parse_dates_lenient(spark, d):
    e = _dated_events(spark, d)
    return e.select("event_id", parse_published(F.col("published"), views.as_of(), "lenient").alias("parsed"))


def _dated_events(spark, d):
    e = views.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select("event_id", views.published_text(F.col("event_id"), F.col("ts")).alias("published"))


@query
def rfc3339_texts(spark, d):
    e = views.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    cut = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    return e.select("event_id", rfc3339(cut).alias("text"))


@query
def validation_verdicts(spark, d):
    v = validate.verdicts(views.checked_articles(spark, d), views.as_of())
    return v.select(
        "doc_id", "success", "error_code", "error", F.col("valid_title").alias("title"), F.col("valid_link").alias("link"),
        F.col("valid_published").alias("published"),
        F.when(F.col("success"), F.col("checked_bytes")).otherwise(0).alias("desc_bytes"),
    )


@query
def verdicts_without_source(spark, d):
    """Every sixth article has a blank source or none; the other checks come first."""
    k = F.col("doc_id") % 12
    blank = F.when(k == 5, " ").when(k != 11, F.col("source"))
    v = validate.verdicts(views.checked_articles(spark, d).withColumn("source", blank), views.as_of())
    return v.select("doc_id", "error_code", "error")


@query
def valid_and_invalid(spark, d):
    """Accepted and refused rows with an unvalidated column beside them."""
    a = views.checked_articles(spark, d).select("doc_id", "source_type", *validate.FIELDS, *validate.TEXT_CHECKS)
    path = scratch_path(spark, "routed")
    validate.write_routed(a, path, views.as_of())
    valid, invalid = validate.read_routed(spark, path, a.schema)
    return art.gather(
        [valid.select("doc_id", "source_type", F.lit(None).cast("string").alias("error_code")),
         invalid.select("doc_id", "source_type", "error_code")]
    )


@query
def verdict_messages(spark, d):
    v = validate.validate(views.checked_articles(spark, d), views.as_of())
    text = validate.verdict_json()
    return v.select(
        "doc_id",
        F.get_json_object(text, "$.success").alias("success"),
        F.get_json_object(text, "$.error").alias("error"),
        F.get_json_object(text, "$.validated_article.link").alias("link"),
    )


@query
def validation_summary(spark, d):
    return validate.reason_counts(views.checked_articles(spark, d), views.as_of())


@query
def stage_counters(spark, d):
    v = validate.verdicts(views.checked_articles(spark, d), views.as_of())
    return counters.stage_counters(v, F.col("success"))


# ---- history --------------------------------------------------------------------


def _history(spark, d):
    return windows.window_stats(views.articles(spark, d), FIVE_MINUTES)


def _stored_history(spark, d):
    """The history as a table, for views that read it more than once."""
    path = scratch_path(spark, "history")
    window_store.store(_history(spark, d), path)
    return window_store.read_windows(spark, path)


@query
def history_slice(spark, d):
    h = _history(spark, d)
    rows = history.history_slice(h, views.latest_ts(h, "window_start"), hours=24, limit=100)
    return rows.select("window_start", "window_end", "total_articles", "sources_count", "rate_per_min")


@query
def moving_average(spark, d):
    return history.moving_average(_stored_history(spark, d), block=64)


@query
def trend(spark, d):
    return history.trend(_history(spark, d))


@query
def heatmap(spark, d):
    return history.heatmap(_history(spark, d))


@query
def rate_reference(spark, d):
    r = history.rate_reference(_stored_history(spark, d))
    return r.withColumn("mean_rate", F.round("mean_rate", 6))


@query
def last_windows(spark, d):
    return history.last_windows(_history(spark, d), 100).select("window_start", "total_articles")


@query
def list_windows(spark, d):
    return history.list_windows(windows.window_stats(views.articles(spark, d), HOURLY))


@query
def window_by_source(spark, d):
    a = views.articles(spark, d)
    stats = windows.window_stats(a, HOURLY)
    return window_store.columnar_by_source(stats, windows.window_key_counts(a, HOURLY, ("source",)))


@query
def stored_windows_range(spark, d):
    """Windows written to the store and read back over a range."""
    a = views.articles(spark, d)
    path = scratch_path(spark, "windows")
    window_store.store(windows.window_stats(a, HOURLY), path)
    start, end = F.lit("2024-01-01 06:00:00").cast("timestamp"), F.lit("2024-01-02 12:00:00").cast("timestamp")
    return window_store.columnar(window_store.read_windows(spark, path, start, end))


@query
def stored_results(spark, d):
    """Window rows of two analyses stored as JSON in halves of a day, some corrected, some batches repeated."""
    v = windows.window_view(views.articles(spark, d), HOURLY, rounded=False)
    r = materialise(window_store.to_results(v, views.as_of()), "rows")
    early = F.hour("window_start") < 12
    halves = {"mornings": r.filter(early), "afternoons": r.filter(~early)}
    daily = windows.window_view(views.articles(spark, d), DAILY, rounded=False)
    halves["days"] = window_store.to_results(daily, views.as_of(), "daily")
    # windows stored before are stored again with other figures, then as they were
    changed = r.filter(F.hour("window_start") % 5 == 3).withColumn("results", F.lit("{}"))
    halves |= {"wrong": changed, "right": r.filter(F.hour("window_start") % 5 == 3)}
    stored = window_store.WindowStore(spark, scratch_path(spark, "results"))
    for batch in ("mornings", "afternoons", "days", "wrong", "mornings", "right", "wrong"):
        stored.merge(halves[batch], batch)
    return stored.read().select(
        "window_start", "window_end", "analysis_type",
        F.get_json_object("results", "$.total_articles").cast("long").alias("total_articles"),
        F.coalesce(F.get_json_object("results", "$.articles_per_source.src3").cast("long"), F.lit(0)).alias("from_src3"),
        F.get_json_object("results", "$.top_keywords[0].frequency").cast("long").alias("best_frequency"),
    )


@query
def retained_windows(spark, d):
    """What is left of stored hourly windows once days without one of the newest 30 are dropped and their files removed."""
    rows = windows.window_stats(views.articles(spark, d), HOURLY)
    stored = window_store.WindowStore(spark, scratch_path(spark, "retained"))
    stored.merge(rows.filter(F.hour("window_start") % 2 == 0), "even")
    stored.merge(rows.filter(F.hour("window_start") % 2 == 1), "odd")
    stored.retain(30)
    stored.vacuum(commits=0)
    return stored.read().select("window_start", "window_end", "total_articles", "sources_count")


# ---- extraction and messages ----------------------------------------------------


def _page_columns(df: DataFrame) -> DataFrame:
    return df.select("page_id", F.col("pos").cast("int").alias("pos"), "title", "link", "source_type")


@query
def html_articles(spark, d):
    p = views.table(spark, d, "pages")
    return _page_columns(pages.page_articles(p, views.as_of(), ["page_id"], link_fallback="page_url"))


@query
def html_articles_strict(spark, d):
    """Pages whose heading is a relative link, as listing pages have it."""
    linked = F.regexp_replace("html", r"<h1>(.*?)</h1>", r'<h3><a class="x" href="/story?a=1&amp;b=2">$1</a></h3>')
    p = views.table(spark, d, "pages").withColumn("html", linked)
    return _page_columns(pages.page_articles(p, views.as_of(), ["page_id"]))


@query
def html_articles_nested(spark, d):
    """Each page wrapped in a further block: the outer block comes first and holds the inner one."""
    wrapped = F.replace(
        F.replace("html", F.lit("<article>"), F.lit('<div class="news-list"><article>')),
        F.lit("</article>"), F.lit("</article></div>"),
    )
    p = views.table(spark, d, "pages").withColumn("html", wrapped)
    return _page_columns(pages.page_articles(p, views.as_of(), ["page_id"], link_fallback="page_url"))


@query
def html_articles_promo(spark, d):
    """Pages that open with one to twelve promo blocks around inner blocks; ten blocks of a page count."""
    n = (F.col("page_id") % 12 + 1).cast("int")

    def block(k):
        return F.concat(
            F.lit("<div class=gs-c-promo><div class=img><img src=x></div><h3>Caf&eacute; "), k.cast("string"),
            F.lit(" &#8212; "), F.col("page_id").cast("string"), F.lit("</h3><a href=/p/"), k.cast("string"),
            F.lit(">more</a></div>"),
        )

    opening = F.array_join(F.transform(F.sequence(F.lit(1), n), block), "")
    p = views.table(spark, d, "pages")
    p = p.withColumn("html", F.concat(opening, F.coalesce("html", F.lit(""))))
    return _page_columns(pages.page_articles(p, views.as_of(), ["page_id"], link_fallback="page_url"))


def _xml(c) -> F.Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def _rss_items() -> F.Column:
    """The article of a row as a feed item, and a second item."""
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    date = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    item = F.concat(
        tag("title", _xml(F.col("title"))), tag("link", F.col("link")),
        tag("description", _xml(F.col("description"))), tag("pubDate", date),
        tag("author", F.col("source_type")), tag("dc:creator", F.lit("desk")),
        tag("category", F.col("categories")[0]), tag("category", F.col("categories")[1]),
    )
    second = F.concat(tag("title", F.lit("more")), tag("link", F.concat("link", F.lit("/more"))))
    return F.concat(tag("item", item), tag("item", second))


_RSS_HEAD = '<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>f</title>'
_RSS_TAIL = "</channel></rss>"


def _rss_document(items: F.Column) -> F.Column:
    return F.concat(F.lit(_RSS_HEAD), items, F.lit(_RSS_TAIL))


def _feed_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "source", "title", "link", F.length("description").alias("desc_chars"),
        F.array_join("authors", ",").alias("authors"), F.array_join("categories", ",").alias("categories"),
        "published_time", "source_type",
    )


@query
def rss_articles(spark, d):
    """Articles written as feed documents and read back."""
    f = views.articles(spark, d).select("source", _rss_document(_rss_items()).alias("xml"))
    return _feed_columns(feeds.feed_articles(f, views.as_of()))


@query
def routed_feeds(spark, d):
    """Feeds of documents, some cut short: what was read and what was refused, written by one job and read back."""
    title = _xml(F.split_part("text", F.lit("\n"), F.lit(1)))
    item = F.concat(F.lit("<item><title>"), title, F.lit("</title><link>https://x.test/"), F.col("doc_id"), F.lit("</link></item>"))
    whole = _rss_document(F.repeat(item, 2))
    cut = F.left(whole, F.length(whole) - F.when(F.col("doc_id") % 7 == 3, 12).when(F.col("doc_id") % 7 == 5, 40).otherwise(0))
    parsed = feeds.parse_feeds(views.table(spark, d, "documents").select("doc_id", cut.alias("xml")))
    path = scratch_path(spark, "routed-feeds")
    outcome = F.when(F.col("error").isNull(), "read").otherwise("refused").alias("outcome")
    parsed.select("doc_id", "xml", "items", "error", outcome).write.partitionBy("outcome").parquet(path)
    back = spark.read.schema(T.StructType([*parsed.schema, T.StructField("outcome", T.StringType())])).parquet(path)
    read = feeds.articles_of(back.filter("outcome = 'read'"), views.as_of(), ["doc_id"])
    refused = feeds.rejected(back.filter("outcome = 'refused'"))
    return art.gather(
        [read.select("doc_id", "link", F.lit(None).cast("string").alias("error")),
         refused.select("doc_id", F.lit(None).cast("string").alias("link"), "error")]
    )


def _write_files(rows: DataFrame, path: str, head: str, line: F.Column, between: str, tail: str) -> None:
    """One compressed text file per ``part``: a line per row, with a text before, between and after the lines."""
    text = F.concat(
        F.when(F.col("place") == 1, F.lit(head)).otherwise(F.lit(between)), F.coalesce(line, F.lit("")),
        F.when(F.col("place") == F.col("places"), F.lit(tail)).otherwise(F.lit("")),
    )
    # the rows of a part are in one task; in this order a file is written line by line
    lines = rows.select(text.alias("value"), "part", "place").sortWithinPartitions("part", "place").select("value", "part")
    # level 4 takes a quarter of the time of level 6 for files 4 % larger; what was shuffled goes with the end of the job
    lines = lines.write.mode("append").options(**{"compression": "gzip", "zlib.compress.level": "FOUR"})
    with settings(rows.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        lines.partitionBy("part").text(path)


def _in_files(spark, d):
    """Frames of articles with the ``part`` of 500 they are written in."""
    return views.dealt_articles(spark, d, F.floor(F.col("doc_id") / 500), "part")


@query
def rss_files(spark, d):
    """Feed files of 500 articles each. The source is then the name of a file, and only the items are compared."""
    path = scratch_path(spark, "feeds")
    for a in _in_files(spark, d):
        _write_files(a, path, _RSS_HEAD, _rss_items(), "", _RSS_TAIL)
    return _feed_columns(feeds.read_feeds(spark, f"{path}/*", views.as_of())).drop("source")


@query
def atom_articles(spark, d):
    entry = F.concat(
        F.lit("<entry><title>"), _xml(F.col("title")), F.lit('</title><link rel="self" href="x"/><link href="'),
        F.col("link"), F.lit('"/><summary>'), _xml(F.col("description")), F.lit("</summary><published>"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</published><author><name>"), F.col("source_type"),
        F.lit('</name></author><category term="'), F.col("categories")[0], F.lit('"/></entry>'),
    )
    feed = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), entry, F.lit("</feed>"))
    f = views.articles(spark, d).select("source", feed.alias("xml"))
    return _feed_columns(feeds.feed_articles(f, views.as_of(), kind="atom"))


def _messages(spark, d):
    """Messages as a broker hands them out, every tenth one cut short."""
    a = views.articles(spark, d).drop("ts", "text_id").withColumnRenamed("doc_id", "offset")
    rows = messages.to_messages(a, beside=("offset",))
    text = F.col("value").cast("string")
    broken = F.when(F.col("offset") % 10 == 3, F.left(text, F.length(text) - 5)).otherwise(text)
    return rows.select(
        "topic", (F.col("offset") % 4).cast("int").alias("partition"), "offset",
        views.as_of().alias("timestamp"), broken.cast("binary").alias("value"),
    )


@query
def decode_messages(spark, d):
    rows = messages.decode_messages(_messages(spark, d))
    return rows.select(
        "_meta.topic", "_meta.partition", "_meta.offset", "source", "title", "link",
        F.array_join("categories", ",").alias("categories"), "scraped_at",
    )


@query
def labelled_categories(spark, d):
    """Messages whose categories are a plain name, an object naming itself and a null, counted per window."""
    a = views.articles(spark, d)
    named = F.to_json(F.struct(F.col("categories")[0].alias("term")))
    plain = F.concat(F.lit('"'), F.col("categories")[1], F.lit('"'))
    value = F.concat(
        F.lit('{"source":"'), F.col("source"), F.lit('","scraped_at":"'),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit('","categories":['), named, F.lit(","), plain, F.lit(",null]}"),
    )
    sent = a.select(F.lit("news-articles").alias("topic"), F.col("doc_id").alias("offset"), value.cast("binary").alias("value"))
    rows = messages.decode_messages(sent).withColumn("ts", F.col("scraped_at"))
    return windows.window_key_counts(rows, HOURLY, ("category",))


@query
def callback_before_windows(spark, d):
    """Decoded messages pass through a user's function before they are counted."""

    def without_clicks(rows: DataFrame) -> DataFrame:
        return rows.filter(~F.array_contains("categories", "click")).withColumn("source", F.upper("source"))

    rows = messages.decode_messages(_messages(spark, d)).withColumn("ts", F.col("scraped_at"))
    return windows.window_key_counts(rows.transform(without_clicks), HOURLY, ("source",))


@query
def dead_letters(spark, d):
    bad = messages.dead_letters(_messages(spark, d))
    return bad.select("_meta.partition", "_meta.offset")


@query
def kafka_rows(spark, d):
    a = views.articles(spark, d)
    rows = messages.to_messages(a.drop("ts", "text_id"))
    value = F.col("value").cast("string")
    header = lambda i: F.concat_ws("=", F.col("headers")[i]["key"], F.col("headers")[i]["value"].cast("string"))
    return rows.select(
        "topic", F.col("key").cast("string").alias("key"), header(0).alias("header_1"), header(1).alias("header_2"),
        F.get_json_object(value, "$.link").alias("link"), F.get_json_object(value, "$.title").alias("title"),
        F.get_json_object(value, "$.categories[1]").alias("category"),
    )


@query
def json_store_append(spark, d):
    """Articles appended twice to a JSON store and read back, duplicates kept."""
    a = views.articles(spark, d).drop("ts", "doc_id", "text_id", *views.OF_TEXTS)
    path = scratch_path(spark, "articles")
    json_store.append_articles(a, path, compression="gzip")
    json_store.append_articles(a, path, compression="gzip")
    good, _ = json_store.read_articles(spark, path, arrays=False)
    return good.select("source", "title", "link", F.array_join("categories", ",").alias("categories"), "scraped_at")


@query
def json_array_files(spark, d):
    """Files of one JSON array each, 500 articles long, as collectors write them."""
    path = scratch_path(spark, "arrays")
    for a in _in_files(spark, d):
        fields = F.struct(*[c for c in a.columns if c not in ("ts", "doc_id", "text_id", "part", "place", "places")])
        _write_files(a, path, "[", F.to_json(fields, {"timestampFormat": MICROSECONDS}), ",", "]")
    good, _ = json_store.read_articles(spark, f"{path}/*")
    return good.select("source", "title", "link", F.array_join("categories", ",").alias("categories"), "scraped_at")


# ---- registry and runs ----------------------------------------------------------


@query
def active_workers(spark, d):
    beats = views.table(spark, d, "events").select(
        F.concat(F.lit("w"), F.col("user_id")).alias("id"), F.col("event_type").alias("status"),
        F.col("ts").cast("timestamp").alias("last_heartbeat"),
    )
    return registry.active_workers(beats, views.latest_ts(beats, "last_heartbeat"), TTL_S)


@query
def available_sources(spark, d):
    locks = views.locks(spark, d)
    return registry.available_sources(locks, views.latest_ts(locks, "locked_at"), ["locked_at", "event_id"], TTL_S)


@query
def sources_to_scrape(spark, d):
    locks = views.locks(spark, d)
    now = views.latest_ts(locks, "locked_at")
    return registry.sources_to_scrape(views.configured_sources(spark, d), locks, now, ["locked_at", "event_id"], TTL_S)


@query
def without_locked(spark, d):
    locks = views.locks(spark, d)
    now = views.latest_ts(locks, "locked_at")
    return registry.without_locked(views.configured_sources(spark, d), locks, now, ["locked_at", "event_id"], TTL_S)


@query
def run_usage(spark, d):
    return runs.run_usage(views.samples(spark, d), ["scraper", "iteration"], rounded=False)


def _runs(spark, d):
    """One run per collector and iteration, with whole-number figures."""
    s = views.samples(spark, d).groupBy("scraper", "iteration")
    return s.agg(
        F.sum("seconds").alias("execution_time_seconds"), F.min("cpu_percent").alias("avg_cpu_percent"),
        F.max("cpu_percent").alias("max_cpu_percent"), F.min("memory_mb").alias("avg_memory_mb"),
        F.max("memory_mb").alias("max_memory_mb"),
    )


@query
def run_summary(spark, d):
    return runs.run_summary(_runs(spark, d), rounded=False)


@query
def newest_runs(spark, d):
    """Runs in a file per collector and session of a hundred runs; those of the file written last."""
    rows = _runs(spark, d).withColumns(
        {"session": F.floor(F.col("iteration") / 100), "exit_code": F.lit(0), "timestamp": F.lit("2024-01-01T00:00:00")}
    )
    path = scratch_path(spark, "run-files")
    run_files.write_run_files(rows.filter("session > 0"), path)
    run_files.write_run_files(rows.filter("session = 0"), path)
    found = run_files.runs_of(run_files.latest_run_files(spark, path))
    return found.select("scraper", "iteration", "execution_time_seconds", "avg_cpu_percent", "max_memory_mb")


@query
def run_comparison(spark, d):
    return runs.compare(runs.run_summary(_runs(spark, d), rounded=False), "click", "view")


@query
def run_tally(spark, d):
    c = runs.compare(runs.run_summary(_runs(spark, d), rounded=False), "click", "view")
    return runs.tally(c, "click", "view")


@query
def histogram_buckets(spark, d):
    h = counters.histogram(views.table(spark, d, "events"), "value", counters.BATCH_SIZE_BUCKETS, ["event_type"])
    return h.select("event_type", F.when(F.col("le") < float("inf"), F.col("le")).alias("le"), "n")


# ---- streams --------------------------------------------------------------------


def _to_end(spark: SparkSession, df: DataFrame, name: str, end="window_end") -> tuple[DataFrame, str | None]:
    """Run a stream over all present input; its table and the time up to which windows are closed, by their end."""
    path = scratch_path(spark, name)
    with settings(spark, state_settings(spark.sparkContext.defaultParallelism)):
        q = stream_windows.write_table(df, f"{path}/rows", f"{path}/checkpoint")
    q.awaitTermination()
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows")
    return rows, stream_windows.closed_until(q, rows, end)


def _pane_end(width_s: int):
    return F.col("pane") + F.expr(f"INTERVAL {width_s} SECONDS")


def _stream_stats(spark, d, spec, name):
    stats = stream_windows.stream_window_stats(views.article_stream(spark, d), spec)
    closed, until = _to_end(spark, stats, name)
    return art.gather([closed, stream_windows.finalize(views.articles(spark, d), spec, until)])


@query
def stream_tumbling_stats(spark, d):
    """Closed windows of the stream and the still open ones from the stored articles."""
    return _stream_stats(spark, d, HOURLY, "stream-tumbling")


@query
def stream_sliding_stats(spark, d):
    return _stream_stats(spark, d, SLIDING, "stream-sliding")


@query
def stream_top_keywords(spark, d):
    """Counts per closed window from the panes of the stream; ranked once the windows are closed."""
    kinds = ("keyword",)
    panes = stream_windows.stream_key_counts(views.article_stream(spark, d), SIX_HOURS, kinds, panes=True)
    closed, until = _to_end(spark, panes, "stream-keywords", _pane_end(SIX_HOURS.pane_s))
    closed = stream_windows.closed_key_counts(closed, SIX_HOURS, until)
    tail = stream_windows.finalize_key_counts(views.articles(spark, d), SIX_HOURS, kinds, until)
    return windows.top_keywords(art.gather([closed, tail]))


def _sharded(a):
    """Articles with the broker partition they came through, so that no source sits in one task."""
    return a.withColumn("shard", (F.col("doc_id") % 4).cast("int"))


@query
def stream_count_windows(spark, d):
    """Windows of seven articles per source and shard in event order, emitted by the stream, then those left open."""
    keys = ["source", "shard"]
    rows = ordered.ordered_count_windows(_sharded(views.article_stream(spark, d)), 7, keys, "doc_id")
    closed, _ = _to_end(spark, rows, "stream-counts", "last_article_at")
    left = ordered.open_count_windows(_sharded(views.articles(spark, d)), closed, 7, keys, "doc_id")
    return art.gather([closed.withColumn("by_stream", F.lit(True)), left.withColumn("by_stream", F.lit(False))])


@query
def stream_named_aggregators(spark, d):
    """Two named aggregators over one stream, whose state is the panes they share."""
    specs = {"hour": HOURLY, "six_hours": SIX_HOURS}
    panes = stream_windows.stream_lattice(views.article_stream(spark, d), specs)
    closed, until = _to_end(spark, panes, "stream-lattice", _pane_end(windows.lattice_s(specs.values())))
    left = stream_windows.finalize_lattice(views.articles(spark, d), specs, until)
    rows = windows.roll_up(art.gather([closed, left]), specs)
    return rows.select("aggregator", "window_start", "total_articles", "avg_title_length")


@query
def stream_capped_windows(spark, d):
    """Windows over their five newest articles, the stream holding no more than that per pane and shard."""
    kept = ordered.newest_per_pane(_sharded(views.article_stream(spark, d)), SIX_HOURS, "doc_id")
    closed, until = _to_end(spark, kept, "stream-newest", _pane_end(SIX_HOURS.pane_s))
    left = ordered.stored_newest_per_pane(views.articles(spark, d), SIX_HOURS, until, "doc_id")
    return ordered.windows_of_newest(art.gather([closed, left]), SIX_HOURS)


@query
def stream_running_windows(spark, d):
    """Three runs of one stream, each with a third of the events: every window as it stood after each."""
    path = scratch_path(spark, "running")
    events = views.table(spark, d, "events").select("event_id", "ts", "event_type")
    wait = StreamSpec(watermark="400 days")
    for run in range(3):
        events.filter(F.col("event_id") % 3 == run).write.parquet(f"{path}/events/run={run}")
        updates = running.stream_pane_updates(views.arriving_articles(spark, d, f"{path}/events/*"), SIX_HOURS, wait)
        with settings(spark, state_settings(spark.sparkContext.defaultParallelism)):
            running.write_updates(updates, f"{path}/updates", f"{path}/checkpoint").awaitTermination()
    return running.window_versions(running.read_updates(spark, f"{path}/updates", updates), SIX_HOURS).drop("batch_id")


@query
def stream_unique_links(spark, d):
    """Articles that arrive under one link per language and day, first arrival kept."""
    a = views.article_stream(spark, d)
    link = F.concat_ws("/", F.col("categories")[0], F.to_date("ts"))
    rows = stream_windows.stream_unique_links(a.withColumn("link", link), "40 days")
    closed, _ = _to_end(spark, rows.select("link", "ts"), "stream-unique", "ts")
    return closed.select("link")


@query
def stream_delivery(spark, d):
    """Batches a refusing broker did not take, kept as a table."""
    path = scratch_path(spark, "delivery")

    def refuse(batch: DataFrame) -> None:
        raise ConnectionError("no broker")

    sink = sinks.delivery(refuse, sinks.parquet_sink(f"{path}/kept"), f"{path}/outcomes", backup=False)
    rows = views.article_stream(spark, d).select("doc_id", "source", "link")
    sinks.start(rows, sink, f"{path}/checkpoint").awaitTermination()
    return sinks.read_batches(spark, f"{path}/kept")


@query
def stream_delivery_taken(spark, d):
    """Batches taken as a whole, with a backup beside them."""
    path = scratch_path(spark, "delivery")
    sink = sinks.delivery(
        lambda batch: batch.write.mode("append").parquet(f"{path}/topic"), sinks.json_sink(f"{path}/kept"), f"{path}/outcomes"
    )
    rows = views.article_stream(spark, d).select("doc_id", "source", "link")
    sinks.start(rows, sink, f"{path}/checkpoint").awaitTermination()
    taken = spark.read.schema(rows.schema).parquet(f"{path}/topic").withColumn("place", F.lit("topic"))
    kept = spark.read.schema(rows.schema).json(f"{path}/kept").drop("batch_id").withColumn("place", F.lit("backup"))
    return art.gather([taken, kept])


@query
def stream_delivery_rows(spark, d):
    """A refused batch goes out row by row; the rows refused again are kept."""
    path = scratch_path(spark, "delivery")

    def refuse(batch: DataFrame) -> None:
        raise ConnectionError("no broker")

    def send(row: dict) -> None:
        if row["doc_id"] % 3 == 0:
            raise ValueError("too large")

    sink = sinks.delivery(refuse, sinks.parquet_sink(f"{path}/kept"), f"{path}/outcomes", send=send, backup=False)
    rows = views.article_stream(spark, d).select("doc_id", "source", "link")
    sinks.start(rows, sink, f"{path}/checkpoint").awaitTermination()
    return sinks.read_batches(spark, f"{path}/kept")


@query
def stream_fan_out(spark, d):
    """Batches go to a table and to JSON files, past a callback that fails."""
    path = scratch_path(spark, "fan-out")

    def fail(batch: DataFrame, batch_id: int) -> None:
        raise RuntimeError("callback")

    sink = sinks.fan_out(sinks.callback(fail), sinks.parquet_sink(f"{path}/table"), sinks.json_sink(f"{path}/json"))
    rows = views.article_stream(spark, d).select("doc_id", "source", "link")
    sinks.start(rows, sink, f"{path}/checkpoint").awaitTermination()
    table = spark.read.schema(rows.schema).parquet(f"{path}/table").withColumn("place", F.lit("table"))
    files = spark.read.schema(rows.schema).json(f"{path}/json").withColumn("place", F.lit("json"))
    return art.gather([table, files]).drop("batch_id")


@query
def stream_late_rows(spark, d):
    """Two runs of one stream: the second brings every tenth event, too late for windows that are closed."""
    path = scratch_path(spark, "stream-late")
    events = views.table(spark, d, "events").select("event_id", "ts", "event_type")
    late = F.col("event_id") % 10 == 7
    stats = None
    for run, part in enumerate((events.filter(~late), events.filter(late))):
        part.write.parquet(f"{path}/events/run={run}")
        arriving = views.arriving_articles(spark, d, f"{path}/events/*")
        stats = stream_windows.stream_window_stats(arriving, FIVE_MINUTES)
        with settings(spark, state_settings(spark.sparkContext.defaultParallelism)):
            q = stream_windows.write_table(stats, f"{path}/rows", f"{path}/checkpoint")
        q.awaitTermination()
    closed = spark.read.schema(stats.schema).parquet(f"{path}/rows")
    until = stream_windows.closed_until(q, closed)
    return art.gather([closed, stream_windows.finalize(views.articles(spark, d), FIVE_MINUTES, until)])


# ---- analysis modules -----------------------------------------------------------


@query
def module_statistics(spark, d):
    found = modules.apply_modules(views.articles(spark, d), [modules.BasicStatistics()], ["source"])
    return found["basic"]


@query
def word_count_distribution(spark, d):
    return modules.word_count_distribution(views.articles(spark, d))


@query
def emerging_keywords(spark, d):
    counts = windows.window_key_counts(views.articles(spark, d), HOURLY, ("keyword",))
    return modules.emerging_keys(counts, HOURLY)


@query
def source_popularity(spark, d):
    counts = windows.window_key_counts(views.articles(spark, d), HOURLY, ("source",))
    return modules.emerging_keys(counts, HOURLY, kind="source")


@query
def source_sentiment(spark, d):
    """Sentiment per source, with words of good and of poor documents as the lexicon."""
    a = views.articles(spark, d)
    marks = views.table(spark, d, "labels").select(F.col("doc_id").alias("text_id"), "quality")
    marked = a.join(marks, "text_id").select(F.explode(words(F.col("title"))).alias("word"), "quality")
    weight = F.when(F.sum(F.col("quality") * 2 - 1) > 0, 1.0).otherwise(-1.0)
    lexicon = marked.groupBy("word").agg(weight.alias("weight"))
    return modules.sentiment(a, lexicon, ["source"])


@query
def title_topics(spark, d):
    """Mean share of each of four title topics per six hours."""
    _, shares = modules.topics(views.articles(spark, d), 4, keep=["ts"])
    return modules.topic_evolution(shares, WindowSpec.tumbling(21_600))
