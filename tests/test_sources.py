"""Feeds, pages, JSON stores, messages, stored windows, run files."""

import json
import os
from datetime import datetime

import pytest
from helpers import article, at, frame, order, values
from pyspark.sql import functions as F

from broadsheet.config import WindowSpec
from broadsheet.operators import articles as art
from broadsheet.operators import runs, windows
from broadsheet.sources import feeds, json_store, messages, pages, run_files, window_store


def fetched():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")


RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"
 xmlns:media="http://search.yahoo.com/mrss/"><channel><title>Feed</title><link>https://f</link>
<item><title><![CDATA[ One & only ]]></title><link>https://f/1</link><description>A &lt;b&gt;bold&lt;/b&gt; text</description>
<pubDate>Mon, 01 Jan 2024 12:00:00 GMT</pubDate><category>Politics</category><category> World </category>
<author>ann@x</author><dc:creator>Ann</dc:creator><media:title>other</media:title></item>
<item><title>Новости</title><link>https://f/2</link><category>One</category></item>
<item/></channel></rss>"""

ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title>
<entry><title>Entry</title><link rel="self" href="https://a/self"/><link rel="alternate" href="https://a/1"/>
<summary>S</summary><updated>2024-01-01T10:00:00Z</updated><author><name>Bo</name></author><author><name>Cy</name></author>
<category term="tech"/><category term="web"/></entry></feed>"""


def test_rss(spark):
    df = spark.createDataFrame([("f", RSS), ("broken", "<rss><channel><item>"), ("none", None)], "source string, xml string")
    rows = {r.link: r for r in feeds.feed_articles(df, fetched()).collect()}
    assert set(rows) == {"https://f/1", "https://f/2", ""}
    one = rows["https://f/1"]
    assert (one.title, one.description, one.source, one.source_type) == ("One & only", "A <b>bold</b> text", "f", "rss")
    assert (one.authors, one.categories) == (["ann@x", "Ann"], ["Politics", "World"])
    assert one.published == "Mon, 01 Jan 2024 12:00:00 GMT" and one.published_time == datetime(2024, 1, 1, 12)
    two = rows["https://f/2"]
    assert (two.title, two.published, two.published_time, two.authors, two.description) == ("Новости", "", None, [], "")


def test_atom(spark):
    df = spark.createDataFrame([("a", ATOM)], "source string, xml string")
    row = feeds.feed_articles(df, fetched(), kind="atom").first()
    assert (row.title, row.link, row.description) == ("Entry", "https://a/1", "S")
    assert (row.authors, row.categories, row.published_time) == (["Bo", "Cy"], ["tech", "web"], datetime(2024, 1, 1, 10))


def test_feed_files(spark, folder):
    with open(f"{folder}/north.xml", "w") as f:
        f.write(RSS)
    with open(f"{folder}/other.xml", "w") as f:
        f.write(RSS)
    rows = feeds.read_feeds(spark, folder, fetched()).collect()
    assert sorted((r.source, r.link) for r in rows if r.link) == [
        (s, link) for s in ("north", "other") for link in ("https://f/1", "https://f/2")
    ]
    os.makedirs(f"{folder}/atom")
    with open(f"{folder}/atom/a.xml", "w") as f:
        f.write(ATOM)
    assert feeds.read_feeds(spark, f"{folder}/atom", fetched(), "atom").first().link == "https://a/1"


def page(body):
    return f"<html><body><nav><h2>Nav</h2><a href='/nav'>n</a></nav>{body}</body></html>"


FLAT = [
    ("two blocks", page("<article><h2> One </h2><a href='/1'>x</a></article><article><h3>Two</h3><a href='https://o/2'>x</a></article>"),
     [(0, "One", "https://s.test/1"), (1, "Two", "https://o/2")]),
    ("no link", page("<article><h2>One</h2></article>"), []),
    ("no title", page("<article><a href='/1'>x</a></article>"), []),
    ("first anchor lacks href", page("<article><h2>One</h2><a name='x'>x</a><a href='/1'>y</a></article>"), []),
    ("divs", page("<div class='big news-item'><h4>N</h4><a href=/n>x</a></div><div class='promo'><h1>P</h1><a href='/p'>x</a></div>"
                  "<div class='other'><h1>O</h1><a href='/o'>x</a></div>"),
     [(0, "N", "https://s.test/n"), (1, "P", "https://s.test/p")]),
    ("heading class", page("<article><a class='card-heading' href='/h?a=1&amp;b=2'>H &amp; <b>more</b></a></article>"),
     [(0, "H & more", "https://s.test/h?a=1&b=2")]),
    ("cap counts blocks", page("<article><p>x</p></article>" * 9 + "<article><h1>T</h1><a href='/t'>x</a></article>" * 3),
     [(9, "T", "https://s.test/t")]),
    ("hidden markup", page("<!-- <article><h1>C</h1><a href='/c'>x</a></article> --><script>'<article>'</script>"), []),
    ("upper case", page("<ARTICLE><H1>U</H1><A HREF='/u'>x</A></ARTICLE>"), [(0, "U", "https://s.test/u")]),
    ("never closed", "<nav></nav><article><h2>Open</h2><a href='/o'>x</a>", [(0, "Open", "https://s.test/o")]),
    ("open comment", page("<article><h2>One</h2><a href='/1'>x</a></article><!-- <article>"), [(0, "One", "https://s.test/1")]),
    ("stray end tags", page("</div></p><article></span><h2>One</h2><a href='/1'>x</a></article>"), [(0, "One", "https://s.test/1")]),
    ("many openers", "<article>" + "<div>" * 50_000 + "<!--" * 50_000, []),
    ("many stray ends", "<p>" * 50_000 + "</b>" * 50_000, []),
    ("empty", "", []),
    ("absent", None, []),
]
NESTED = [
    ("block in block", page("<div class='news'><article><h2>In</h2><a href='/in'>x</a></article><a href='/later'>y</a></div>"),
     [(0, "In", "https://s.test/in"), (1, "In", "https://s.test/in")]),
    ("div in div", page("<div class='promo'><div><span>s</span></div><h3>Far</h3><a href='/far'>x</a></div><h3>Out</h3>"),
     [(0, "Far", "https://s.test/far")]),
    ("image block, bare class", page("<div class=gs-promo><div class=img>i</div><h3>Caf&eacute; &#8212; x</h3><a href=/s>t</a></div>"),
     [(0, "Café — x", "https://s.test/s")]),
    ("void and unclosed", page("<article><img src=x><p>a<p>b<h2>T<br>U</h2><a href='/x'>x</a></article>"), [(0, "TU", "https://s.test/x")]),
]


def found(df):
    out = {}
    for r in df.orderBy("pos").collect():
        out.setdefault(r.name, []).append((r.pos, r.title, r.link))
    return out


def test_pages(spark):
    cases = FLAT + NESTED
    df = spark.createDataFrame([(n, "https://s.test/list?x", h) for n, h, _ in cases], "name string, url string, html string")
    assert found(pages.page_articles(df, fetched(), ["name"])) == {n: w for n, _, w in cases if w}


def test_page_link_fallback(spark):
    df = spark.createDataFrame([("p", "https://s.test/a", page("<article><h2>One</h2></article>"))], "name string, url string, html string")
    row = pages.page_articles(df, fetched(), ["name"], link_fallback="page_url").first()
    assert (row.title, row.link, row.source_type, row.description) == ("One", "https://s.test/a", "html", "")


GO = {"source": "North", "source_type": "rss", "title": "T", "link": "https://l/1", "description": "D",
      "published": "Mon, 01 Jan 2024 12:00:00 +0300", "published_time": "2024-01-01T09:00:00Z", "authors": ["Ann"],
      "categories": ["Politics", "World"], "scraped_at": "2024-01-01T12:00:00.123456789Z"}
HTML = {**GO, "source_type": "html", "authors": None, "categories": None, "published": "", "published_time": "0001-01-01T00:00:00Z"}
PY = {"source": "South", "source_type": "rss", "title": "T", "link": "https://r/1", "description": "D", "published": "2024-01-01T08:00:00",
      "published_parsed": [2024, 1, 1, 9, 0, 0, 0, 1, 0], "authors": [{"name": "Bo"}],
      "categories": [{"term": "Politics", "scheme": None}, "plain", 5], "scraped_at": "2024-01-01T12:00:00.5"}


def test_json_store(spark, folder):
    with open(f"{folder}/a.json", "w") as f:
        json.dump([GO, HTML, PY], f)
    with open(f"{folder}/b.json", "w") as f:
        f.write("[{\"source\": ")
    good, bad = json_store.read_articles(spark, folder)
    rows = {(r.source, r.source_type): r for r in good.collect()}
    assert len(rows) == 3 and [r.file_path.endswith("b.json") for r in bad.collect()] == [True]
    go, html, py = rows["North", "rss"], rows["North", "html"], rows["South", "rss"]
    assert go.scraped_at == datetime(2024, 1, 1, 12, 0, 0, 123456) and go.published_time == datetime(2024, 1, 1, 9)
    assert (html.categories, html.authors, html.published_time) == ([], [], None)
    assert (py.categories, py.authors) == (["Politics", "plain", "5"], ["Bo"])
    assert (py.scraped_at, py.published_time) == (datetime(2024, 1, 1, 12, 0, 0, 500000), datetime(2024, 1, 1, 9))


def test_json_append_keeps_duplicates(spark, folder):
    df = frame(spark, [article(1, 5), article(2, 6)])
    for _ in range(2):
        json_store.append_articles(df, f"{folder}/s", compression="gzip")
    good, bad = json_store.read_articles(spark, f"{folder}/s", arrays=False)
    assert (good.count(), bad.count()) == (4, 0)


def test_messages(spark):
    texts = [json.dumps(GO), json.dumps(PY), '{"source": "x"', "not json", "[1]", "5", '"text"', "", None, json.dumps({"title": "only"})]
    df = spark.createDataFrame(
        [("news", i % 2, i, datetime(2024, 1, 1), None if t is None else bytearray(t, "utf-8")) for i, t in enumerate(texts)]
        + [("news", 0, 99, datetime(2024, 1, 1), bytearray(b'{"title": "\xff"}'))],
        "topic string, partition int, offset long, timestamp timestamp, value binary",
    )
    rows = messages.decode_messages(df).collect()
    assert sorted(r._meta.offset for r in rows) == [0, 1, 9]
    assert {r._meta.offset: r.categories for r in rows}[1] == ["Politics", "plain", "5"]
    assert sorted(r._meta.offset for r in messages.dead_letters(df).collect()) == [2, 3, 4, 5, 6, 7, 8, 99]


def test_nats_envelope(spark):
    df = spark.createDataFrame([("news.articles", "r", "t", json.dumps(GO))], "subject string, reply string, timestamp string, value string")
    assert messages.decode_messages(df, messages.NATS_META).first()._meta.subject == messages.SUBJECT


def test_publish_and_decode_round_trip(spark):
    df = frame(spark, [article(i, i, title=f"t{i} ü") for i in range(5)])
    out = messages.to_messages(df, beside=("doc_id",))
    assert [(h.key, bytes(h.value)) for h in out.first().headers] == [("source", b"a"), ("source_type", b"rss")]
    back = messages.decode_messages(out.withColumn("offset", F.col("doc_id")))
    assert values(back, "_meta.offset", "title", "link") == values(df, "doc_id", "title", "link")
    assert messages.kafka_options("s", "zstd")["kafka.compression.type"] == "none"
    assert messages.kafka_options("s", "lz4")["kafka.acks"] == "all"


def test_event_time_and_defaults(spark):
    rows = [dict(GO), {**GO, "scraped_at": "yesterday"}, {"published": "2024-01-01T08:00:00Z"}, {"published": "Mon"}, {}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "offset long, value string")
    timed = art.with_event_time(messages.decode_messages(df), fetched())
    good, rejects = art.split_by_event_time(art.fill_defaults(timed))
    got = {r._meta.offset: r for r in good.collect()}
    assert [got[i].ts for i in (0, 2, 3, 4)] == [datetime(2024, 1, 1, 12, 0, 0, 123456), datetime(2024, 1, 1, 8), datetime(2024, 1, 2), datetime(2024, 1, 2)]
    assert [r._meta.offset for r in rejects.collect()] == [1]
    assert (got[4].source, got[4].title, got[4].description, got[4].categories) == ("unknown", "", "", [])


def test_route_and_gather(spark):
    df = spark.createDataFrame([("a", "rss"), ("b", "html"), ("c", "atom"), ("d", None)], "url string, type string")
    frames = art.route(df)
    assert {k: v.count() for k, v in frames.items()} == {"rss": 1, "html": 1, "rejects": 2}
    both = art.gather([frames["rss"], frames["html"].drop("type").withColumn("x", F.lit(1)), frames["rss"]])
    assert both.count() == 3 and set(both.columns) == {"url", "type", "x"}


def test_unique_links_keep_the_first(spark):
    rows = [article(i, 100 - i, link=f"l{i % 3}") for i in range(60)]
    got = art.unique_links(frame(spark, rows).repartition(5), [F.asc("ts"), F.asc("doc_id")])
    assert values(got, "doc_id") == [(57,), (58,), (59,)]


def test_window_store(spark, folder):
    spec = WindowSpec.tumbling(3600)
    df = frame(spark, [article(i, i * 1800, source="ab"[i % 2]) for i in range(200)])
    stats = windows.window_stats(df, spec)
    window_store.store(stats, f"{folder}/w")
    part = window_store.read_windows(spark, f"{folder}/w", F.lit(at(86400)).cast("timestamp"), F.lit(at(86400 + 7200)).cast("timestamp"))
    assert values(part, "window_start", "total_articles") == [(at(86400), 2), (at(90000), 2)]
    assert all("day=2024-01-02" in f for f in part.inputFiles())
    assert "PushedFilters: [IsNotNull(window_" in part._jdf.queryExecution().executedPlan().toString()
    by_source = window_store.columnar_by_source(stats, windows.window_key_counts(df, spec, ("source",)))
    view = window_store.columnar_from_view(windows.window_view(df, spec, rounded=False))
    assert by_source.columns == view.columns == [*window_store.EXPORT_COLUMNS, "source", "source_count"]
    assert by_source.dtypes == view.dtypes and values(by_source, *view.columns) == values(view, *view.columns)


def test_run_files(spark, folder):
    run = {"iteration": 1, "execution_time_seconds": 2.0, "avg_cpu_percent": 20.0, "max_cpu_percent": 30.0,
           "avg_memory_mb": 40.0, "max_memory_mb": 50.0, "exit_code": 0, "timestamp": "2024-01-01T00:00:00"}
    for name, seconds, when in [("go_scraper_metrics_1.json", 9.0, 2000), ("go_scraper_metrics_2.json", 2.0, 3000),
                                ("python_scraper_metrics.json", 5.0, 1000), ("notes.json", 1.0, 9000)]:
        with open(f"{folder}/{name}", "w") as f:
            json.dump({"runs": [{**run, "execution_time_seconds": seconds}], "summary": {"avg_execution_time": seconds}}, f, indent=2)
        os.utime(f"{folder}/{name}", (when, when))
    files = run_files.latest_run_files(spark, folder)
    assert values(run_files.summaries_of(files), "scraper", "avg_execution_time") == [("go", 2.0), ("python", 5.0)]
    assert values(run_files.runs_of(files), "scraper", "execution_time_seconds") == [("go", 2.0), ("python", 5.0)]
    loaded = run_files.runs_of(files)
    run_files.write_run_file(loaded, runs.run_summary(loaded), f"{folder}/out", "go", "20240101")
    again = run_files.latest_run_files(spark, f"{folder}/out/*")
    assert values(run_files.summaries_of(again), "scraper", "avg_execution_time") == [("go", 2.0)]


def test_only_the_newest_run_file_is_parsed(spark, folder):
    from broadsheet.schema import RUN

    rows = [("go" if i % 2 else "python", i, float(i), 1.0, 2.0, 3.0, 4.0, 0, "t", i // 10) for i in range(40)]
    columns = "scraper string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RUN) + ", session long"
    df = spark.createDataFrame(rows, columns)
    for k in (0, 1, 3, 2):
        run_files.write_run_files(df.filter(F.col("session") == k), f"{folder}/runs")
    for name in ("go_scraper_metrics_0.json", "python_scraper_metrics_1.json"):  # unreadable, but old
        os.makedirs(f"{folder}/runs/{name}", exist_ok=True)
        with open(f"{folder}/runs/{name}/x.json", "w") as f:
            f.write("{")
        os.utime(f"{folder}/runs/{name}/x.json", (1000, 1000))
    found = run_files.latest_run_files(spark, f"{folder}/runs")
    assert values(run_files.runs_of(found), "scraper", "iteration") == order([("go" if i % 2 else "python", i) for i in range(20, 30)])
    assert len(found.inputFiles()) == 2


def test_broken_feeds_are_told(spark):
    good = "<rss><channel><title>f</title><item><title>a</title><link>l</link></item></channel></rss>"
    docs = [(1, good), (2, good[:-9]), (3, "no feed <"), (4, None), (5, ""), (6, good.replace("<item>", "<item><item>"))]
    parsed = feeds.parse_feeds(spark.createDataFrame(docs, "id int, xml string"))
    assert values(feeds.articles_of(parsed, fetched(), ["id"]), "id", "title") == [(1, "a")]
    assert {2, 3, 6} <= {r["id"] for r in feeds.rejected(parsed).collect()} and 1 not in {r["id"] for r in feeds.rejected(parsed).collect()}
    assert feeds.rejected(parsed).columns == ["id", "xml", "error"]


def stored(store):
    return values(store.read(), "window_start", "analysis_type", "results")


def results(spark, hours, analysis="sliding_window", note="a"):
    rows = [(at(3600 * h), at(3600 * h + 3600), analysis, f"{note}{h}") for h in hours]
    return spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, analysis_type string, results string")


def test_store_merges_by_window_and_type(spark, folder):
    store = window_store.WindowStore(spark, f"{folder}/s")
    assert store.merge(results(spark, range(12)), "early")
    assert store.merge(results(spark, range(12, 30)), "late")  # the other half of the day, and the next
    assert store.merge(results(spark, range(6), "other"), "other type")
    want = stored(store)
    assert len(want) == 36
    for batch in ("early", "late", "other type"):
        assert not store.merge(results(spark, range(12), note="again"), batch)
        assert stored(store) == want
    store.merge(results(spark, [3, 27, 50], note="b"), "corrected")
    got = {(w, t): r for w, t, r in stored(store)}
    assert len(got) == 37 and {r for r in got.values() if r[0] == "b"} == {"b3", "b27", "b50"}
    assert got[(at(3 * 3600), "other")] == "a3"
    store.merge(results(spark, []), "empty")
    assert not store.merge(results(spark, [1], note="c"), "empty") and len(stored(store)) == 37
    assert store.read(F.lit(at(86400)).cast("timestamp"), F.lit(at(86400 + 7200)).cast("timestamp")).count() == 2
    # other types may bring other columns, and no type at all
    store.merge(results(spark, [4]).withColumn("extra", F.lit(1)).withColumn("analysis_type", F.lit(None).cast("string")), "wide")
    assert store.read().filter("extra = 1").count() == 1 and store.read().count() == 38
    store.merge(results(spark, [4], note="d").withColumn("analysis_type", F.lit(None).cast("string")), "wide again")
    assert store.read().count() == 38


def test_empty_store(spark, folder):
    store = window_store.WindowStore(spark, f"{folder}/none")
    with pytest.raises(ValueError):
        store.read()
    store.merge(results(spark, []), "nothing")
    assert store.read().count() == 0 and store.retain(3) == [] and store.vacuum() == 0


def test_failed_batch_leaves_the_store_as_it_is(spark, folder):
    store = window_store.WindowStore(spark, f"{folder}/s")
    store.merge(results(spark, range(3)), "one")
    want = stored(store)
    broken = results(spark, range(5)).withColumn("results", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.merge(broken, "two")
    assert stored(store) == want
    assert store.merge(results(spark, range(3, 5)), "two") and len(stored(store)) == 5


def test_retention_beside_a_reader(spark, folder):
    store = window_store.WindowStore(spark, f"{folder}/s")
    store.merge(results(spark, range(0, 96, 2)), "even")
    store.merge(results(spark, range(1, 96, 2)), "odd")
    reader = store.read()
    assert [str(d) for d in store.retain(25)] == ["2024-01-01", "2024-01-02"]
    assert store.vacuum(commits=3) == 0 and reader.count() == 96  # the old state is still there
    assert store.read().count() == 48 and store.retain(25) == []
    assert store.vacuum(commits=0) == 6 and store.read().count() == 48
    store.merge(results(spark, [5]), "a dropped day comes back")
    assert store.read().count() == 49 and store.vacuum(commits=0) == 0


def test_store_as_the_sink_of_a_stream(spark, folder):
    sink = window_store.store_sink(f"{folder}/s", "q")
    for _ in range(2):  # a batch is delivered twice
        sink(results(spark, range(3)), 0)
    sink(results(spark, range(2, 5), note="b"), 1)
    assert [r for _, _, r in stored(window_store.WindowStore(spark, f"{folder}/s"))] == ["a0", "a1", "b2", "b3", "b4"]


def test_json_keeps_microseconds(spark, folder):
    df = frame(spark, [article(1, 0.123456)]).drop("doc_id").withColumnRenamed("ts", "scraped_at")
    json_store.append_articles(df, f"{folder}/micro")
    good, _ = json_store.read_articles(spark, f"{folder}/micro", arrays=False)
    assert good.first()["scraped_at"].microsecond == 123456


def test_null_keys_leave_the_view_alone(spark):
    from broadsheet.config import WindowSpec
    from broadsheet.operators import windows as win

    rows = [article(1, 0, categories=["x", None]), article(2, 1, source=None)]
    view = win.window_view(frame(spark, rows), WindowSpec.tumbling(60), rounded=False).collect()
    assert len(view) == 1 and view[0]["total_articles"] == 2
