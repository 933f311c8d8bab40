"""Streams fed in several micro-batches, against the batch operators."""

import json
from datetime import datetime

import pytest
from helpers import ARTICLE, article, at, frame, order, values
from pyspark.sql import functions as F
from test_windows import table

from broadsheet.config import StreamSpec, WindowSpec
from broadsheet.operators import articles as art
from broadsheet.operators import counters, windows
from broadsheet.session import settings, state_settings
from broadsheet.sources import messages
from broadsheet.streaming import count_windows as counting
from broadsheet.streaming import ordered, running, sinks
from broadsheet.streaming import windows as streams

STATS = ["window_start", "window_end", "total_articles", "sources_count", "avg_title_length", "rate_per_min", "last_article_at", "rate_per_sec"]


def write_files(spark, folder, chunks):
    """One input file per chunk, in order of arrival."""
    for i, rows in enumerate(chunks):
        frame(spark, rows).coalesce(1).write.parquet(f"{folder}/in/{i:03d}")


def stream(spark, folder):
    return (
        spark.readStream.schema(ARTICLE).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
        .parquet(f"{folder}/in/*")
    )


def run(spark, df, folder, name="q"):
    with settings(spark, state_settings(spark.sparkContext.defaultParallelism)):
        q = streams.write_table(df, f"{folder}/{name}", f"{folder}/{name}-checkpoint")
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}"), q


def in_order(n=300, parts=5):
    rows = sorted(table(n), key=lambda r: (r[7], r[0]))
    size = -(-len(rows) // parts)
    return rows, [rows[k : k + size] for k in range(0, len(rows), size)]


@pytest.mark.parametrize("spec", [WindowSpec(), WindowSpec.tumbling(60)])
def test_closed_and_open_windows_equal_the_batch(spark, folder, spec):
    rows, chunks = in_order()
    write_files(spark, folder, chunks)
    closed, q = run(spark, streams.stream_window_stats(stream(spark, folder), spec), folder)
    until = streams.closed_until(q, closed)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == len(chunks)
    batch = windows.window_stats(frame(spark, rows), spec)
    stop = F.lit(until).cast("timestamp")
    assert values(closed, *STATS) == values(batch.filter(F.col("window_end") <= stop), *STATS)
    tail = streams.finalize(frame(spark, rows), spec, until)
    assert tail.count() > 0
    assert values(closed.unionByName(tail), *STATS) == values(batch, *STATS)


def test_key_counts_equal_the_batch(spark, folder):
    rows, chunks = in_order()
    write_files(spark, folder, chunks)
    spec, kinds = WindowSpec(), ("source", "source_type", "category", "keyword")
    closed, q = run(spark, streams.stream_key_counts(stream(spark, folder), spec, kinds), folder)
    tail = streams.finalize_key_counts(frame(spark, rows), spec, kinds, streams.closed_until(q, closed))
    columns = ["window_start", "kind", "key", "n"]
    assert values(art.gather([closed, tail]), *columns) == values(windows.window_key_counts(frame(spark, rows), spec), *columns)


@pytest.mark.parametrize("kinds", [("keyword",), ("source", "category")])
def test_windows_of_closed_panes_are_those_of_the_stream(spark, folder, kinds):
    """Panes are the only state; the windows summed from them are those that the stream itself would close."""
    rows, chunks = in_order()
    write_files(spark, folder, chunks)
    spec, columns = WindowSpec(), ["window_start", "window_end", "kind", "key", "n"]
    panes, q = run(spark, streams.stream_key_counts(stream(spark, folder), spec, kinds, panes=True), folder)
    assert len(q.lastProgress["stateOperators"]) == 1
    until = streams.closed_until(q, panes, F.col("pane") + F.expr("INTERVAL 60 SECONDS"))
    closed = streams.closed_key_counts(panes, spec, until)
    emitted, _ = run(spark, streams.stream_key_counts(stream(spark, folder), spec, kinds), folder, "windows")
    assert values(closed, *columns) == values(emitted, *columns) and closed.count() > 0
    tail = streams.finalize_key_counts(frame(spark, rows), spec, kinds, until)
    assert values(art.gather([closed, tail]), *columns) == values(windows.window_key_counts(frame(spark, rows), spec, kinds), *columns)


def test_late_rows_are_not_counted(spark, folder):
    chunks = [[article(1, 10), article(2, 400)], [article(3, 700)], [article(4, 20), article(5, 710)], [article(6, 2000)], [article(7, 2001)]]
    write_files(spark, folder, chunks)
    closed, q = run(spark, streams.stream_window_stats(stream(spark, folder), WindowSpec.tumbling(60)), folder)
    assert values(closed, "window_start", "total_articles") == [(at(0), 1), (at(360), 1), (at(660), 2)]
    assert sinks.counters(q)["query"]["dropped_late"] == 1


def test_restart_goes_on_where_it_stopped(spark, folder):
    rows, chunks = in_order()
    write_files(spark, folder, chunks[:3])
    spec = WindowSpec.tumbling(60)
    run(spark, streams.stream_window_stats(stream(spark, folder), spec), folder)
    for i, part in enumerate(chunks[3:], 3):
        frame(spark, part).coalesce(1).write.parquet(f"{folder}/in/{i:03d}")
    closed, q = run(spark, streams.stream_window_stats(stream(spark, folder), spec), folder)
    tail = streams.finalize(frame(spark, rows), spec, streams.closed_until(q, closed))
    assert values(closed.unionByName(tail), *STATS) == values(windows.window_stats(frame(spark, rows), spec), *STATS)


def test_count_windows_over_batches(spark, folder):
    rows, chunks = in_order(200, 4)
    write_files(spark, folder, chunks)
    closed, _ = run(spark, counting.count_windows(stream(spark, folder), 7, ["source"]), folder)
    per_source = {s: sum(1 for r in rows if r[1] == s) for s in {r[1] for r in rows}}
    got = values(closed, "source", "window_no", "total_articles", "closed")
    assert got == order([(s, k, 7, True) for s, n in per_source.items() for k in range(n // 7)])


def test_count_windows_in_order_equal_the_batch(spark, folder):
    rows = [article(i, i, source="ab"[i % 2], title="é" * (i % 5)) for i in range(60)]
    write_files(spark, folder, [rows[:13], rows[13:14], rows[14:55], rows[55:]])
    closed, _ = run(spark, counting.count_windows(stream(spark, folder), 7, ["source"]), folder)
    columns = ["source", "window_no", "total_articles", "avg_title_length", "avg_description_length", "first_article_at", "last_article_at"]
    batch = windows.count_windows(frame(spark, rows), 7, ["source"], "doc_id").filter("closed")
    assert values(closed, *columns) == values(batch, *columns)


def test_count_windows_read_null_texts_as_empty(spark, folder):
    rows = [article(i, i, source="a", title=None if i % 2 else "abc") for i in range(8)]
    write_files(spark, folder, [rows[:3], rows[3:]])
    closed, _ = run(spark, counting.count_windows(stream(spark, folder), 4, ["source"]), folder)
    assert values(closed, "window_no", "avg_title_length") == [(0, 1.5), (1, 1.5)]


def test_unique_links_on_a_stream(spark, folder):
    rows = [article(i, i, link=f"l{i % 4}") for i in range(40)]
    write_files(spark, folder, [rows[:20], rows[20:]])
    got, _ = run(spark, streams.stream_unique_links(stream(spark, folder), "1 hour"), folder)
    assert values(got, "link") == [(f"l{k}",) for k in range(4)]


def test_messages_to_windows(spark, folder):
    """Broker bytes to window rows, malformed messages aside."""
    texts = [json.dumps({"source": "s", "title": f"t{i}", "scraped_at": at(i * 20).isoformat()}) for i in range(30)] + ["{broken"]
    rows = [(i, datetime(2024, 1, 1), bytearray(t, "utf-8")) for i, t in enumerate(texts)]
    schema = "offset long, timestamp timestamp, value binary"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in")
    raw = spark.readStream.schema(schema).parquet(f"{folder}/in")
    timed = art.with_event_time(art.fill_defaults(messages.decode_messages(raw)), F.current_timestamp())
    good, _ = art.split_by_event_time(timed)
    closed, _ = run(spark, streams.stream_window_stats(good, WindowSpec.tumbling(60)), folder)
    assert values(closed, "window_start", "total_articles") == [(at(60 * k), 3) for k in range(8)]
    letters, _ = run(spark, messages.dead_letters(raw).select("value"), folder, "dead")
    assert values(letters, "value") == [("{broken",)]


def batches(spark, folder, sink, chunks, name="s"):
    write_files(spark, folder, chunks)
    q = sinks.start(stream(spark, folder), sink, f"{folder}/{name}-checkpoint")
    q.awaitTermination()
    return q


CHUNKS = [[article(i, i) for i in range(4)], [article(i, i) for i in range(4, 9)]]


def refuse(batch):
    raise ConnectionError("down")


def test_delivery_keeps_a_backup_when_taken(spark, folder):
    taken = sinks.parquet_sink(f"{folder}/taken")
    sink = sinks.delivery(lambda b: taken(b, b.count()), sinks.parquet_sink(f"{folder}/kept"), f"{folder}/out")
    batches(spark, folder, sink, CHUNKS)
    assert sinks.read_batches(spark, f"{folder}/kept").count() == 9
    assert spark.read.parquet(f"{folder}/taken").count() == 9


def test_delivery_falls_back_to_rows(spark, folder):
    def send(row):
        if row["doc_id"] % 2:
            raise ValueError("odd")

    sink = sinks.delivery(refuse, sinks.parquet_sink(f"{folder}/kept"), f"{folder}/out", send, backup=False)
    batches(spark, folder, sink, CHUNKS)
    out = spark.read.parquet(f"{folder}/out")
    assert sorted((r.link[-1], r.delivered) for r in out.collect()) == [(str(i), i % 2 == 0) for i in range(9)]
    # the rows the sender refused are kept although nothing is backed up
    assert sorted(r["doc_id"] for r in sinks.read_batches(spark, f"{folder}/kept").collect()) == [1, 3, 5, 7]


def test_delivery_stores_what_nobody_took(spark, folder):
    def send(row):
        raise ValueError("no")

    sink = sinks.delivery(refuse, sinks.json_sink(f"{folder}/kept"), f"{folder}/out", send, backup=False)
    batches(spark, folder, sink, CHUNKS)
    assert spark.read.schema(ARTICLE).json(f"{folder}/kept").count() == 9


def test_retried_batch_replaces_itself(spark, folder):
    sink = sinks.parquet_sink(f"{folder}/kept")
    for _ in range(2):
        sink(frame(spark, CHUNKS[0]), 5)
    assert sinks.read_batches(spark, f"{folder}/kept").count() == 4


def test_every_sink_gets_every_batch_and_callbacks_may_fail(spark, folder):
    seen = []

    def broken(batch, batch_id):
        raise RuntimeError("callback")

    sink = sinks.fan_out(
        sinks.callback(broken), sinks.callback(lambda b, i: seen.append(b.count())),
        sinks.parquet_sink(f"{folder}/a"), sinks.json_sink(f"{folder}/b"),
    )
    batches(spark, folder, sink, CHUNKS)
    assert sorted(seen) == [4, 5]
    assert spark.read.parquet(f"{folder}/a").count() == spark.read.schema(ARTICLE).json(f"{folder}/b").count() == 9


def test_counters(spark, folder):
    write_files(spark, folder, CHUNKS)
    counted = counters.observed(stream(spark, folder), "stage", F.col("doc_id") > 2)
    q = sinks.start(counted, sinks.parquet_sink(f"{folder}/k"), f"{folder}/c")
    q.awaitTermination()
    got = sinks.counters(q)
    assert got["stage"] == {"rows": 9, "accepted": 6, "refused": 3}
    assert got["query"]["input_rows"] == 9


def test_capped_windows_as_they_close(spark, folder):
    rows, chunks = in_order(120, 3)
    write_files(spark, folder, chunks)
    spec = WindowSpec.tumbling(60, max_articles=2)
    stored = frame(spark, rows)

    def sink(closed, batch_id):
        capped = streams.capped_closed_windows(closed, stored, spec, "doc_id")
        capped.write.mode("overwrite").parquet(sinks.batch_path(f"{folder}/capped", batch_id))

    stats = streams.stream_window_stats(stream(spark, folder), spec)
    with settings(spark, state_settings(spark.sparkContext.defaultParallelism)):
        q = sinks.start(stats, sink, f"{folder}/checkpoint")
    q.awaitTermination()
    got = sinks.read_batches(spark, f"{folder}/capped")
    until = F.lit(streams.closed_until(q, got)).cast("timestamp")
    want = windows.capped_window_stats(stored, spec, "doc_id").filter(F.col("window_end") <= until)
    assert values(got, "window_start", "total_articles", "avg_title_length") == values(want, "window_start", "total_articles", "avg_title_length")


def test_named_aggregators(spark, folder):
    rows, chunks = in_order(60, 2)
    write_files(spark, folder, chunks)
    specs = {"minute": WindowSpec.tumbling(60), "sliding": WindowSpec()}
    for name, df in streams.aggregators(stream(spark, folder), specs, StreamSpec(watermark="10 seconds")).items():
        closed, q = run(spark, df, folder, name)
        tail = streams.finalize(frame(spark, rows), specs[name], streams.closed_until(q, closed))
        assert values(closed.unionByName(tail), *STATS) == values(windows.window_stats(frame(spark, rows), specs[name]), *STATS)


def test_restart_without_input_counts_nothing_twice(spark, folder):
    rows, chunks = in_order()
    write_files(spark, folder, chunks)
    spec = WindowSpec.tumbling(60)
    for _ in range(2):
        closed, q = run(spark, streams.stream_window_stats(stream(spark, folder), spec), folder)
    tail = streams.finalize(frame(spark, rows), spec, streams.closed_until(q, closed))
    assert values(art.gather([closed, tail]), *STATS) == values(windows.window_stats(frame(spark, rows), spec), *STATS)


def test_refused_rows_are_kept(spark, folder):
    def refuse(batch):
        raise ConnectionError

    def send(row):
        if row["link"].endswith("1"):
            raise ValueError("refused")

    sink = sinks.delivery(refuse, sinks.parquet_sink(f"{folder}/kept"), f"{folder}/out", send=send, backup=False)
    sink(frame(spark, [article(i, i) for i in range(3)]), 0)
    assert [r["doc_id"] for r in sinks.read_batches(spark, f"{folder}/kept").collect()] == [1]


def test_totals_count_every_batch():
    class Event:
        def __init__(self, **kw):
            self.__dict__.update(kw)

    totals = sinks.Totals()
    for k in range(250):
        state = [Event(numRowsDroppedByWatermark=k % 2)]
        totals.onQueryProgress(Event(progress=Event(id="q", numInputRows=3, stateOperators=state, observedMetrics={"m": {"n": 2}})))
    assert totals.of(Event(id="q")) == {"query": {"batches": 250, "input_rows": 750, "dropped_late": 125}, "m": {"n": 500}}


def shuffled(n=240, reach=40):
    """Articles one minute apart that arrive out of order, but never ``reach`` minutes late; every third is of one source."""
    rows = [article(i, 60 * (i // 2), source="hot" if i % 3 == 0 else "abc"[i % 7 % 3], title="é" * (i % 5)) for i in range(n)]
    rows = sorted(rows, key=lambda r: (r[7].minute * 7 + r[0] * 13) % reach + (r[7] - at(0)).total_seconds() / 60)
    size = -(-n // 5)
    return rows, [rows[k : k + size] for k in range(0, n, size)]


COUNTED = ["source", "shard", "window_no", "total_articles", "avg_title_length", "avg_description_length", "first_article_at", "last_article_at", "closed"]


@pytest.mark.parametrize("shards", [1, 3])
def test_ordered_count_windows_do_not_depend_on_arrival(spark, folder, shards):
    rows, chunks = shuffled()
    write_files(spark, folder, chunks)
    keys = ["source", ordered.SHARD]
    shared = ordered.with_shards(stream(spark, folder), shards, "doc_id")
    closed, q = run(spark, ordered.ordered_count_windows(shared, 7, keys, "doc_id", stream=StreamSpec("60 minutes")), folder)
    stored = ordered.with_shards(frame(spark, rows), shards, "doc_id")
    batch = windows.count_windows(stored, 7, keys, "doc_id")
    until = F.lit(streams.closed_until(q, closed, "last_article_at")).cast("timestamp")
    assert closed.count() > 5
    assert values(closed, *COUNTED) == values(batch.filter("closed").filter(F.col("last_article_at") <= until), *COUNTED)
    left = ordered.open_count_windows(stored, closed, 7, keys, "doc_id")
    assert values(closed.unionByName(left), *COUNTED) == values(batch, *COUNTED)


def test_ordered_count_windows_over_a_restart(spark, folder):
    rows, chunks = shuffled()
    wait = StreamSpec("60 minutes")
    for part in (chunks[:2], chunks[2:]):
        for c in part:
            frame(spark, c).coalesce(1).write.parquet(f"{folder}/in/{chunks.index(c):03d}")
        df = ordered.ordered_count_windows(ordered.with_shards(stream(spark, folder), 1), 5, ["source"], "doc_id", stream=wait)
        closed, q = run(spark, df, folder)
    batch = windows.count_windows(frame(spark, rows), 5, ["source"], "doc_id").filter("closed")
    until = F.lit(streams.closed_until(q, closed, "last_article_at")).cast("timestamp")
    columns = [c for c in COUNTED if c != "shard"]
    assert values(closed, *columns) == values(batch.filter(F.col("last_article_at") <= until), *columns)


def test_ordered_count_windows_edge_rows(spark, folder):
    rows = [article(i, 10, source=None, title=None) for i in range(12)] + [article(-5, 10, source=None), article(50, 9000), article(51, 20000)]
    write_files(spark, folder, [rows[:6], rows[6:], [article(61, 20001)], [article(60, 5, source=None), article(62, 20002)]])
    df = ordered.ordered_count_windows(stream(spark, folder), 6, ["source"], "doc_id")
    closed, q = run(spark, df, folder)
    # equal times go by the tie column, below zero first; the late article is not counted
    assert values(closed, "source", "window_no", "total_articles", "avg_title_length") == [(None, 0, 6, 15 / 6), (None, 1, 6, 0.0)]
    assert sinks.counters(q)["query"]["dropped_late"] == 1


@pytest.mark.parametrize("spec", [WindowSpec(600, 120, max_articles=3), WindowSpec.tumbling(600, max_articles=5)])
def test_newest_per_pane(spark, folder, spec):
    rows, chunks = shuffled()
    rows = rows + [article(1000 + i, 1234, source="hot") for i in range(60)]  # a pane far above the cap, all of one time
    chunks[1] = chunks[1] + rows[-60:]
    write_files(spark, folder, chunks)
    shared = ordered.with_shards(stream(spark, folder), 3, "doc_id")
    kept, q = run(spark, ordered.newest_per_pane(shared, spec, "doc_id", StreamSpec("60 minutes")), folder)
    assert kept.count() > 0
    most = kept.groupBy("pane", "shard").count().agg(F.max("count")).first()[0]
    assert most == spec.max_articles  # the state never held more
    end = F.col("pane") + F.expr(f"INTERVAL {spec.pane_s} SECONDS")
    left = ordered.stored_newest_per_pane(frame(spark, rows), spec, streams.closed_until(q, kept, end), "doc_id")
    assert left.join(kept, "pane", "left_semi").count() == 0
    got = ordered.windows_of_newest(art.gather([kept, left]), spec)
    df = frame(spark, rows)
    counts = ["window_start", "window_end", "arrived", "kept", "dropped"]
    assert values(got, *counts) == values(windows.dropped_per_window(df, spec), *counts)
    stats = ["window_start", "sources_count", "avg_title_length", "avg_description_length", "rate_per_min", "last_article_at"]
    assert values(got, *stats) == values(windows.capped_window_stats(df, spec, "doc_id"), *stats)


@pytest.mark.parametrize("spec", [WindowSpec(600, 120), WindowSpec.tumbling(600)])
def test_running_windows(spark, folder, spec):
    rows, chunks = shuffled()
    write_files(spark, folder, chunks)
    wait = StreamSpec("10 days")
    updates = running.stream_pane_updates(stream(spark, folder), spec, wait)
    with settings(spark, state_settings(spark.sparkContext.defaultParallelism)):
        running.write_updates(updates, f"{folder}/u", f"{folder}/c", wait).awaitTermination()
    told = running.read_updates(spark, f"{folder}/u", updates)
    columns = ["window_start", "window_end", "total_articles", "sources_count", "avg_title_length", "avg_description_length", "rate_per_min", "last_article_at"]
    final = values(windows.window_stats(frame(spark, rows), spec), *columns)
    versions = running.window_versions(told, spec)
    assert values(running.running_stats(told, spec), *columns) == values(versions.filter("latest"), *columns) == final
    sofar = []
    for k, part in enumerate(chunks):
        sofar += part
        now = values(windows.window_stats(frame(spark, sofar), spec), *columns)
        assert values(running.running_stats(told, spec, as_of=k), *columns) == now
        shown = values(versions.filter(F.col("batch_id") == k), *columns)
        assert shown and set(shown) <= set(now)
    # numbers go up by one within a window
    assert versions.groupBy("window_start").agg((F.max("version") == F.count("version")).alias("ok")).filter("not ok").count() == 0
    # a batch that is written again replaces itself
    again = told.filter("batch_id = 1").drop("batch_id")
    again.write.parquet(f"{folder}/copy")
    sinks.parquet_sink(f"{folder}/u")(spark.read.schema(again.schema).parquet(f"{folder}/copy"), 1)
    assert values(running.running_stats(running.read_updates(spark, f"{folder}/u", updates), spec), *columns) == final
