"""Window operators against brute force over a small table with edges, ties, gaps and a hot source."""

import random
from collections import Counter, defaultdict
from datetime import timedelta

import pytest
from helpers import T0, article, at, frame, order, values
from pyspark.sql import functions as F

from broadsheet.config import WindowSpec, kinds_for
from broadsheet.operators import snapshot, windows
from broadsheet.operators.articles import trailing
from broadsheet.operators.ranking import newest, running_index

SLIDING = WindowSpec()


def table(n=400, seed=3):
    """A third of all rows comes from one source in one minute; some share a time; a gap in the middle."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            source, second = "hot", 600 + rng.randint(0, 59)
        else:
            source = rng.choice("abcd")
            second = rng.choice([rng.randint(0, 1500), rng.randint(4000, 5000), 60 * rng.randint(0, 20)])
        title = " ".join(rng.choices(["Alpha", "beta", "the", "Gamma ray", "Новости", "x"], k=rng.randint(0, 6)))
        rows.append(article(i, second, source, title, rng.choice(["rss", "html"]), categories=rng.sample(["p", "q", "r"], rng.randint(0, 3))))
    return rows


def windows_of(ts, spec):
    start = T0 + timedelta(seconds=(ts - T0).total_seconds() // spec.slide_s * spec.slide_s)
    while start > ts - timedelta(seconds=spec.size_s):
        yield start
        start -= timedelta(seconds=spec.slide_s)


def grouped(rows, spec):
    out = defaultdict(list)
    for r in rows:
        for w in windows_of(r[7], spec):
            out[w].append(r)
    return out


@pytest.mark.parametrize("spec", [SLIDING, WindowSpec.tumbling(60), WindowSpec(420, 180), WindowSpec(300, 60, length_unit="bytes")])
def test_window_stats(spark, spec):
    rows = table()
    size = (lambda t: len(t.encode())) if spec.length_unit == "bytes" else len
    want = []
    for w, members in grouped(rows, spec).items():
        n, last = len(members), max(r[7] for r in members)
        seconds = (last - w).total_seconds()
        want.append(
            (w, w + timedelta(seconds=spec.size_s), n, len({r[1] for r in members}), sum(size(r[3]) for r in members) / n,
             n / spec.minutes, last, n / seconds if seconds else 0.0)
        )
    got = values(
        windows.window_stats(frame(spark, rows), spec), "window_start", "window_end", "total_articles", "sources_count",
        "avg_title_length", "rate_per_min", "last_article_at", "rate_per_sec",
    )
    assert got == order(want)


def test_breakdowns_and_invariants(spark):
    rows = table()
    counts = Counter()
    for w, members in grouped(rows, SLIDING).items():
        for r in members:
            counts[w, "source", r[1]] += 1
            counts[w, "source_type", r[2]] += 1
            counts.update((w, "category", c) for c in r[6])
            counts.update((w, "keyword", k) for k in r[3].lower().split() if len(k) > 3)
    df = windows.window_key_counts(frame(spark, rows), SLIDING)
    got = {(r.window_start, r.kind, r.key): r.n for r in df.collect()}
    assert got == dict(counts)
    # every article is in five windows
    assert sum(n for (_, kind, _), n in got.items() if kind == "source") == 5 * len(rows)


def test_row_on_an_edge_belongs_to_the_window_it_starts(spark):
    df = frame(spark, [article(1, 300), article(2, 299.999999)])
    tumbling = windows.window_stats(df, WindowSpec.tumbling(300))
    assert values(tumbling, "window_start", "total_articles") == [(at(0), 1), (at(300), 1)]


def test_trailing_window_is_closed_at_its_old_edge(spark):
    df = frame(spark, [article(1, 0), article(2, 0.000001), article(3, 300), article(4, -0.000001)])
    now = F.lit(at(300)).cast("timestamp")
    assert values(trailing(df, now), "doc_id") == [(1,), (2,), (3,)]
    row = snapshot.snapshot(df, now).first()
    assert (row.total_articles, row.sources_count, row.rate_per_min) == (3, 1, 3 / 5)
    empty = snapshot.snapshot(df, F.lit(at(9999)).cast("timestamp")).first()
    assert (empty.total_articles, empty.sources_count, empty.avg_title_length, empty.rate_per_min) == (0, 0, 0.0, 0.0)


def test_top_keywords_break_ties_by_word(spark):
    rows = [article(i, i, title=" ".join(f"word{k:02d}" for k in range(12)) + " word11") for i in range(3)]
    counts = windows.window_key_counts(frame(spark, rows), WindowSpec.tumbling(60), ("keyword",))
    got = [(r.rank, r.word, r.frequency) for r in windows.top_keywords(counts).orderBy("rank").collect()]
    assert got == [(1, "word11", 6)] + [(k + 2, f"word{k:02d}", 3) for k in range(9)]


def test_dense_windows_fill_gaps_with_zero(spark):
    spec = WindowSpec()
    df = windows.dense_windows(windows.window_stats(frame(spark, table()), spec), spec)
    got = values(df, "window_start", "total_articles", "avg_title_length")
    sparse = grouped(table(), spec)
    first, last = min(sparse), max(sparse)
    assert len(got) == (last - first).total_seconds() / 60 + 1
    assert {(w, n) for w, n, _ in got if n} == {(w, len(m)) for w, m in sparse.items()}
    assert all(avg == 0 for _, n, avg in got if n == 0) and any(n == 0 for _, n, _ in got)


def test_dense_windows_when_the_slide_does_not_divide_a_day(spark):
    spec = WindowSpec.tumbling(7000)
    rows = [article(1, 10), article(2, 300_000)]
    dense = windows.dense_windows(windows.window_stats(frame(spark, rows), spec), spec)
    starts = sorted(r.window_start for r in dense.collect())
    assert {b - a for a, b in zip(starts, starts[1:])} == {timedelta(seconds=7000)} and len(starts) > 40


@pytest.mark.parametrize("spec", [WindowSpec(max_articles=4), WindowSpec.tumbling(60, max_articles=4)])
def test_cap_keeps_the_newest_rows(spark, spec):
    rows = table()
    df = frame(spark, rows).repartition(7)
    want = []
    for w, members in grouped(rows, spec).items():
        best = sorted(members, key=lambda r: (r[7], r[0]), reverse=True)[:4]
        want += [(w, r[0]) for r in best]
    assert values(windows.newest_in_windows(df, spec, "doc_id"), "window_start", "doc_id") == order(want)
    drops = windows.dropped_per_window(df, spec).collect()
    assert all(r.kept + r.dropped == r.arrived and r.kept <= 4 for r in drops)
    assert sum(r.kept for r in drops) == len(want)
    capped = windows.capped_window_stats(df, spec, "doc_id")
    assert {r.window_start: r.total_articles for r in capped.collect()} == {r.window_start: r.kept for r in drops}


def test_running_index_with_a_hot_key(spark):
    rows = table(900)
    got = running_index(frame(spark, rows), ["source"], ["ts", "doc_id"], partitions=8)
    want = []
    for source in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == source), key=lambda r: (r[7], r[0]))
        want += [(r[0], i + 1) for i, r in enumerate(mine)]
    assert values(got, "doc_id", "rn") == order(want)


def test_running_index_takes_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("k", i) for i in range(5)], "k string, i int")
    got = running_index(df, ["k"], ["i"], partitions=4)
    assert all(r.rn == r.i + 1 for r in got.collect()) and got.count() == 25


def test_newest_is_independent_of_slices(spark):
    df = frame(spark, table()).repartition(9)
    order = [F.desc("ts"), F.desc("doc_id")]
    results = [values(newest(df, ["source"], order, 3, slices=s), "source", "doc_id") for s in (1, 2, 64)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 15


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_count_windows(spark, size):
    rows = table()
    want = []
    for source in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == source), key=lambda r: (r[7], r[0]))
        for k in range(0, len(mine), size):
            part = mine[k : k + size]
            want.append((source, k // size, len(part), part[0][7], part[-1][7], len(part) == size))
    got = windows.count_windows(frame(spark, rows), size, ["source"], "doc_id")
    assert values(got, "source", "window_no", "total_articles", "first_article_at", "last_article_at", "closed") == order(want)


def test_forced_close(spark):
    rows = table()
    spec = WindowSpec.tumbling(60, max_articles=10)
    got = windows.forced_close_windows(frame(spark, rows), spec, "doc_id").collect()
    want = {w: len(m) for w, m in grouped(rows, spec).items()}
    sums = Counter()
    for r in got:
        sums[r.window_start] += r.total_articles
        assert r.total_articles == 10 or r.part == want[r.window_start] // 10
    assert dict(sums) == want


def test_window_view(spark):
    rows = table()
    view = {r.window_start: r for r in windows.window_view(frame(spark, rows), SLIDING).collect()}
    members = grouped(rows, SLIDING)
    assert set(view) == set(members)
    for w, r in view.items():
        assert r.articles_per_source == dict(Counter(m[1] for m in members[w]))
        assert r.articles_per_type == dict(Counter(m[2] for m in members[w]))
        assert r.categories == dict(Counter(c for m in members[w] for c in m[6]))
        assert r.sources == sorted({m[1] for m in members[w]})
        words = Counter(k for m in members[w] for k in m[3].lower().split() if len(k) > 3)
        best = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:10]
        assert [(k.word, k.frequency) for k in r.top_keywords] == best
        assert r.avg_title_length == pytest.approx(sum(len(m[3]) for m in members[w]) / len(members[w]), abs=0.0051)
        assert r.metadata.article_count == len(members[w]) and r.metadata.config.window_size == 300


def test_selected_kinds(spark):
    assert kinds_for(["basic", "source_stats"]) == ("source", "source_type")
    assert kinds_for(["text_analysis"]) == ("category", "keyword")
    with pytest.raises(ValueError):
        kinds_for(["nothing"])
    spec = WindowSpec.tumbling(60, kinds=("source",))
    assert "categories" not in windows.window_view(frame(spark, table(9)), spec).columns


def test_sources(spark):
    rows = [article(i, i, source=s) for i, s in enumerate("aabbbc")]
    df = frame(spark, rows)
    assert [tuple(r) for r in snapshot.source_distribution(df).collect()] == [("b", 3), ("a", 2), ("c", 1)]
    assert tuple(snapshot.top_source(df).first()) == (3, "b", 3)
    assert values(snapshot.top_sources_other(df, 1), "source", "n") == [("Other", 3), ("b", 3)]
    assert values(snapshot.top_sources_other(df, 3), "source", "n") == [("a", 2), ("b", 3), ("c", 1)]
    assert tuple(snapshot.top_source(df.limit(0)).first()) == (0, None, None)




@pytest.mark.parametrize("specs", [
    {"minute": WindowSpec.tumbling(60), "five": WindowSpec(300, 60, length_unit="bytes")},
    {"odd": WindowSpec(90, 60), "hour": WindowSpec.tumbling(3600), "long": WindowSpec(400, 150)},
])
def test_lattice_rolls_up_to_every_spec(spark, specs):
    df = frame(spark, table())
    rows = windows.roll_up(windows.lattice(df, specs), specs)
    for name, spec in specs.items():
        want = windows.window_stats(df, spec)
        assert values(rows.filter(F.col("aggregator") == name), *want.columns) == values(want, *want.columns)
    scans = windows.roll_up(windows.lattice(df, specs), specs)._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD")
    assert scans == 1


@pytest.mark.parametrize("spec", [WindowSpec(), WindowSpec(1000, 500, length_unit="bytes"), WindowSpec(7, 7), WindowSpec(1, 1), WindowSpec(20_000, 100)])
def test_snapshots_equal_single_ones(spark, spec):
    rows = table(200) + [article(900 + k, 599.5 + k / 8, title=None, description=None) for k in range(12)]
    df = frame(spark, rows)
    instants = [at(x) for x in (0, 0.25, 300, 599.5, 600, 600.125, 603, 660, 1500, 4000.000001, 5000, 90_000)]
    got = snapshot.snapshots(df, spark.createDataFrame([(t,) for t in [*instants, instants[0]]], "as_of timestamp"), spec)
    want = []
    for t in instants:
        want += values(snapshot.snapshot(df.filter(F.col("ts") <= F.lit(t)), F.lit(t).cast("timestamp"), spec).select(*got.columns), *got.columns)
    assert values(got, *got.columns) == order(want)
    assert snapshot.snapshots(df, spark.createDataFrame([], "as_of timestamp"), spec).count() == 0
    assert values(snapshot.snapshots(df.limit(0), spark.createDataFrame([(at(5),)], "as_of timestamp"), spec), "total_articles") == [(0,)]
