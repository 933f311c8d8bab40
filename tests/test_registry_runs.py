"""Locks, workers, run summaries, counters."""

import math

import pytest
from helpers import T0, at
from pyspark.sql import functions as F

from broadsheet.operators import counters, registry, runs
from broadsheet.schema import LOCK, SOURCE_LIST, WORKER


def now(seconds):
    return F.lit(at(seconds)).cast("timestamp")


def test_sources(spark):
    locks = spark.createDataFrame(
        [
            ("held", "w1", at(0), None), ("held", "w2", at(90), None),
            ("edge", "w1", at(70), None), ("expired", "w1", at(69), None),
            ("released", "w1", at(50), None), ("released", "", at(99), None), ("unknown", None, at(1), None),
        ],
        LOCK,
    )
    sources = spark.createDataFrame(
        [("held", "H", "rss"), ("edge", "E", "rss"), ("expired", "X", "html"), ("released", "R", "rss"),
         ("released", "Again", "rss"), ("new", "N", "rss")],
        SOURCE_LIST,
    )
    args = (now(100), ["locked_at"])
    free = registry.available_sources(locks, *args)
    assert sorted(r.url for r in free.collect()) == ["expired", "released", "unknown"]
    chosen = registry.sources_to_scrape(sources, locks, *args)
    assert sorted(tuple(r) for r in chosen.collect()) == [("expired", "X", "html"), ("new", "N", "rss"), ("released", "Again", "rss")]
    assert sorted(r.url for r in registry.sources_to_scrape(sources, None, *args).collect()) == ["edge", "expired", "held", "new", "released"]
    left = registry.without_locked(sources, locks, *args)
    assert sorted(r.name for r in left.collect()) == ["Again", "N", "R", "X"]


def test_workers(spark):
    beats = spark.createDataFrame(
        [("a", "busy", at(0), "h", ["cpu"], T0), ("a", "idle", at(41), "h", ["cpu"], T0), ("b", "idle", at(40), "h", [], T0)],
        WORKER,
    )
    assert [(r.id, r.status, r.hostname) for r in registry.active_workers(beats, now(100)).collect()] == [("a", "idle", "h")]


def test_usage_ignores_samples_that_are_not_positive(spark):
    samples = spark.createDataFrame(
        [("go", 1, 0.0, 10.0), ("go", 1, 20.25, 30.0), ("go", 1, -1.0, 0.0), ("go", 2, 0.0, 0.0)],
        "scraper string, iteration long, cpu_percent double, memory_mb double",
    )
    got = {r.iteration: tuple(r)[2:] for r in runs.run_usage(samples, ["scraper", "iteration"]).collect()}
    assert got == {1: (20.2, 20.2, 20.0, 30.0), 2: (0.0, 0.0, 0.0, 0.0)}


@pytest.fixture
def summary(spark):
    rows = [("python", i, t, c, c * 2, 120.0, 180.0) for i, (t, c) in enumerate([(4.8, 45.0), (5.2, 45.0), (5.6, 45.0)])]
    rows += [("go", i, t, 25.0, 40.0, m, 60.0) for i, (t, m) in enumerate([(1.9, 120.0), (2.1, 120.0), (2.3, 125.0)])]
    df = spark.createDataFrame(
        rows, "scraper string, iteration long, execution_time_seconds double, avg_cpu_percent double, "
        "max_cpu_percent double, avg_memory_mb double, max_memory_mb double",
    )
    return runs.run_summary(df)


def test_summary_and_comparison(spark, summary):
    go = summary.filter("scraper = 'go'").first()
    assert (go.avg_execution_time, go.min_execution_time, go.max_execution_time, go.avg_memory_across_runs) == (2.1, 1.9, 2.3, 121.67)
    cmp = {r.metric: r for r in runs.compare(summary, "python", "go").collect()}
    t = cmp["avg_execution_time"]
    assert (t.display_name, t.better) == ("Execution Time (seconds)", "go")
    assert (t.difference, t.improvement_ratio) == (pytest.approx(-3.1), pytest.approx(5.2 / 2.1))
    assert cmp["avg_memory_across_runs"].better == "python"
    total = runs.tally(runs.compare(summary, "python", "go"), "python", "go").first()
    assert tuple(total) == (4, 0, 1, "go")


def test_zero_or_missing_figures_are_left_out(spark, summary):
    zero = summary.withColumn("avg_max_cpu", F.lit(0.0))
    assert "avg_max_cpu" not in {r.metric for r in runs.compare(zero, "python", "go").collect()}
    alone = runs.compare(summary.filter("scraper = 'go'"), "python", "go")
    assert alone.count() == 0
    assert tuple(runs.tally(alone, "python", "go").first()) == (0, 0, 0, "comparable")


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 1.5, 11.0, 191.0, 192.0, None]], "v double")
    got = {r.le: r.n for r in counters.histogram(df, "v", counters.BATCH_SIZE_BUCKETS).collect()}
    assert len(got) == 21 and (got[1.0], got[11.0], got[181.0], got[191.0], got[math.inf]) == (1, 3, 3, 4, 5)
    assert len(counters.DURATION_BUCKETS) == 11
