"""Views over stored windows, for histories of every interesting length."""

import pandas as pd
import pytest
from helpers import at
from pyspark.sql import functions as F

from broadsheet.operators import history

SCHEMA = "window_start timestamp, window_end timestamp, total_articles long, rate_per_min double"


def stats(spark, counts, step=300):
    rows = [(at(i * step), at(i * step + 300), n, n / 5) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 12, 40])
@pytest.mark.parametrize("block", [3, 4096])
def test_moving_average(spark, n, block):
    counts = [(i * 7) % 11 for i in range(n)]
    got = [r.moving_avg for r in history.moving_average(stats(spark, counts, 7000), block=block).orderBy("window_start").collect()]
    want = pd.Series(counts).rolling(5, center=True).mean().tolist() if n > 5 else [None] * n
    assert len(got) == n
    assert all(g is None if pd.isna(w) else abs(g - w) < 1e-12 for g, w in zip(got, want))


@pytest.mark.parametrize("n, shown", [(1, False), (2, True), (5, True), (6, True), (7, True), (12, True), (30, True)])
def test_trend(spark, n, shown):
    counts = [10 + i for i in range(n)]
    row = history.trend(stats(spark, counts)).first()
    assert (row is not None) == shown
    if shown:
        recent, older = counts[-6:], counts[-12:-6] if n > 6 else []
        mean = sum(recent) / len(recent)
        before = sum(older) / len(older) if older else mean
        assert (row.recent_avg, row.older_avg) == (mean, before)
        assert row.trend_pct == pytest.approx(abs((mean - before) / before * 100))
        assert row.trend == ("stable" if not older else "strong_increase")


@pytest.mark.parametrize(
    "new, want", [(111, "strong_increase"), (110, "moderate_increase"), (103, "moderate_increase"), (102, "stable"),
                  (98, "stable"), (97, "moderate_decrease"), (90, "moderate_decrease"), (89, "strong_decrease")]
)
def test_trend_classes(spark, new, want):
    assert history.trend(stats(spark, [100] * 6 + [new] * 6)).first().trend == want


def test_trend_from_nothing(spark):
    row = history.trend(stats(spark, [0] * 6 + [5] * 6)).first()
    assert (row.trend, row.trend_pct) == ("stable", 0.0)


def test_slice_and_retention(spark):
    s = stats(spark, range(400))
    now = F.lit(at(399 * 300)).cast("timestamp")
    # at most twelve windows an hour, although thirteen lie in the closed range
    assert history.history_slice(s, now, hours=1).count() == 12
    assert history.history_slice(s, now, hours=24, limit=100).count() == 100
    rows = history.history_slice(s, now, hours=6, limit=1000).collect()
    assert len(rows) == 72 and max(r.total_articles for r in rows) == 399
    assert [r.total_articles for r in history.last_windows(s, 3).collect()] == [399, 398, 397]
    assert history.list_windows(s).columns == ["window_start", "window_end", "article_count"]


def test_heatmap(spark):
    assert history.heatmap(stats(spark, [1] * 23)).count() == 0
    cells = history.heatmap(stats(spark, [1] * 300)).cache()
    assert sum(r.articles for r in cells.collect()) == 300
    grid = history.heatmap_grid(cells, ["2024-01-01", "2024-01-02"]).orderBy("hour").collect()
    assert [r.hour for r in grid] == [f"{h:02d}:00" for h in range(24)]
    assert (grid[0]["2024-01-01"], grid[0]["2024-01-02"], grid[23]["2024-01-02"]) == (12, 12, None)


def test_rate_reference(spark):
    rows = history.rate_reference(stats(spark, [5, 10, 15])).collect()
    assert {r.mean_rate for r in rows} == {2.0} and len(rows) == 3
