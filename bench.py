"""Time named queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times; the median counts.
Results go to the noop sink, so every column is computed. Names may be given as
arguments; without any, the headline list runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from broadsheet.plans import catalog
from broadsheet.session import local_session

HEADLINE = [
    "top_source_per_window",
    "sliding_window_stats",
    "tumbling_window_stats",
    "window_view_flat",
    "validation_summary",
    "dropped_per_window",
    "window_keywords",
    "emerging_keywords",
    "window_by_source",
    "stored_results",
    "json_store_append",
    "valid_and_invalid",
    "window_breakdowns",
    "top_keywords",
    "capped_window_stats",
    "count_windows",
    "forced_close_windows",
    "dense_windows",
    "source_distribution",
    "trailing_snapshot",
    "trailing_snapshots",
    "named_aggregators",
    "validation_verdicts",
    "sanitize_pages",
    "parse_dates",
    "validate_links",
    "html_articles",
    "html_articles_nested",
    "rss_articles",
    "decode_messages",
    "moving_average",
    "trend",
    "heatmap",
    "sources_to_scrape",
    "run_comparison",
    "histogram_buckets",
    "unique_links",
    "stream_sliding_stats",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(catalog.QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        times = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(f"{name} {seconds[name]} (first {times[0]:.2f})", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
