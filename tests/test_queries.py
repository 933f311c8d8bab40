"""Every named query beside its SQL, and the plans the queries rely on."""

import re

import pytest
from check_queries import compare, database

import __spark_entry__ as entry
from broadsheet.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(catalog.QUERIES)  # optional subpackages test their own


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


WITHOUT_SQL = {"title_topics"}  # an iterative fit


def test_every_query_has_sql():
    assert set(oracle.sql()) == set(NAMES) - WITHOUT_SQL


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problem = compare(spark, con, FOLDER, name)
    assert problem is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "window_start" and df.count() > 0


def plan(spark, name):
    return catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


PYTHON = {"html_articles", "html_articles_strict", "html_articles_nested", "html_articles_promo"}
STREAMS = {n for n in NAMES if n.startswith("stream_")}


@pytest.mark.parametrize("name", sorted(set(NAMES) - PYTHON - STREAMS - WITHOUT_SQL))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapIn|FlatMapGroups|CartesianProduct|BroadcastNestedLoop", text)


def test_columns_are_pruned(spark):
    reads = re.findall(r"ReadSchema: (\S+)", plan(spark, "sliding_source_counts"))
    assert sorted(reads) == ["struct<doc_id:bigint,source:string>", "struct<event_id:bigint,ts:timestamp_ntz>"]


def test_range_reaches_the_scan(spark):
    text = plan(spark, "stored_windows_range")
    assert "GreaterThanOrEqual(window_start" in text
    files = catalog.QUERIES["stored_windows_range"](spark, FOLDER).inputFiles()
    assert files and all(re.search(r"day=2024-01-0[12]/", f) for f in files)


@pytest.mark.parametrize("name", ["top_keywords", "capped_window_stats", "unique_links"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_sliding_windows_multiply_counts_not_articles(spark):
    text = plan(spark, "sliding_window_stats")
    # read upwards: the articles are grouped into panes below the expansion
    assert text.index("Expand") < text.rindex("HashAggregate")
    assert "HashAggregate" in text[text.index("Expand"):]


@pytest.mark.parametrize("name", ["trend", "moving_average", "heatmap", "count_windows", "top_sources_other"])
def test_single_partition_windows_are_bounded(spark, name):
    """Only ranks over top-k rows, per-day counts or per-partition counts may run in one task."""
    text = plan(spark, name)
    single = text.count("SinglePartition")
    assert single <= {"trend": 3, "moving_average": 2, "heatmap": 1, "count_windows": 0, "top_sources_other": 1}[name]


def test_leaders_need_one_scan(spark):
    assert plan(spark, "top_source_per_window").count("FileScan") == 2  # documents and events


def joins_carrying(spark, name, column):
    """Join inputs of a query's plan that hold a column, with no side broadcast."""
    from broadsheet.session import settings

    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        root = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan()
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            outputs = [c.output().mkString(",") for c in children]
            found += [o for o in outputs if f"{column}#" in o]
        todo += children
    return found


@pytest.mark.parametrize(
    "name",
    ["sliding_window_stats", "top_source_per_window", "capped_window_stats", "trend", "top_keywords", "validation_verdicts",
     "verdicts_without_source", "validation_summary", "stage_counters", "module_statistics", "word_count_distribution",
     "trailing_snapshot", "window_breakdowns"],
)
def test_texts_stay_below_the_join(spark, name):
    carried = ("description", "text", "checked_description", "_t")
    assert [c for c in carried if joins_carrying(spark, name, c)] == []


@pytest.mark.parametrize("name", ["named_aggregators", "validation_summary"])
def test_documents_are_read_once(spark, name):
    assert len(re.findall(r"FileScan parquet [^\n]*documents.parquet", plan(spark, name))) == 1


@pytest.mark.parametrize("name", ["window_keywords", "window_breakdowns"])
def test_panes_become_windows_after_the_last_shuffle(spark, name):
    """Read downwards from the result: no shuffle carries a pane once per window."""
    text = plan(spark, name)
    assert "Generate explode(sequence" in text
    assert text.index("Generate explode(sequence") < text.index("Exchange hashpartitioning")


def test_state_keys_are_not_counted():
    from broadsheet.session import state_settings

    assert state_settings()["spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"] == "false"
