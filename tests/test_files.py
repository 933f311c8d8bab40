"""Queries that write files of whole texts and read them back, over tables of their own."""

import glob
import gzip
import json
from datetime import timedelta

import pytest
from helpers import T0
from pyspark.sql import functions as F

from broadsheet.functions.packing import pack, unpack
from broadsheet.plans import catalog, views
from broadsheet.session import shared_root

TEXTS = ["One title\nand <more> & text", None, "", "Only 'a' \"title\" Заголовок"]


@pytest.fixture
def tables(spark, folder):
    docs = [(i, t, "en", f"src{i}") for i, t in enumerate(TEXTS)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    events = [(i, T0 + timedelta(minutes=i), 1, "click", 1.0, None) for i in [*range(1003), 7, 7]] + [(None, T0, 1, "view", 1.0, None)]
    types = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, types).write.parquet(f"{folder}/events.parquet")
    return folder


def run(spark, tables, name):
    """Rows of a query and the files it wrote."""
    found = lambda: set(glob.glob(f"{shared_root(spark)}/**/part-*", recursive=True))
    before = found()
    rows = catalog.QUERIES[name](spark, tables).collect()
    return rows, sorted(found() - before)


def stored(spark):
    """Names of the blocks that the session holds on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return [files.apply(i).getName() for i in range(files.size())]


def test_packed_texts(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").withColumn("p", pack(F.col("t")))
    assert [r[0] for r in df.select(unpack(F.col("p"))).collect()] == TEXTS


def test_array_files_are_compressed_arrays_of_a_part(spark, tables):
    rows, files = run(spark, tables, "json_array_files")
    assert len(rows) == 1005 and {r.title for r in rows} >= {"One title", "Only 'a' \"title\" Заголовок"}
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    arrays = [json.loads(gzip.open(f, "rt").read()) for f in files]
    assert sorted(map(len, arrays)) == [3, 500, 502]
    assert not any("title_keywords" in article for a in arrays for article in a)


def test_feed_files_are_compressed_and_hold_every_item(spark, tables):
    rows, files = run(spark, tables, "rss_files")
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    # an article without text makes no item
    assert len(rows) == 2 * sum(i % 4 != 1 for i in [*range(1003), 7, 7])
    assert {r.title for r in rows} == {"One title", "", "Only 'a' \"title\" Заголовок", "more"}


@pytest.mark.parametrize("name", ["json_array_files", "rss_files"])
def test_files_are_written_in_rounds_that_leave_no_shuffle(spark, tables, name, monkeypatch):
    """Articles dealt out a few hundred at a time give the same rows and files, and what was shuffled is gone before they are read."""
    rows, files = run(spark, tables, name)
    assert len(files) == 3
    shuffled = lambda: [f for f in stored(spark) if "shuffle_" in f]
    written = []
    monkeypatch.setattr(views, "DEALT_TOGETHER", 300)
    write = catalog._write_files

    def noted(*args):
        before = shuffled()
        write(*args)
        written.append(len(set(shuffled()) - set(before)))

    monkeypatch.setattr(catalog, "_write_files", noted)
    again, other = run(spark, tables, name)
    assert written == [0, 0, 0, 0]
    assert sorted(map(str, again)) == sorted(map(str, rows))
    other = [f for f in other if f.endswith(".gz")]
    assert sorted(gzip.open(f).read() for f in other) == sorted(gzip.open(f).read() for f in files)


def test_stored_articles_are_compressed(spark, tables):
    rows, files = run(spark, tables, "json_store_append")
    assert len(rows) == 2 * 1005
    assert files and all(f.endswith(".json.gz") for f in files)
    assert not any("title_keywords" in line for f in files for line in gzip.open(f, "rt"))
