"""Tables read from a folder, and the article rows derived from them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.packing import pack, unpack
from broadsheet.functions.text import keywords, words
from broadsheet.operators import validate, windows
from broadsheet.session import materialise, prepare

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# figures of the texts that are taken per document
OF_TEXTS = (*windows.SUMS[1:], "title_keywords", "description_words")

# articles whose texts are shuffled at a time where whole texts are dealt out
DEALT_TOGETHER = 4_000_000

# validation treats this instant as "now"
AS_OF = "2024-06-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def published_text(doc_id: Column, ts: Column) -> Column:
    """Publication time in ten forms, accepted and refused, by document."""
    later = ts + F.expr("INTERVAL 3 HOURS")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    forms = [
        iso,
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        F.concat(F.date_format(later, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0300")),
        F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")),
        F.lit(" "),
        F.date_format(ts, "MM/dd/yyyy"),
        F.date_format(ts, "dd.MM.yyyy"),
        F.concat(F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+03:00")),
        F.concat(F.lit("1999"), F.substring(iso, 5, 30)),
        F.concat(F.lit("2031"), F.substring(iso, 5, 30)),
    ]
    text = F.lit("not a date")
    for k, form in reversed(list(enumerate(forms))):
        text = F.when(doc_id % 10 == k, form).otherwise(text)
    return text


def _title(text: str) -> Column:
    return F.split_part(text, F.lit("\n"), F.lit(1)).alias("title")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with figures of their texts, so that the join carries a text only where a query needs it."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", _title("text"), F.col("text").alias("description"))
    return windows.with_lengths(docs).withColumns(
        {"title_keywords": keywords(F.col("title")), "description_words": F.size(words(F.col("description"))).cast("long")}
    )


def _as_articles(docs: DataFrame, events: DataFrame, n_docs: Column) -> DataFrame:
    # every event is an article; the documents are dealt to them in turn
    events = events.withColumn("text_id", F.try_mod("event_id", n_docs))
    docs = docs.withColumnRenamed("doc_id", "text_id")
    rows = events.join(docs, "text_id").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.withColumnRenamed("event_id", "doc_id").select(
        "doc_id",
        "text_id",
        "source",
        F.when(F.col("doc_id") % 4 == 3, "html").otherwise("rss").alias("source_type"),
        "title",
        F.concat(F.lit("https://news.example.com/a/"), F.col("doc_id")).alias("link"),
        "description",
        published_text(F.col("doc_id"), F.col("ts")).alias("published"),
        F.array("lang", "event_type").alias("categories"),
        F.col("ts").alias("scraped_at"),
        "ts",
        *[c for c in docs.columns if c in OF_TEXTS or c in validate.TEXT_CHECKS],
    )


def _n_documents(spark: SparkSession, folder: str) -> Column:
    """The number of documents, taken from the footers of the files so that it is a constant in every plan."""
    return F.lit(table(spark, folder, "documents").count())


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """One article per event, scraped when it happened, ``doc_id`` being its number and ``text_id`` its document's."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    return _as_articles(_documents(spark, folder), events, _n_documents(spark, folder))


def dealt_articles(spark: SparkSession, folder: str, by: Column, name: str) -> Iterator[DataFrame]:
    """The same articles without figures of their texts, dealt out by a value ``name``, all rows of a value in one task.

    ``place`` numbers the rows of a value from 1 to ``places``. A text is packed once per document; the join and the
    shuffle carry it packed. Every article is in one of the frames that are handed out, each value in one of them, so that
    what one frame shuffled may go before the next is asked for.
    """
    docs = table(spark, folder, "documents").select(
        "doc_id", "lang", "source", F.lit(None).cast("string").alias("title"), pack(F.col("text")).alias("description")
    )
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    rounds = max(1, -(-events.count() // DEALT_TOGETHER))
    if rounds > 1:
        docs = materialise(docs, "packed-texts")
    articles = _as_articles(docs, events, _n_documents(spark, folder)).withColumn(name, by)
    for k in range(rounds):
        dealt = articles.filter(F.pmod(F.xxhash64(name), F.lit(rounds)) == k) if rounds > 1 else articles
        dealt = dealt.withColumns(
            {
                "place": F.row_number().over(Window.partitionBy(name).orderBy("doc_id")),
                "places": F.count(F.lit(1)).over(Window.partitionBy(name)),
            }
        )
        yield dealt.withColumn("description", unpack(F.col("description"))).withColumn("title", _title("description"))


def checked_articles(spark: SparkSession, folder: str) -> DataFrame:
    """The same articles with the validation of their texts, taken once per document."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    return _as_articles(validate.check_texts(_documents(spark, folder)), events, _n_documents(spark, folder))


def article_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same articles, with the events arriving as a stream."""
    # as a pattern the path may be one file or a folder of part files
    return arriving_articles(spark, folder, f"{folder}/events.parque[t]")


def arriving_articles(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """Articles of the events in the files under ``path``, present and to come."""
    events = prepare(spark).readStream.schema(EVENTS).parquet(path).select("event_id", "ts", "event_type")
    return _as_articles(_documents(spark, folder), events, _n_documents(spark, folder))


def locks(spark: SparkSession, folder: str) -> DataFrame:
    """Lock log of the sources: a purchase takes the lock, anything else releases it."""
    holder = F.when(F.col("event_type") == "purchase", F.concat(F.lit("w"), F.col("event_id") % 8))
    return table(spark, folder, "events").select(
        F.concat(F.lit("https://feeds.example.com/"), F.col("user_id")).alias("url"),
        F.coalesce(holder, F.lit("")).alias("locked_by"),
        F.col("ts").cast("timestamp").alias("locked_at"),
        "event_id",
    )


def configured_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Configured sources, one per customer."""
    return table(spark, folder, "customer").select(
        F.concat(F.lit("https://feeds.example.com/"), F.col("c_custkey")).alias("url"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "html").otherwise("rss").alias("type"),
    )


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Usage samples of collector runs, in hundredths so that sums are exact."""
    cents = F.round(F.col("value") * 100)
    return table(spark, folder, "events").select(
        F.col("event_type").alias("scraper"),
        F.col("user_id").alias("iteration"),
        (cents - 500).alias("cpu_percent"),
        (cents * 2 - 900).alias("memory_mb"),
        cents.alias("seconds"),
    )


def latest_ts(df: DataFrame, column: str = "ts") -> Column:
    return df.agg(F.max(column)).scalar()


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps in UTC, as other engines store them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
