"""Articles as broker messages: decoding, dead letters, and rows ready to publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.barrier import compute_once
from broadsheet.operators.articles import from_wire
from broadsheet.schema import ARTICLE_WIRE, MICROSECONDS

# Names used between producers and consumers.
TOPIC = "news-articles"
SUBJECT = "news.articles"
CODECS = ("none", "gzip", "snappy", "lz4")

KAFKA_META = ("topic", "partition", "offset", "timestamp")
NATS_META = ("subject", "reply", "timestamp")

_CORRUPT = "_corrupt"


def read_kafka(spark: SparkSession, servers: str, topic: str = TOPIC, **options) -> DataFrame:
    """Message stream from the earliest offset; offsets live in the query's checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    return reader.options(**options).load()


def _parsed(df: DataFrame, meta: tuple[str, ...], value: str) -> DataFrame:
    text = F.col(value).cast("string")
    parsed = F.from_json(
        F.col("_text"), f"{ARTICLE_WIRE}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT}
    )
    kept = [c for c in meta if c in df.columns]
    rows = df.select(text.alias("_text"), F.struct(*kept).alias("_meta"))
    rows = compute_once(rows, parsed, "_a")
    bad = (
        F.col("_text").isNull()
        | ~F.is_valid_utf8("_text")
        | ~F.col("_text").rlike(r"^\s*\{")
        | F.col(f"_a.{_CORRUPT}").isNotNull()
    )
    return rows.withColumn("_bad", F.coalesce(bad, F.lit(True)))


def decode_messages(df: DataFrame, meta: tuple[str, ...] = KAFKA_META, value: str = "value") -> DataFrame:
    """Article rows of well-formed messages with their envelope in ``_meta``; others are left out."""
    rows = _parsed(df, meta, value).filter("not _bad").select("_a.*", "_meta").drop(_CORRUPT)
    return from_wire(rows)


def dead_letters(df: DataFrame, meta: tuple[str, ...] = KAFKA_META, value: str = "value") -> DataFrame:
    """The messages ``decode_messages`` leaves out, as text with their envelope."""
    return _parsed(df, meta, value).filter("_bad").select(F.col("_text").alias("value"), "_meta")


def to_messages(articles: DataFrame, topic: str = TOPIC, beside: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the Kafka sink: source as key, article JSON as value, source and type as headers.

    ``beside`` names columns to carry next to the message rather than in it, such as ``partition``.
    """
    fields = [c for c in articles.columns if not c.startswith("_") and c not in beside]
    header = lambda c: F.struct(F.lit(c).alias("key"), F.col(c).cast("binary").alias("value"))
    return articles.select(
        F.lit(topic).alias("topic"),
        F.col("source").cast("binary").alias("key"),
        F.to_json(F.struct(*fields), {"timestampFormat": MICROSECONDS}).cast("binary").alias("value"),
        F.array(header("source"), header("source_type")).alias("headers"),
        *beside,
    )


def kafka_options(servers: str, compression: str = "none") -> dict[str, str]:
    """Sink options; an unknown codec name means no compression."""
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.compression.type": compression if compression in CODECS else "none",
    }


def write_kafka(articles: DataFrame, servers: str, topic: str = TOPIC, compression: str = "none") -> None:
    to_messages(articles, topic).write.format("kafka").options(**kafka_options(servers, compression)).save()
