"""Small article tables for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import types as T

ARTICLE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("ts", T.TimestampType()),
    ]
)
T0 = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def article(i: int, seconds: float, source: str = "a", title: str = "Some words here", kind: str = "rss", **kw) -> tuple:
    return (
        i, source, kind, title, kw.get("link", f"https://x.test/{i}"), kw.get("description", "d" * (i % 7)),
        kw.get("categories", ["one"]), at(seconds),
    )


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, ARTICLE)


def order(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, v if v is not None else 0) for v in r])


def values(df, *columns) -> list[tuple]:
    return order(df.select(*columns).collect())
