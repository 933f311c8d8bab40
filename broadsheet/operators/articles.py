"""Article rows: defaults, event time, routing by source type, union, uniqueness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.dates import drop_zero_time, from_time_parts, parse_iso
from broadsheet.functions.text import labels_of

SOURCE_TYPES = ("rss", "html")


def from_wire(df: DataFrame) -> DataFrame:
    """Wire-schema rows to ``ARTICLE`` types; further columns are kept.

    ``scraped_at_raw`` keeps the text, because a present but unreadable time
    makes a row a reject while an absent one does not.
    """
    published_time = F.coalesce(
        drop_zero_time(parse_iso(F.col("published_time"))), from_time_parts(F.col("published_parsed"))
    )
    return (
        df.withColumn("published_time", published_time)
        .withColumn("authors", labels_of(F.col("authors"), "name"))
        .withColumn("categories", labels_of(F.col("categories"), "term"))
        .withColumn("scraped_at_raw", F.col("scraped_at"))
        .withColumn("scraped_at", parse_iso(F.col("scraped_at")))
        .drop("published_parsed")
    )


def fill_defaults(df: DataFrame) -> DataFrame:
    """Missing source is ``unknown``, missing texts are empty, missing categories are none."""
    defaults = {
        "source": F.lit("unknown"),
        "title": F.lit(""),
        "description": F.lit(""),
        "categories": F.array().cast("array<string>"),
    }
    return df.withColumns(
        {k: F.coalesce(F.col(k), v) for k, v in defaults.items() if k in df.columns}
    )


def with_event_time(df: DataFrame, as_of: Column, column: str = "ts") -> DataFrame:
    """Event time: scrape time, else publication time, else ``as_of``.

    NULL marks a row whose scrape time is present but unreadable.
    """
    scraped = F.col("scraped_at")
    raw = F.col("scraped_at_raw") if "scraped_at_raw" in df.columns else scraped.cast("string")
    fallback = F.coalesce(parse_iso(F.col("published")), as_of)
    return df.withColumn(column, F.when(raw.isNotNull(), scraped).otherwise(fallback))


def split_by_event_time(df: DataFrame, column: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Rows with an event time, and rejects."""
    return df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())


def route(df: DataFrame, column: str = "type") -> dict[str, DataFrame]:
    """One frame per known source type, and ``rejects`` for the others."""
    known = F.coalesce(F.col(column).isin(*SOURCE_TYPES), F.lit(False))
    frames = {t: df.filter(F.col(column) == t) for t in SOURCE_TYPES}
    frames["rejects"] = df.filter(~known).withColumn(
        "error", F.concat(F.lit("unknown source type: "), F.coalesce(F.col(column), F.lit("")))
    )
    return frames


def gather(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, duplicates kept; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def trailing(df: DataFrame, as_of: Column, size: str = "5 minutes", ts: str = "ts") -> DataFrame:
    """Rows not older than ``size`` before ``as_of``; the edge itself is inside."""
    return df.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {size}"))


def unique_links(df: DataFrame, order: list[Column], key: str = "link") -> DataFrame:
    """The first row of every link in ``order``.

    The rank filter is planned as a group limit, so each map task ships at most
    one row per link however many copies a link has.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
