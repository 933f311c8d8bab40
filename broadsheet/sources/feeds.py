"""Feed documents (RSS 2.0 and Atom) to article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.barrier import compute_once
from broadsheet.functions.dates import parse_published
from broadsheet.functions.text import or_empty, unicode_trim
from broadsheet.schema import ATOM_ENTRY, ATOM_FEED, RSS_FEED, RSS_ITEM

_NO_TEXT = "array<string>"
_TRIMMED = {"ignoreSurroundingSpaces": "true"}


def _clean(c: Column) -> Column:
    return unicode_trim(or_empty(c))


def _list(c: Column) -> Column:
    """Non-empty trimmed entries, an empty list for none."""
    kept = F.filter(F.transform(c, _clean), lambda x: x != "")
    return F.coalesce(kept, F.array().cast(_NO_TEXT))


def rss_fields(item: str) -> list[Column]:
    """Article fields of an RSS ``item`` struct."""
    f = lambda name: F.col(f"{item}.`{name}`")
    none = F.array().cast(_NO_TEXT)
    return [
        _clean(f("title")).alias("title"),
        _clean(f("link")).alias("link"),
        _clean(f("description")).alias("description"),
        _clean(f("pubDate")).alias("published"),
        _list(F.concat(F.coalesce(f("author"), none), F.coalesce(f("dc:creator"), none))).alias("authors"),
        _list(f("category")).alias("categories"),
    ]


def atom_fields(entry: str) -> list[Column]:
    """Article fields of an Atom ``entry`` struct."""
    f = lambda name: F.col(f"{entry}.`{name}`")
    links = F.coalesce(f("link"), F.array())
    page = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    href = F.coalesce(F.get(page, 0)["_href"], F.get(links, 0)["_href"])
    return [
        _clean(f("title")).alias("title"),
        _clean(href).alias("link"),
        _clean(f("summary")).alias("description"),
        _clean(F.coalesce(f("published"), f("updated"))).alias("published"),
        _list(F.transform(f("author"), lambda x: x["name"])).alias("authors"),
        _list(F.transform(f("category"), lambda x: x["_term"])).alias("categories"),
    ]


def _articles(rows: DataFrame, keep: list[str], fields: list[Column], fetched_at: Column) -> DataFrame:
    out = rows.select(*keep, F.lit("rss").alias("source_type"), *fields)
    stated = F.when(F.col("published") != "", parse_published(F.col("published"), fetched_at, "lenient"))
    return out.withColumns({"published_time": stated, "scraped_at": fetched_at})


_CORRUPT = "_corrupt"


def parse_feeds(feeds: DataFrame, xml: str = "xml", kind: str = "rss") -> DataFrame:
    """Add ``items``, the entries of each feed document, and ``error``, set where it is not well formed.

    A document is parsed once, whatever is taken from the result; a null document has neither.
    """
    schema = RSS_FEED if kind == "rss" else ATOM_FEED
    marked = T.StructType([*schema, T.StructField(_CORRUPT, T.StringType())])
    options = _TRIMMED | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = compute_once(feeds, F.from_xml(F.col(xml), marked.json(), options), "_f")
    broken = F.col(f"_f.{_CORRUPT}").isNotNull()
    items = F.when(~broken, F.col("_f.channel.item" if kind == "rss" else "_f.entry"))
    error = F.when(broken, F.lit("the feed is not well formed"))
    return parsed.withColumns({"items": items, "error": error}).drop("_f")


def articles_of(parsed: DataFrame, fetched_at: Column, keep: list[str] | None = None, kind: str = "rss") -> DataFrame:
    """One row per item of parsed feed documents."""
    keep = keep or ["source"]
    rows = parsed.select(*keep, F.explode("items").alias("_i"))
    return _articles(rows, keep, rss_fields("_i") if kind == "rss" else atom_fields("_i"), fetched_at)


def rejected(parsed: DataFrame) -> DataFrame:
    """The feed documents that could not be read, whole, with the reason."""
    return parsed.filter("error is not null").drop("items")


def feed_articles(
    feeds: DataFrame, fetched_at: Column, xml: str = "xml", keep: list[str] | None = None, kind: str = "rss"
) -> DataFrame:
    """One row per item of the feed documents in a column.

    A document that is not well formed contributes no rows; ``parse_feeds`` tells which those are.
    """
    keep = keep or ["source"]
    schema = RSS_FEED if kind == "rss" else ATOM_FEED
    items = "channel.item" if kind == "rss" else "entry"
    parsed = F.from_xml(F.col(xml), schema.json(), _TRIMMED)
    rows = feeds.select(*keep, parsed.alias("_f")).select(*keep, F.explode(F.col(f"_f.{items}")).alias("_i"))
    return _articles(rows, keep, rss_fields("_i") if kind == "rss" else atom_fields("_i"), fetched_at)


def read_feeds(spark: SparkSession, path: str, fetched_at: Column, kind: str = "rss") -> DataFrame:
    """One row per item of feed files, each file name (without suffix) being the source.

    A file is one document. What follows the place where it stops being well formed contributes no rows.
    """
    tag, schema = ("item", RSS_ITEM) if kind == "rss" else ("entry", ATOM_ENTRY)
    read = spark.read.format("xml").option("rowTag", tag).options(**_TRIMMED | {"mode": "DROPMALFORMED"}).schema(schema).load(path)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]+$", "")
    rows = read.select(name.alias("source"), F.struct(*[F.col(f"`{c}`") for c in schema.names]).alias("_i"))
    return _articles(rows, ["source"], rss_fields("_i") if kind == "rss" else atom_fields("_i"), fetched_at)
