"""Web pages to article rows.

A page offers candidate blocks: ``article`` elements and ``div`` elements whose
class names them promo or news. The first heading of a block is the title, its
first anchor the link; blocks without either are skipped. Where an element ends
depends on the elements inside it, which no pattern can tell, so pages are
parsed, in Arrow batches and without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import unicode_trim
from broadsheet.functions.urls import absolute_link

MAX_BLOCKS = 10

# What is a candidate block, a title and a link.
BLOCK_TAG = "article"
BLOCK_CLASSES = ("promo", "news")
TITLE_TAGS = ("h1", "h2", "h3", "h4")
TITLE_CLASS = "heading"

# pages without any such element hold no candidate and are not parsed
_ANY_BLOCK = r"(?i)<(?:article|div)"


class _Blocks(HTMLParser):
    """Title and link of the candidate blocks of one page, nested ones included."""

    # Elements without an end tag.
    VOID = frozenset(
        ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
    )

    def __init__(self, limit: int) -> None:
        super().__init__(convert_charrefs=True)
        self.limit = limit
        self.blocks: list[dict] = []
        # open elements as (tag, own block or None, number of titles it collects), and how many per tag
        self.open: list[tuple[str, dict | None, int]] = []
        self.depth: Counter[str] = Counter()
        # blocks around the current position, and those whose title is being read
        self.inside: list[dict] = []
        self.titled: list[dict] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        attr = {k: v or "" for k, v in reversed(attrs)}
        names = attr.get("class", "")
        if tag == "a":
            for b in self.inside:
                if b["link"] is None:
                    b["link"] = attr.get("href", "")
        titled = []
        if tag in TITLE_TAGS or (tag == "a" and TITLE_CLASS in names):
            titled = [b for b in self.inside if b["title"] is None]
            for b in titled:
                b["title"] = ""
        block = None
        candidate = tag == BLOCK_TAG or (tag == "div" and any(c in names for c in BLOCK_CLASSES))
        if candidate and len(self.blocks) < self.limit:
            block = {"title": None, "link": None}
            self.blocks.append(block)
        if tag not in self.VOID:
            self.open.append((tag, block, len(titled)))
            self.depth[tag] += 1
            self.titled += titled
            if block is not None:
                self.inside.append(block)

    def handle_endtag(self, tag: str) -> None:
        if not self.depth[tag]:
            return
        while True:
            name, block, titles = self.open.pop()
            self.depth[name] -= 1
            if block is not None:
                self.inside.pop()
            if titles:
                del self.titled[-titles:]
            if name == tag:
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        for b in self.titled:
            b["title"] += data


def page_blocks(html: str, limit: int = MAX_BLOCKS) -> list[tuple[str, str]]:
    """(title, link) of each candidate block of a page in document order."""
    parser = _Blocks(limit)
    html = html or ""
    # a comment that is never closed reaches to the end; closing it there lets the parser read it once
    if html.rfind("<!--") > html.rfind("-->"):
        html += "-->"
    parser.feed(html)
    parser.close()
    return [(b["title"] or "", b["link"] or "") for b in parser.blocks]


def page_articles(
    pages: DataFrame,
    scraped_at: Column,
    keep: list[str] | None = None,
    url: str = "url",
    html: str = "html",
    max_blocks: int = MAX_BLOCKS,
    link_fallback: str | None = None,
) -> DataFrame:
    """Articles of pages, from candidate blocks that may nest and hold other elements.

    The first ``max_blocks`` blocks of a page count, whether or not they yield an
    article. ``link_fallback="page_url"`` gives a block without an anchor the
    address of its page. A null page has no blocks.
    """
    keep = keep or [url]
    columns = list(dict.fromkeys([*keep, url]))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = batch[html].map(lambda page: list(enumerate(page_blocks(page, max_blocks))))
            rows = batch[columns].assign(_found=found).explode("_found").dropna(subset=["_found"])
            yield rows[columns].assign(
                pos=[p for p, _ in rows["_found"]],
                _title=[t for _, (t, _) in rows["_found"]],
                _link=[k for _, (_, k) in rows["_found"]],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*columns).schema]
    schema = ", ".join([*fields, "pos int", "_title string", "_link string"])
    likely = pages.filter(F.col(html).rlike(_ANY_BLOCK))
    rows = likely.select(*dict.fromkeys([*columns, html])).mapInPandas(extract, schema)
    link = F.col("_link")
    if link_fallback == "page_url":
        link = F.when(link == "", F.col(url)).otherwise(link)
    rows = rows.withColumn("_link", link).filter((F.col("_title") != "") & (F.col("_link") != ""))
    return rows.select(
        *keep,
        "pos",
        F.lit("html").alias("source_type"),
        unicode_trim(F.col("_title")).alias("title"),
        absolute_link(F.col("_link"), F.col(url)).alias("link"),
        F.lit("").alias("description"),
        F.lit("").alias("published"),
        scraped_at.alias("scraped_at"),
    )
