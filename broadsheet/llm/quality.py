"""Quality rules with cross-document line frequency, as column expressions only.

Each document is judged first by base rules on its own words. Then its lines are
normalised (ASCII white space collapsed, lower case) and hashed, the distinct
documents that hold a line are counted per host, and lines above the host's
limit are removed. A document left with too little is rejected as depleted.

Documents with the same text count as one, so a group of exact copies does not
turn its own lines into boilerplate. Of the documents holding a line above the
limit, the one with the smallest id keeps it, so no line leaves a host entirely.

Only narrow rows are shuffled: 64-bit line hashes and counts. A hot line is
counted through partial aggregates; its hits join a table of lines above the
limit, whose skew adaptive execution splits.

Defined cases: a null text has no words; a null host is a host of its own; a null
id counts as the smallest; rows repeated in full count once and are all returned
with the same verdict; an empty table gives an empty result. Only the named
columns are read, other columns of any name stay out of the way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import SPACE_RUN, SPACES, fresh, words
from broadsheet.session import materialise

# fixed: characters counted as symbols
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineLimits:
    """When a line is boilerplate of its host, and when its document is depleted."""

    max_docs: int = 20  # up to so many documents of a host may share a line, whatever the host's size
    min_left_words: int = 20
    min_left_share: float = 0.5


def _line_structs(text: Column) -> Column:
    """Hash and word count of each line with a word, in order."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")
    normal = F.transform(lines, lambda x: F.regexp_replace(F.trim(x, F.lit(SPACES)), SPACE_RUN, " "))
    return F.transform(
        normal,
        lambda x: F.struct(F.xxhash64(F.lower(x)).alias("h"), F.size(F.split(x, " ", -1)).cast("long").alias("w")),
    )


def _windows(ws: Column, n: Column) -> Column:
    """Three-word windows as (hash, position), sorted, so that equal windows are neighbours."""
    starts = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(
        F.transform(
            starts,
            lambda i: F.struct(
                F.xxhash64(F.get(ws, i - 1), F.get(ws, i), F.get(ws, i + 1)).alias("h"), i.alias("i")
            ),
        )
    )


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more, the first occurrence included."""

    def again(x: Column, k: Column) -> Column:
        before, after = F.get(windows, k - 1), F.get(windows, k + 1)
        return F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))

    at = F.sort_array(F.transform(F.filter(windows, again), lambda x: x["i"]))
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        at,
        start,
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source") -> DataFrame:
    """One row per document row: id, host, text hash, base counts and line hashes."""
    df = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    df = df.withColumn("ws", words(F.col("text")))
    df = df.withColumn("n", F.size("ws"))
    df = df.withColumn("windows", _windows(F.col("ws"), F.col("n")))
    raw = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")
    df = df.withColumn("raw_lines", raw)
    length = F.length("text")
    return df.select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (length - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("windows")).alias("n_repeat_words"),
        _line_structs(F.col("text")).alias("lines"),
    )


def frequent_lines(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """``host, h`` of the lines that more distinct documents of a host hold than the limit."""
    held = rows.select("host", "text_hash", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    counts = held.groupBy("host", "h").agg(F.count_distinct("text_hash").alias("n"))
    return counts.filter(F.col("n") > limits.max_docs).select("host", "h")


def _removals(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """Per document that loses lines: its key and the hashes of the lines."""
    limit = frequent_lines(rows, limits).select(F.col("host").alias("at_host"), F.col("h").alias("at_h"))
    held = rows.select(
        "doc_id", "host", "text_hash", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h")
    )
    hits = held.join(limit, F.col("host").eqNullSafe(F.col("at_host")) & (F.col("h") == F.col("at_h")))
    hits = materialise(hits.select("doc_id", "host", "text_hash", "h"), "line-hits")
    first = hits.groupBy(F.col("host").alias("at_host"), F.col("h").alias("at_h")).agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first")
    )
    lost = hits.join(first, F.col("host").eqNullSafe(F.col("at_host")) & (F.col("h") == F.col("at_h")))
    # exact copies of the keeper keep the line as well
    lost = lost.filter(F.col("text_hash") != F.col("first.text_hash"))
    # at most as many values as the document has lines
    return lost.groupBy("doc_id", "host", "text_hash").agg(F.collect_set("h").alias("gone"))


def judge(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    host: str = "source",
    limits: LineLimits = LineLimits(),
) -> DataFrame:
    """Verdict per document row, with the hashes of the lines it loses in ``gone``."""
    rows = materialise(features(docs, text, doc_id, host), "line-features")
    gone = _removals(rows, limits).select(
        F.col("doc_id").alias("g_id"), F.col("host").alias("g_host"), F.col("text_hash").alias("g_hash"), "gone"
    )
    same = (
        (F.col("text_hash") == F.col("g_hash"))
        & F.col("doc_id").eqNullSafe(F.col("g_id"))
        & F.col("host").eqNullSafe(F.col("g_host"))
    )
    df = rows.join(gone, same, "left").drop("g_id", "g_host", "g_hash")
    none = F.array().cast("array<bigint>")
    df = df.withColumn("gone", F.coalesce("gone", none))
    lost = F.filter("lines", lambda x: F.array_contains(F.col("gone"), x["h"]))
    df = df.withColumn("n_removed_words", F.aggregate(lost, F.lit(0).cast("long"), lambda a, x: a + x["w"]))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & (
        (left < limits.min_left_words) | (left < limits.min_left_share * F.col("n_words"))
    )
    return df.select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_removed_words", "gone",
    )


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines whose normalised hash is in ``gone``."""
    def stays(x: Column) -> Column:
        bare = F.regexp_replace(F.trim(x, F.lit(SPACES)), SPACE_RUN, " ")
        return ~F.array_contains(gone, F.xxhash64(F.lower(bare)))

    return F.when(F.size(gone) == 0, text).otherwise(F.array_join(F.filter(F.split(text, "\n", -1), stays), "\n"))


def apply_rules(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Documents that pass, without their boilerplate lines; columns as given, ``n_chars`` kept in step."""
    verdicts = judge(docs, limits=limits).filter("kept")
    # rows repeated in full share one verdict
    verdicts = verdicts.groupBy("doc_id", "host", "text_hash").agg(F.first("gone").alias("gone"))
    key = fresh(docs, "_text_hash")
    rows = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit("")))).alias("d")
    v = verdicts.alias("v")
    same = (
        (F.col(f"d.{key}") == F.col("v.text_hash"))
        & F.col("d.doc_id").eqNullSafe(F.col("v.doc_id"))
        & F.col("d.source").eqNullSafe(F.col("v.host"))
    )
    out = rows.join(v, same)
    clean = without_lines(F.col("d.text"), F.col("v.gone"))
    made = {"text": clean}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.size("v.gone") == 0, F.col("d.n_chars")).otherwise(F.length(clean))
    return out.select(*[(made.get(c, F.col(f"d.`{c}`"))).alias(c) for c in docs.columns])
