"""Analysis modules: user code that turns articles into figures, per window or overall."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.config import WindowSpec
from broadsheet.functions import lda
from broadsheet.functions.text import keywords, words
from broadsheet.session import materialise


class AnalysisModule(ABC):
    """A named set of aggregates over articles."""

    name: str

    @abstractmethod
    def aggregates(self) -> list[Column]:
        """Aggregate expressions over article columns."""

    def prepare(self, articles: DataFrame) -> DataFrame:
        """Columns the aggregates need."""
        return articles

    def apply(self, articles: DataFrame, by: list[str]) -> DataFrame:
        return self.prepare(articles).groupBy(*by).agg(*self.aggregates())


def word_count(articles: DataFrame, text: str = "description") -> Column:
    """Words of a text; a count that is there, as ``<text>_words``, is taken as it is."""
    if f"{text}_words" in articles.columns:
        return F.col(f"{text}_words")
    return F.size(words(F.col(text))).cast("long")


class BasicStatistics(AnalysisModule):
    """Articles, sources and mean word count."""

    name = "basic"

    def prepare(self, articles: DataFrame) -> DataFrame:
        return articles.withColumn("_words", word_count(articles))

    def aggregates(self) -> list[Column]:
        return [
            F.count(F.lit(1)).alias("articles"),
            F.sum("_words").alias("words"),
            F.max("_words").alias("longest"),
        ]


def apply_modules(articles: DataFrame, modules: list[AnalysisModule], by: list[str]) -> dict[str, DataFrame]:
    return {m.name: m.apply(articles, by) for m in modules}


def word_count_distribution(articles: DataFrame, width: int = 100, text: str = "description") -> DataFrame:
    """Articles per word-count bucket of ``width`` words."""
    n = word_count(articles, text)
    bucket = (F.floor(n / width) * width).cast("long")
    return articles.groupBy(bucket.alias("words_from")).agg(F.count(F.lit(1)).alias("n"))


def emerging_keys(counts: DataFrame, spec: WindowSpec, kind: str = "keyword") -> DataFrame:
    """Keys of a window with their share of it and of the window just before, vanished keys included.

    The counts are written once. A key's neighbours in time come from its own rows in order, one row per
    window, and the totals of windows are a small table beside them.
    """
    rows = materialise(counts.filter(F.col("kind") == kind).select("window_start", "key", "n"), "key-counts")
    step = F.expr(f"INTERVAL {spec.size_s} SECONDS")
    totals = rows.groupBy("window_start").agg(F.sum("n").alias("total"))
    next_total = totals.select((F.col("window_start") - step).alias("window_start"), F.lit(True).alias("next_exists"))
    totals = totals.join(next_total, "window_start", "left")
    order = Window.partitionBy("key").orderBy("window_start")
    share = F.col("n") / F.col("total")
    shares = rows.join(totals, "window_start").withColumn("share", share)
    goes_on = F.coalesce(F.lead("window_start").over(order) == F.col("window_start") + step, F.lit(False))
    came = F.when(F.lag("window_start").over(order) == F.col("window_start") - step, F.lag("share").over(order))
    placed = shares.select("*", goes_on.alias("_on"), F.coalesce(came, F.lit(0.0)).alias("previous_share"))

    def entry(start, n, share, previous):
        return F.struct(start.alias("window_start"), n.alias("n"), share.alias("share"), previous.alias("previous_share"))

    here = entry(F.col("window_start"), F.col("n"), F.col("share"), F.col("previous_share"))
    # a window without articles has no keys that vanished from it
    gone = F.when(
        ~F.col("_on") & F.col("next_exists"),
        entry(F.col("window_start") + step, F.lit(0).cast("long"), F.lit(0.0), F.col("share")),
    )
    both = placed.select("key", F.inline(F.array_compact(F.array(here, gone))))
    return both.select("window_start", "key", "n", "share", "previous_share")


def sentiment(articles: DataFrame, lexicon: DataFrame, by: list[str], text: str = "title") -> DataFrame:
    """Mean sentiment per group: an article scores the sum of its words' weights.

    ``lexicon`` has ``word, weight``. Words are counted per group before they
    meet the lexicon, so the join carries one row per distinct word.
    """
    n = articles.groupBy(*by).agg(F.count(F.lit(1)).alias("articles"))
    counted = (
        articles.select(*by, F.explode(words(F.col(text))).alias("word"))
        .groupBy(*by, "word")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    scored = counted.join(lexicon, "word").groupBy(*by).agg(
        F.sum(F.col("times") * F.col("weight")).alias("score"), F.sum("times").alias("scored_words")
    )
    total = F.coalesce(F.col("score"), F.lit(0.0))
    return n.join(scored, by, "left").select(
        *by,
        "articles",
        F.coalesce("scored_words", F.lit(0)).alias("scored_words"),
        (total / F.col("articles")).alias("mean_sentiment"),
    )


def _term_hash(word: Column, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), word)


def _vocabulary(worded: DataFrame) -> tuple[DataFrame, int, np.ndarray]:
    """The distinct words, written with their hashes; the salt that keeps the hashes apart, and these, frequent ones first."""
    found = worded.select(F.explode("_words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    found = materialise(found, "vocabulary")
    salt = 0
    while True:
        hashed = found.withColumn("hash", _term_hash(F.col("word"), salt))
        rows = hashed.select("hash", "n").toArrow()
        hashes, n = rows["hash"].to_numpy(), rows["n"].to_numpy()
        if len(np.unique(hashes)) == len(hashes):
            return hashed, salt, hashes[np.lexsort((hashes, -n))]
        salt += 1


def _term_counts(worded: DataFrame, keep: list[str], salt: int, hashes: np.ndarray) -> DataFrame:
    """Columns to ``keep`` with the places of an article's distinct words in the vocabulary, and how often each stands there."""
    order = np.argsort(hashes)
    shared = worded.sparkSession.sparkContext.broadcast((hashes[order], order))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered, places = shared.value
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            sizes = np.diff(column.offsets.to_numpy())
            different, which = np.unique(column.flatten().to_numpy(), return_inverse=True)
            article = np.repeat(np.arange(len(sizes)), sizes)
            place = places[np.searchsorted(ordered, different)][which]
            pairs, n = np.unique(article * len(places) + place, return_counts=True)
            article, place = np.divmod(pairs, max(1, len(places)))
            ends = np.searchsorted(article, np.arange(len(sizes) + 1)).astype("int32")
            lists = [pa.ListArray.from_arrays(ends, x.astype("int32")) for x in (place, n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], [*keep, "_terms", "_n"])

    hashed = worded.select(*keep, F.transform("_words", lambda w: _term_hash(w, salt)).alias("_hashes"))
    types = T.StructType([*hashed.schema.fields[:-1], *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("_terms", "_n")]])
    return hashed.mapInArrow(count, types)


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, their counts and the number of terms per article, of the last two columns."""
    terms, n = batch.columns[-2:]
    return terms.flatten().to_numpy(), n.flatten().to_numpy(), np.diff(terms.offsets.to_numpy())


def _together(batches: Iterator[pa.RecordBatch], rows: int = 40_000) -> Iterator[pa.RecordBatch]:
    """The batches joined into larger ones."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _sums_by_term(rows: DataFrame, weights: Broadcast, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """From all articles: terms, their counts by topic, the sum of the expected logarithms of shares, and articles with words."""
    names = [f"t{t}" for t in range(len(prior))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, logs, articles = np.zeros(weights.value.T.shape), np.zeros(len(prior)), 0
        for batch in _together(batches):
            found = lda.infer(*_lists(batch), weights.value, prior, sums)
            found = found[found[:, 0] > 0]
            logs += lda.expected_log(found, 1).sum(0)
            articles += len(found)
        terms = np.flatnonzero(sums.any(0))
        for lo in range(0, len(terms), 100_000):
            some = terms[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, "int32"), *map(pa.array, sums[:, some])], ["term", *names])
        # terms below 0 stand for the articles
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1], "int32"), *[pa.array([x, articles], "double") for x in logs]], ["term", *names])

    # a task sums over all its articles, so one per core sends the fewest sums
    few = rows.select("_terms", "_n").coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    partial = few.mapInArrow(count, ", ".join(["term int", *[f"{t} double" for t in names]]))
    got = partial.groupBy("term").agg(*[F.sum(t).alias(t) for t in names]).toArrow()
    terms, sums = got["term"].to_numpy(), np.array([got[t].to_numpy() for t in names])
    real = terms >= 0
    return terms[real], sums[:, real], sums[:, terms == -2][:, 0], round(sums[0, terms == -1][0])


def topics(
    articles: DataFrame, k: int, text: str = "title", described: int = 10, iterations: int = 10, seed: int = 1,
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """LDA topics: ``topic, word, weight`` of the ``described`` heaviest words, and the articles with their topic shares.

    Variational Bayes over every article in every iteration, with a prior of the articles fitted by Newton steps. Every
    word takes part. Keywords that are there, as ``<text>_keywords``, are taken as they are. The articles are read twice,
    for the words and for the counts; these are written with the columns of the articles, or those to ``keep``. The model
    is a weight per word and topic, so it, which grows with the vocabulary, must fit the driver and each Python worker.
    Shares of an article without words are zeros.
    """
    spark = articles.sparkSession
    found = F.col(f"{text}_keywords") if f"{text}_keywords" in articles.columns else keywords(F.col(text))
    worded = articles.withColumn("_words", F.coalesce(F.array_compact(found), F.array().cast("array<string>")))
    kept = list(articles.columns if keep is None else keep)
    vocabulary, salt, hashes = _vocabulary(worded.select("_words"))
    # read once per iteration and once for the shares, so the words are counted before
    rows = materialise(_term_counts(worded, kept, salt, hashes), "term-counts")

    # by topic and term; the random start is that of Hoffman's online LDA
    model = np.random.default_rng(seed).gamma(100, 1 / 100, (k, len(hashes)))
    prior = np.full(k, 1 / k)

    for _ in range(iterations if len(hashes) else 0):
        shared = spark.sparkContext.broadcast(lda.term_weights(model))
        terms, sums, logs, n = _sums_by_term(rows, shared, prior)
        shared.unpersist()
        model = np.full_like(model, 1 / k)
        model[:, terms] += sums
        prior = lda.new_prior(prior, logs / n, n)

    best = np.argsort(-model, axis=1, kind="stable")[:, :described]
    parts = model / model.sum(1, keepdims=True)
    heaviest = [(t, int(hashes[i]), float(parts[t, i])) for t in range(k) for i in best[t]]
    heaviest = spark.createDataFrame(heaviest, "topic int, hash long, weight double").join(vocabulary, "hash")
    shared = spark.sparkContext.broadcast(lda.term_weights(model))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = lda.infer(*_lists(batch), shared.value, prior)
            found /= np.maximum(found.sum(1, keepdims=True), 1e-300)
            lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype="int32") * k, found.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], lists], [*kept, "topic_shares"])

    types = T.StructType([*rows.schema.fields[:-2], T.StructField("topic_shares", T.ArrayType(T.DoubleType()))])
    return heaviest.select("topic", "word", "weight"), rows.mapInArrow(share, types)


def topic_evolution(shares: DataFrame, spec: WindowSpec) -> DataFrame:
    """Mean share of each topic per window."""
    start = F.window("ts", spec.size).start.alias("window_start")
    rows = shares.select(start, F.posexplode("topic_shares").alias("topic", "share"))
    return rows.groupBy("window_start", "topic").agg(F.avg("share").alias("mean_share"))
