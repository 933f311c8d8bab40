"""Analysis modules and the optional analyses."""

import numpy as np
import pytest
from helpers import article, at, frame, values
from pyspark.sql import functions as F

from broadsheet.config import WindowSpec
from broadsheet.functions import lda
from broadsheet.functions.text import keywords
from broadsheet.operators import modules, windows
from broadsheet.plans import catalog, views


class Longest(modules.AnalysisModule):
    name = "longest"

    def aggregates(self):
        return [F.max(F.length("title")).alias("longest_title")]


def test_modules(spark):
    df = frame(spark, [article(1, 1, "a", "one"), article(2, 2, "b", "three", description="x y z")])
    found = modules.apply_modules(df, [modules.BasicStatistics(), Longest()], ["source"])
    assert values(found["longest"], "source", "longest_title") == [("a", 3), ("b", 5)]
    assert values(found["basic"], "source", "articles", "words") == [("a", 1, 1), ("b", 1, 3)]


def test_word_count_distribution(spark):
    df = frame(spark, [article(i, i, description="w " * n) for i, n in enumerate([0, 1, 99, 100, 250])])
    assert values(modules.word_count_distribution(df), "words_from", "n") == [(0, 3), (100, 1), (200, 1)]


def test_emerging_keys(spark):
    spec = WindowSpec.tumbling(60)
    rows = [article(1, 0, title="aaaa bbbb"), article(2, 60, title="aaaa cccc cccc cccc"), article(3, 180, title="aaaa aaaa")]
    counts = windows.window_key_counts(frame(spark, rows), spec, ("keyword",))
    got = values(modules.emerging_keys(counts, spec), "window_start", "key", "share", "previous_share")
    assert got == [
        (at(0), "aaaa", 0.5, 0.0), (at(0), "bbbb", 0.5, 0.0), (at(60), "aaaa", 0.25, 0.5), (at(60), "bbbb", 0.0, 0.5), (at(60), "cccc", 0.75, 0.0),
        (at(180), "aaaa", 1.0, 0.0),
    ]


def test_sentiment(spark):
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -2.0)], "word string, weight double")
    df = frame(spark, [article(1, 1, "a", "Good good day"), article(2, 2, "a", "bad"), article(3, 3, "b", "plain")])
    got = values(modules.sentiment(df, lexicon, ["source"]), "source", "articles", "scored_words", "mean_sentiment")
    assert got == [("a", 2, 3, 0.0), ("b", 1, 0, 0.0)]


def test_topics(spark):
    rows = [article(i, i * 60, title=("apple pear plum " if i % 2 else "engine wheel brake ") * 4) for i in range(40)]
    described, shares = modules.topics(frame(spark, rows), 2, iterations=20)
    words = {t: {r.word for r in described.filter(f"topic = {t}").orderBy(F.desc("weight")).limit(3).collect()} for t in (0, 1)}
    assert sorted(map(sorted, words.values())) == [["apple", "pear", "plum"], ["brake", "engine", "wheel"]]
    by_window = modules.topic_evolution(shares, WindowSpec.tumbling(600)).groupBy("window_start").agg(F.sum("mean_share").alias("s"))
    assert all(r.s == pytest.approx(1.0) for r in by_window.collect())


def test_topics_take_keywords_once(spark):
    """Keywords that are there need no text, and the shares are read from the written counts, not joined again."""
    texts = [(0, ["apple", "pear"] * 4), (1, ["engine", "wheel"] * 4)]
    texts = spark.createDataFrame(texts, "text_id long, title_keywords array<string>")
    rows = frame(spark, [article(i, i * 60) for i in range(20)]).select("ts", (F.col("doc_id") % 2).alias("text_id"))
    described, shares = modules.topics(rows.join(texts, "text_id"), 2, iterations=5)
    assert {r.word for r in described.collect()} == {"apple", "pear", "engine", "wheel"}
    assert "Join" not in shares._jdf.queryExecution().executedPlan().toString()
    assert shares.columns == ["text_id", "ts", "title_keywords", "topic_shares"] and shares.count() == 20
    _, shares = modules.topics(rows.join(texts, "text_id"), 2, iterations=1, keep=["ts"])
    assert shares.columns == ["ts", "topic_shares"] and shares.count() == 20


def plain_topics(articles, start, iterations, steps=20_000):
    """Shares and weights by the plain steps of variational Bayes, an article at a time."""
    k, model, prior = len(start), start, np.full(len(start), 1 / len(start))

    def settle(words, n):
        now = prior + n.sum() / k
        for _ in range(steps):
            shares = np.exp(lda.digamma(now))[:, None] * heavy[:, words]
            parts = shares / shares.sum(0) * n
            then = prior + parts.sum(1)
            if np.abs(then - now).max() < 1e-9:
                break
            now = then
        return then, parts

    for i in range(iterations + 1):
        heavy = np.exp(lda.expected_log(model, 1))
        found = [settle(*a) for a in articles]
        if i == iterations:
            return np.array([f / f.sum() for f, _ in found]), model
        model, logs = np.full(model.shape, 1 / k), 0
        for (words, _), (f, parts) in zip(articles, found):
            model[:, words] += parts
            logs = logs + lda.expected_log(f, 0)
        prior = lda.new_prior(prior, logs / len(articles), len(articles))


def test_topics_are_those_of_plain_steps(spark):
    """Every article counts in every iteration, however they lie in partitions; one without words has no shares."""
    rng = np.random.default_rng(7)
    titles = [" ".join(f"word{w}" for w in rng.integers(0, 8, rng.integers(1, 40)) + 8 * (i % 3)) for i in range(60)]
    rows = frame(spark, [article(i, i, title=t) for i, t in enumerate([*titles, "", None])]).cache()
    results = []
    for parts in (1, 7):
        described, shares = modules.topics(rows.repartition(parts), 3, described=30, iterations=4, keep=["doc_id"])
        results.append({r.doc_id: r.topic_shares for r in shares.collect()})
        weights = {(r.topic, r.word): r.weight for r in described.collect()}
    assert results[0][60] == results[0][61] == [0, 0, 0]
    # terms are numbered as the operator numbers them: frequent ones first, then by hash
    words = rows.select(F.explode(keywords(F.col("title"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    words = words.select("w", "n", F.xxhash64(F.lit(0), F.col("w")).alias("h")).collect()
    place = {r.w: i for i, r in enumerate(sorted(words, key=lambda r: (-r.n, r.h)))}
    counted = [np.unique([place[w] for w in t.split()], return_counts=True) for t in titles]
    start = np.random.default_rng(1).gamma(100, 1 / 100, (3, len(place)))
    expected, model = plain_topics(counted, start, 4)
    for got in results:
        assert max(np.abs(np.array(got[i]) - expected[i]).max() for i in range(60)) < 0.02
    by_topic = model / model.sum(1, keepdims=True)
    assert weights == {(t, w): pytest.approx(by_topic[t, i], abs=0.005) for t in range(3) for w, i in place.items()}
    assert all(results[0][i] == pytest.approx(results[1][i], abs=1e-6) for i in range(62))


def test_slow_and_long_articles_settle():
    """Articles of very different lengths, some undecided between topics, settle where plain steps do."""
    rng = np.random.default_rng(3)
    sizes = np.array([0, 1, 2, 3, 400, 30, 30, 31, 0, 5])
    words = np.concatenate([rng.permutation(500)[:n] for n in sizes]).astype("int32")
    counts = rng.integers(1, 4, sizes.sum()).astype("int32")
    weights, prior, sums = rng.gamma(100, 1 / 100, (500, 3)), np.full(3, 1 / 3), np.zeros((3, 500))
    got = lda.infer(words, counts, sizes, weights, prior, sums)
    assert (got[sizes == 0] == 0).all() and sums.sum() == pytest.approx(counts.sum())
    ends = np.cumsum(sizes)
    for i in np.flatnonzero(sizes):
        w, n, now = words[ends[i] - sizes[i] : ends[i]], counts[ends[i] - sizes[i] : ends[i]], got[i]
        shares = np.exp(lda.digamma(now)) * weights[w]
        then = prior + (shares / shares.sum(1, keepdims=True) * n[:, None]).sum(0)
        assert np.abs(then - now).mean() < 1e-3 and now.sum() == pytest.approx(n.sum() + 1)
    assert lda.digamma(np.array([1.0, 0.25])) == pytest.approx([-0.5772156649, -4.2274535334])
    assert lda.trigamma(np.array([1.0, 0.25])) == pytest.approx([np.pi**2 / 6, 17.1973291545])


def test_topics_without_any_word(spark):
    described, shares = modules.topics(frame(spark, [article(1, 1, title="")]), 2, keep=["doc_id"])
    assert described.collect() == [] and [tuple(r) for r in shares.collect()] == [(1, [0, 0])]


def test_title_topics_fits_as_often_as_the_operator(spark, folder):
    """The query leaves the number of iterations to the operator."""
    texts = [" ".join(f"word{(i * j) % 13}" for j in range(2, 9)) for i in range(30)]
    docs = [(i, t, "en", f"src{i % 3}") for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    events = spark.range(60).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id))").alias("ts"))
    events = events.withColumns({"user_id": F.lit(1).cast("long"), "event_type": F.lit("click"), "value": F.lit(1.0), "props": F.lit(None).cast("string")})
    events.write.parquet(f"{folder}/events.parquet")
    articles = views.articles(spark, folder)
    _, shares = modules.topics(articles, 4, keep=["ts"])
    expected = modules.topic_evolution(views.plain(shares).withColumn("ts", F.col("ts").cast("timestamp")), WindowSpec.tumbling(21_600))
    expected = {(r.window_start, r.topic): r.mean_share for r in views.plain(expected).collect()}
    got = {(r.window_start, r.topic): r.mean_share for r in catalog.QUERIES["title_topics"](spark, folder).collect()}
    assert got == {k: pytest.approx(v, abs=1e-6) for k, v in expected.items()} and len(got) == 4 * 10
