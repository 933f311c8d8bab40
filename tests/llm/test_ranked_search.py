"""Ranked search against scoring of every document, and defined cases."""

import math
import random
import re
from collections import Counter

import numpy as np

import __spark_entry__ as entry
from broadsheet.llm import queries, ranked_search
from broadsheet.llm.common import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def expected(docs, items, k=50):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c) for i, c in bags if c]
    n_docs, all_terms = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, c in bags:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // all_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_terms():
    for t in ["", "A-b c1É ÉA\x7fß_x", "日本 語Ｚ　x", "İ K ſ \x00a\x1f", "a" * 10_000]:
        assert [x.decode() for x in ranked_search.terms(t.encode())] == terms(t)


def test_random_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "POSTINGS", 100)
    dice = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(dice.choices(vocabulary, weights, k=dice.randrange(30)))) for i in range(700)]
    docs += [(1000 + i, docs[7][1]) for i in range(200)]  # ties
    items = [(i, " ".join(dice.choices(vocabulary, k=8))) for i in range(25)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    queries_df = spark.createDataFrame(items, "item_id long, text string")
    want = expected(docs, items)
    assert got(ranked_search.rank(df, queries_df)) == want
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 100)
    assert got(ranked_search.rank(df, queries_df)) == want


def test_accumulators_are_limited_and_exact():
    rng = np.random.default_rng(2)
    n_docs, n_terms = 4000, 12
    held = rng.random((n_docs, n_terms)) < np.linspace(0.01, 0.9, n_terms)
    doc, term = np.nonzero(held)
    tf = rng.integers(1, 4, len(doc))
    lengths = rng.integers(5, 50, n_docs)
    ids = rng.permutation(n_docs)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for c in held.sum(0)], np.int64)
    index = ranked_search.Index(ids, lengths, term, doc, tf)
    index.weigh(weights, n_docs, int(lengths.sum()))
    full = np.zeros(n_docs, np.int64)
    m = 50 + (50 * lengths * n_docs) // lengths.sum()
    np.add.at(full, doc, weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])))
    order = np.lexsort((ids, -full))
    for k in (1, 5, 50, 5000):
        at, score = index.best(list(range(n_terms)), k)
        top = order[:k][full[order[:k]] > 0]
        assert index.ids[at].tolist() == ids[top].tolist() and score.tolist() == full[top].tolist()


def test_defined_cases(spark):
    docs = [(1, "apple Pear", "x"), (1, "apple Pear", "x"), (None, "apple pear", "y"), (2, None, None), (3, "", ""), (4, "...", "z"), (5, "fig " * 20_000, "z")]
    items = [(7, "APPLE apple", "q"), (7, "APPLE apple", "q"), (7, "pear fig", "r"), (None, "fig", "s"), (8, None, "t"), (9, "kiwi", "u")]
    d = spark.createDataFrame(docs, "doc_id long, text string, n string")
    q = spark.createDataFrame(items, "item_id long, text string, query string")
    want = expected([r[:2] for r in docs], [r[:2] for r in items])
    assert got(ranked_search.rank(d, q)) == want and len(want) > 5
    assert got(ranked_search.rank(d.limit(0), q)) == got(ranked_search.rank(d, q.limit(0))) == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()]
    assert got(queries.QUERIES["op13_ranked_search"](spark, folder)) == expected(docs, items)
    assert "op13_ranked_search" in entry.oracle_sql()
