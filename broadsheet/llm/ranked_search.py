"""Exact ranked lexical search, term at a time, with a limit on new accumulators.

One pass over the texts writes a row per document: its number of terms, and number and
frequency of each of its terms that some query holds. Statistics of the corpus come from
that narrow table. A second pass searches it where it lies: a task gathers its rows into
blocks of bounded size, inverts a block into one list per term, and takes each query's
terms from the rarest on. Documents get an accumulator as long as the bounds of the terms
still to come can reach the kth best partial score of the block; from then on only
documents that have one are updated, exactly. A block gives its k best documents per
query, a task merges those of its blocks, and the k best of all are the result.

Scores are those of a saturating term weight with length normalisation, in whole numbers:
``w * ((1000000000 * tf) div (1000 * tf + 20 * m))`` summed over the query's distinct terms,
``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))``, ``m = 50 + (50 * n * N) div L``, where N
counts the documents with a term and L all their terms.

Queries are taken in parts whose texts hold at most ``QUERY_BYTES`` together (or one
query), so that what every task is sent has a bound; each part passes over the texts once.

Defined cases: a null or blank text, of a document or a query, has no terms; queries
without a term in the corpus have no rows; documents repeated in full each count and rank
of their own, a null id behind all others of its score; queries repeated in full count once,
queries that share an id but not the text are each ranked; empty tables give an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import tune
from broadsheet.session import materialise

QUERY_BYTES = 4 << 20
POSTINGS = 4_000_000  # of a block, besides those of its last batch

# fixed: terms are runs of ASCII letters and digits and of all other characters beyond ASCII; only A-Z are lowered
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
RESULT = "item_id long, rank int, doc_id long, score long"


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8."""
    return (text or b"").translate(_TERM_BYTES).split()


class Index:
    """Lists of (document, frequency) per term over one block of documents."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray):
        # documents in the order in which equal scores rank; a null id comes as the largest long
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.lengths = ids[order], lengths[order]
        doc = place[doc]
        by_term = np.lexsort((doc, term))
        self.doc, self.tf = doc[by_term], tf[by_term]
        self.terms, first = np.unique(term[by_term], return_index=True)
        self.range = dict(zip(self.terms.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(doc)], strict=True), strict=True))

    def weigh(self, weights: np.ndarray, n_docs: int, all_terms: int) -> None:
        """Impact of every entry, and the largest impact of every term."""
        m = 50 + (50 * self.lengths * n_docs) // max(all_terms, 1)
        gain = (1_000_000_000 * self.tf) // (1000 * self.tf + 20 * m[self.doc])
        starts = [a for a, _ in self.range.values()]
        self.impact = gain * np.repeat(weights[self.terms], np.diff([*starts, len(gain)]))
        most = np.maximum.reduceat(self.impact, starts) if starts else np.zeros(0, np.int64)
        self.most = dict(zip(self.range, most.tolist(), strict=True))

    def best(self, query: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents; ``query`` lists its terms from the rarest on."""
        query = [t for t in query if self.most.get(t, 0) > 0]
        left = sum(self.most[t] for t in query)
        score = np.zeros(len(self.ids), np.int64)  # an accumulator per document; it has begun once it is above 0
        begun = None  # the documents that have one, when no more may begin
        for t in query:
            a, b = self.range[t]
            found, impact = self.doc[a:b], self.impact[a:b]
            if begun is None and len(score) > k and np.partition(score, len(score) - k)[len(score) - k] > left:
                begun = np.nonzero(score)[0]
            if begun is None:
                score[found] += impact
            elif 8 * len(begun) < len(found):  # look the few up in the list
                at = np.minimum(np.searchsorted(found, begun), len(found) - 1)
                met = found[at] == begun
                score[begun[met]] += impact[at[met]]
            else:
                met = score[found] > 0
                score[found[met]] += impact[met]
            left -= self.most[t]
        docs = np.nonzero(score)[0] if begun is None else begun
        if len(docs) > k:
            # those that equal the kth score are all kept for the sort
            floor = np.partition(score[docs], len(docs) - k)[len(docs) - k]
            docs = docs[score[docs] >= floor]
        order = np.lexsort((docs, -score[docs]))[:k]
        return docs[order], score[docs[order]]


def _forward(docs: DataFrame, vocabulary, text: str, doc_id: str) -> DataFrame:
    """``doc_id, n, terms, tfs`` per document that has terms: the numbers of its terms in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for b in batches:
            ids, sizes, counts, numbers, tfs = [], [], [], [], []
            for doc, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if found := terms(raw):
                    held = Counter(filter(known.__contains__, found))
                    ids.append(doc)
                    sizes.append(len(found))
                    counts.append(len(held))
                    numbers += map(known.__getitem__, held)
                    tfs += held.values()
            offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (numbers, tfs)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


_LAST = np.iinfo(np.int64).max  # the place of a null id


def _search(forward: DataFrame, asked, k: int, weights: np.ndarray, n_docs: int, all_terms: int) -> DataFrame:
    """``query, doc_id, score``: the k best documents of each partition for each query."""

    def block(parts: list[pa.RecordBatch]) -> Index:
        rows = pa.Table.from_batches(parts).combine_chunks()
        lists = [rows.column(c).combine_chunks() for c in ("terms", "tfs")]
        size = np.diff(lists[0].offsets.to_numpy())
        ids = rows.column("doc_id").fill_null(_LAST).to_numpy()
        term, tf = (c.flatten().to_numpy().astype(np.int64) for c in lists)
        index = Index(ids, rows.column("n").to_numpy(), term, np.repeat(np.arange(len(ids)), size), tf)
        index.weigh(weights, n_docs, all_terms)
        return index

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, kept = asked.value, {}

        def search(parts: list[pa.RecordBatch]) -> None:
            index = block(parts)
            for key, query in queries:
                at, score = index.best(query, k)
                ids = index.ids[at]
                if key in kept:
                    ids, score = np.concatenate([kept[key][0], ids]), np.concatenate([kept[key][1], score])
                    order = np.lexsort((ids, -score))[:k]
                    ids, score = ids[order], score[order]
                if len(ids):
                    kept[key] = ids, score

        parts, held = [], 0
        for b in batches:
            parts.append(b)
            held += len(b.column("terms").flatten())
            if held >= POSTINGS:
                search(parts)
                parts, held = [], 0
        if parts:
            search(parts)
        for key, (ids, score) in kept.items():
            doc_id = pa.array(ids, pa.int64(), mask=ids == _LAST)
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(ids), pa.int64()), doc_id, pa.array(score)], ["query", "doc_id", "score"])

    return forward.mapInArrow(run, "query long, doc_id long, score long")


def _parts(queries: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Queries with their distinct terms, in lists of bounded size."""
    rows = queries.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("binary").alias("text")).distinct()
    part, held = [], 0
    for item, raw in rows.orderBy("item_id", "text").toLocalIterator():
        if part and held + len(raw or b"") > QUERY_BYTES:
            yield part
            part, held = [], 0
        part.append((item, sorted(set(terms(bytes(raw or b""))))))
        held += len(raw or b"")
    if part:
        yield part


def rank(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each query with a score above 0."""
    spark = tune(docs.sparkSession)
    out = spark.createDataFrame([], RESULT)
    for part in _parts(queries, item_id, query_text):
        out = out.union(_rank_part(docs, part, k, text, doc_id))
    return out


def _rank_part(docs: DataFrame, part: list[tuple[int | None, list[bytes]]], k: int, text: str, doc_id: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in part for t in ts}))}
    sent = spark.sparkContext.broadcast(vocabulary)
    forward = materialise(_forward(docs, sent, text, doc_id), "term-lists")
    n_docs, all_terms = forward.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for t, n in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # as many as the vocabulary
        df[t] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) if f else 0 for f in df.tolist()], np.int64)
    asked = []
    for key, (_, ts) in enumerate(part):
        known = [t for t in (vocabulary[t] for t in ts) if weights[t] > 0]
        asked.append((key, sorted(known, key=lambda t: (df[t], t))))
    found = _search(forward, spark.sparkContext.broadcast(asked), k, weights, n_docs, all_terms or 0)

    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    items = spark.createDataFrame([(key, item) for key, (item, _) in enumerate(part)], "query long, item_id long")
    return ranked.join(F.broadcast(items), "query").select("item_id", "rank", "doc_id", "score")
