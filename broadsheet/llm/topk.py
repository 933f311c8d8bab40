"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are dealt into blocks. A block keeps, per dimension, its vectors
sorted by that component, and walks all lists in step from both ends: a positive
weight has its largest products at one end, a negative one at the other. The
vectors met at a step are scored in full for all queries still open, as one matrix
product. A query is closed once the bound (the sum of its products at the present
depth, which no unseen vector can exceed) lies below its kth score. A tie with the
bound goes on, since an unseen vector could have the smaller id. Each block gives
at most k rows per query; their ranking is the result.

A candidate is sent once, to its block; queries are sent to every block, since the
search is exact, and pass it batch after batch. A task holds one block and one
batch of queries, whatever the tables hold.

Defined cases: vectors that are null, or hold a null or non-finite component, and
rows without an id take no part; rows with the same id and vector count once;
rows that share an id but not the vector are each a query and a candidate, and
an id is never its own neighbour; a shorter vector is continued with zeros; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.session import materialise

CANDIDATES = 8_192  # per block
QUERIES = 256  # scored by one matrix product
FIRST_DEPTH = 8
EXACT = 2**53  # sums of products below this are exact in doubles


def quantise(df: DataFrame, vec_id: str, vector: str, scale: int = 256) -> DataFrame:
    """``vec_id, v``: components as ``floor(scale * x)``; rows that take no part are left out."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )
    v = F.transform(x, lambda c: F.floor(scale * c.cast("double")).cast("long"))
    rows = df.filter(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), F.when(usable, v).alias("v"))
    return rows.filter(F.col("v").isNotNull()).distinct()


def matrix(vectors: pa.ListArray, width: int | None = None) -> np.ndarray:
    """One row per vector, continued with zeros or cut to ``width``."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0)) if width is None else width
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row[place < width], place[place < width]] = flat[place < width]
    return out


class Lists:
    """Sorted lists per dimension over one block of candidates."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        # one list per dimension, largest component first
        self.order = np.argsort(-self.values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, self.order, 0)
        self.most = int(np.abs(self.values).max(initial=0))
        self.floats = self.values.astype(np.float64)

    def top(self, q_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates with another id; ties to the smaller id."""
        return self.search(np.array([q_id]), q[None, :], k)[0]

    def search(self, q_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for several queries, one per row."""
        exact = np.abs(queries).sum(1, dtype=np.float64) * self.most < EXACT / 2
        out: list = [None] * len(q_ids)
        for mine, values, kind in ((exact, self.floats, np.float64), (~exact, self.values, np.int64)):
            which = np.nonzero(mine)[0]
            for i, found in zip(which, self._walk(q_ids[which], queries[which].astype(kind), values, k), strict=True):
                out[i] = found
        return out

    def _walk(self, q_ids: np.ndarray, weights: np.ndarray, values: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        n, width = self.values.shape
        up, down = np.maximum(weights, 0), np.minimum(weights, 0)
        # rows with a query's own id are scored with the others and left out afterwards
        own = np.searchsorted(self.ids, q_ids, "right") - np.searchsorted(self.ids, q_ids)
        best = [(np.array([], np.int64), np.array([], weights.dtype)) for _ in q_ids]
        least = -np.inf if weights.dtype == np.float64 else np.iinfo(np.int64).min
        kth = np.full(len(q_ids), least, weights.dtype)
        open_, seen, depth, step = np.arange(len(q_ids)), np.zeros(n, bool), 0, FIRST_DEPTH
        while len(open_) and depth < n:
            end = min(n, depth + step) if width else n
            met = np.full(n, not width)
            met[self.order[depth:end].ravel()] = True
            met[self.order[n - end : n - depth].ravel()] = True
            new = np.nonzero(met & ~seen)[0]
            seen[new] = True
            scores = weights[open_] @ values[new].T
            for i, row in zip(open_.tolist(), scores, strict=True):
                at = np.nonzero(row >= kth[i])[0]
                spare = len(at) - k - int(own[i])
                if spare > 0:
                    at = at[row[at] >= np.partition(row[at], spare)[spare]]
                at = at[self.ids[new[at]] != q_ids[i]]
                if len(at):
                    ids, score = np.append(best[i][0], self.ids[new[at]]), np.append(best[i][1], row[at])
                    order = np.lexsort((ids, -score))[:k]
                    best[i] = ids[order], score[order]
                    if len(order) == k:
                        kth[i] = best[i][1][-1]
            bound = up[open_] @ self.sorted[end - 1] + down[open_] @ self.sorted[n - end]
            open_ = open_[kth[open_] <= bound]
            depth, step = end, step * 4
        return [(ids, score.astype(np.int64)) for ids, score in best]


_FOUND = pa.schema([(c, pa.int64()) for c in ("query_id", "query_key", "vec_id", "score")])


def _search(k: int, group: int):
    """Rows sorted by block, the candidates of a block before the queries."""

    def answers(lists: Lists, asked: pa.RecordBatch) -> pa.RecordBatch:
        q_ids, keys = asked.column("vec_id").to_numpy(), asked.column("key").to_numpy()
        queries = matrix(asked.column("v"), lists.values.shape[1])
        found = []
        for lo in range(0, len(q_ids), group):
            found += lists.search(q_ids[lo : lo + group], queries[lo : lo + group], k)
        sizes = [len(ids) for ids, _ in found]
        columns = [np.repeat(q_ids, sizes), np.repeat(keys, sizes), *(np.concatenate(c) for c in zip(*found, strict=True))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, lists = None, [], None
        for b in batches:
            c, is_query = (b.column(x).to_numpy(zero_copy_only=False) for x in ("c", "is_query"))
            cuts = np.nonzero((c[1:] != c[:-1]) | (is_query[1:] != is_query[:-1]))[0] + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(c)], strict=True):
                if lo == hi:
                    continue
                if c[lo] != block:
                    block, held, lists = c[lo], [], None
                part = b.slice(int(lo), int(hi - lo))
                if not is_query[lo]:
                    held.append(part)
                elif held or lists:
                    if lists is None:
                        rows = pa.Table.from_batches(held).combine_chunks()
                        vectors = rows.column("v").combine_chunks()
                        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
                        lists, held = Lists(rows.column("vec_id").to_numpy(), matrix(vectors)), []
                    yield answers(lists, part)

    return run


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def top_k(
    df: DataFrame,
    k: int = 5,
    queries_every: int = 50,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of every row whose id is divisible by ``queries_every``."""
    rows = quantise(df, vec_id, vector).withColumn("key", F.xxhash64("vec_id", "v"))
    rows = materialise(rows, "vectors")
    asked = rows.filter(F.col("vec_id") % queries_every == 0)
    blocks = max(1, -(-rows.count() // candidates))
    cells = rows.select(F.pmod("key", F.lit(blocks)).alias("c"), F.lit(False).alias("is_query"), "vec_id", "key", "v").union(
        asked.select(F.explode(_numbers(blocks)).alias("c"), F.lit(True).alias("is_query"), "vec_id", "key", "v")
    )
    dealt = cells.repartition(min(blocks, 100_000), "c").sortWithinPartitions("c", "is_query")
    found = dealt.mapInArrow(_search(k, queries), "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
