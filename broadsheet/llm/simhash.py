"""SimHash fingerprints and exact near-duplicate groups through vantage-point trees.

Fingerprints: ASCII letters are lower-cased, words are runs between ASCII white
space, shingles are three words joined by a space (a shorter text is one
shingle, a text without words has fingerprint zero). A bit is set where it is
set in more than half of the shingles' XXH64 values (seed 42), repeats counted.

Groups: equal fingerprints are one class first, so exact copies cost one row.
Classes are dealt into shards by their Hamming distance to a few vantage points,
one bit per vantage point: within the median distance or beyond it. By the
triangle inequality a partner within the radius of a class can lie only in the
shards whose side its distance, give or take the radius, reaches; the class is
sent as a query to those boundary-overlapping shards and to no other. Inside a
shard, a vantage-point tree of the shard's own classes answers blocks of
queries, with the same bound at every branch. No pair within the radius is lost.

A block's pairs leave its task as a spanning forest, never as all pairs, and
components are found on those edges alone. Vantage points are a bounded number
of fingerprints (one per level); their choice affects speed only.

Defined cases: a null text is a text without words; a null id takes part, and a
component's id is the smallest id that is not null (null if there is none); rows
repeated in full all come back; an empty table gives an empty result. Only the
two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import fresh, hex64, tune
from broadsheet.llm.components import components
from broadsheet.session import materialise

SEED = 42
RADIUS = 3
SHARD_ROWS = 32_768  # aimed at, by halving with each vantage point
LEAF = 48
MIN_LEVELS = 3

# ---- fingerprints ---------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(3, len(tokens))
    h = xxhash.xxh64_intdigest
    spans = zip(starts[: len(tokens) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    values = np.fromiter((h(joined[a:b], SEED) for a, b in spans), np.uint64, len(tokens) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 65_536):
        block = values[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(ones * 2 > len(values), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        values = np.fromiter((fingerprint(t.as_py()) for t in b.column(2)), np.uint64, b.num_rows)
        columns = [b.column(0), b.column(1), pa.array(values.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, text_hash, fp`` per row; the fingerprint as a signed long with the same bits."""
    tune(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    )
    return rows.mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


# ---- vantage-point trees ---------------------------------------------------------


def _distance(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point)


def build(points: np.ndarray, at: np.ndarray | None = None, tries: int = 4):
    """A tree over ``points``: (vantage point, median, inner, outer), or the positions of a leaf."""
    at = np.arange(len(points)) if at is None else at
    if len(at) <= LEAF:
        return at
    best = None
    for k in np.linspace(0, len(at) - 1, tries).astype(int):
        vantage = points[at[k]]
        d = _distance(points[at], vantage)
        median = int(np.median(d))
        inner = d <= median
        if inner.all():
            median -= 1
            inner = d <= median
        size = int(inner.sum())
        spread = min(size, len(at) - size)
        if best is None or spread > best[0]:
            best = (spread, vantage, median, inner)
    spread, vantage, median, inner = best
    if not spread:
        return at
    return (vantage, median, build(points, at[inner]), build(points, at[~inner]))


def probe(tree, points: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in queries, in points) of all pairs within the radius, in blocks."""
    todo = [(tree, np.arange(len(queries)))]
    while todo:
        node, q = todo.pop()
        if not len(q):
            continue
        if isinstance(node, np.ndarray):
            step = max(1, (1 << 20) // max(1, len(node)))
            for k in range(0, len(q), step):
                part = q[k : k + step]
                near = np.bitwise_count(queries[part][:, None] ^ points[node][None, :]) <= radius
                i, j = np.nonzero(near)
                if len(i):
                    yield part[i], node[j]
            continue
        vantage, median, inner, outer = node
        d = _distance(queries[q], vantage).astype(np.int16)
        todo.append((inner, q[d <= median + radius]))
        todo.append((outer, q[d + radius > median]))


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest reachable position for each of ``n`` positions under the pairs."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def links_of_shard(homes: np.ndarray, queries: np.ndarray, tree=None) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect whatever lies within the radius, as a forest over both arrays' values."""
    values, place = np.unique(np.concatenate([homes, queries]), return_inverse=True)
    at_home, at_query = place[: len(homes)], place[len(homes) :]
    tree = build(homes) if tree is None else tree
    root = forest(len(values), ((at_query[i], at_home[j]) for i, j in probe(tree, homes, queries)))
    moved = np.nonzero(root != np.arange(len(values)))[0]
    return values[moved], values[root[moved]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``shard, fp, is_query`` come sorted: a shard's homes, then its queries, which are streamed."""
    shard, homes, tree = None, [], None

    def answer(queries: np.ndarray) -> pa.RecordBatch:
        u, v = links_of_shard(homes, queries, tree)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    for b in batches:
        shards = b.column(0).to_numpy()
        fps = b.column(1).to_numpy().view(np.uint64)
        is_query = b.column(2).to_numpy(zero_copy_only=False)
        cuts = np.nonzero((shards[1:] != shards[:-1]) | (is_query[1:] != is_query[:-1]))[0] + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(shards)], strict=True):
            if hi == lo:
                continue
            if shards[lo] != shard:
                if shard is not None and tree is None:  # a shard that nobody else asks
                    homes = np.concatenate(homes) if homes else np.array([], np.uint64)
                    tree = build(homes)
                    yield answer(homes)
                shard, homes, tree = shards[lo], [], None
            if not is_query[lo]:
                homes.append(fps[lo:hi])
                continue
            if tree is None:
                homes = np.concatenate(homes) if homes else np.array([], np.uint64)
                tree = build(homes)
                yield answer(homes)
            yield answer(fps[lo:hi])
    if shard is not None and tree is None:
        homes = np.concatenate(homes) if homes else np.array([], np.uint64)
        tree = build(homes)
        yield answer(homes)


# ---- groups ------------------------------------------------------------------------


def _vantage_points(classes: DataFrame, levels: int) -> list[int]:
    """One fingerprint per level, the same whatever the partitioning."""
    rows = classes.orderBy(F.xxhash64("fp"), "fp").limit(levels).collect()
    return [r["fp"] for r in rows]


def _medians(classes: DataFrame, points: list[int]) -> list[int]:
    ds = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))) for p in points]
    row = classes.agg(*[F.percentile_approx(d, 0.5).alias(f"m{k}") for k, d in enumerate(ds)]).first()
    return [int(m) for m in row]


def near_links(classes: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges ``u, v`` over distinct fingerprints ``fp`` that connect all pairs within the radius."""
    n = classes.count()
    levels = max(MIN_LEVELS, math.ceil(math.log2(max(1, n) / shard_rows)))
    points = _vantage_points(classes, levels)
    if not points:
        return classes.selectExpr("fp as u", "fp as v")
    medians = _medians(classes, points)
    rows = classes
    # one vantage point after another, so that expressions stay small
    rows = rows.withColumn("home", F.lit(0).cast("long")).withColumn("shard", F.lit(0).cast("long"))
    for k, (p, m) in enumerate(zip(points, medians, strict=True)):
        d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(p)))
        bit = F.lit(1 << k).cast("long")
        none = F.lit(None).cast("long")
        inner, outer = F.when(d - radius <= m, F.col("shard")), F.when(d + radius > m, F.col("shard") + bit)
        rows = rows.select(
            "fp",
            (F.col("home") + F.when(d > m, bit).otherwise(F.lit(0).cast("long"))).alias("home"),
            F.explode(F.filter(F.array(F.coalesce(inner, none), F.coalesce(outer, none)), lambda s: s.isNotNull())).alias("shard"),
        )
    rows = rows.select("shard", "fp", (F.col("home") != F.col("shard")).alias("is_query"))
    dealt = rows.repartition(2 ** len(points), "shard").sortWithinPartitions("shard", "is_query")
    return dealt.mapInArrow(_links, "u long, v long")


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` per row.

    ``root`` names the component of near fingerprints, ``component_id`` is the smallest id in it.
    """
    prints = materialise(fingerprints(docs, text, doc_id), "fingerprints")
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    stars = materialise(components(near_links(classes.select("fp"))), "components")
    members = classes.join(stars, F.col("fp") == F.col("node"), "left")
    members = members.select(F.col("fp").alias("class_fp"), "least", F.coalesce("root", "fp").alias("root"))
    ids = members.groupBy(F.col("root").alias("id_root")).agg(F.min("least").alias("component_id"))
    known = members.join(ids, F.col("root") == F.col("id_root")).select("class_fp", "root", "component_id")
    rows = prints.join(known, F.col("fp") == F.col("class_fp"))
    return rows.select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row its fingerprint as 16 hex digits and its component's smallest id."""
    return groups(docs, text, doc_id).select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document per group, the one with the smallest id; columns as given.

    Rows of a group that share this id are told apart by their text; a null id counts as the largest.
    """
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    first = groups(docs).groupBy("root").agg(F.min(order).alias("first"))
    first = first.select(F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    key = fresh(docs, "_text_hash")
    rows = docs.withColumn(key, text_hash(F.col("text"))).alias("d")
    same = (F.col(f"d.{key}") == F.col("k.first_hash")) & F.col("d.doc_id").eqNullSafe(F.col("k.first_id"))
    kept = rows.join(first.distinct().alias("k"), same, "left_semi")
    return kept.dropDuplicates(["doc_id", key]).select(*docs.columns)
