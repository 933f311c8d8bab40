"""Near-duplicate texts by five-word shingles and their Jaccard similarity.

Texts count as near when the sets of their shingles (ASCII letters lower-cased,
words between ASCII white space, five words; a shorter text is one shingle) have
a similarity of 0.8 or more. Such texts differ in some 10 of 64 SimHash bits, a
radius at which vantage shards over a whole corpus overlap each other entirely.
So min-hash bands deal the texts into cells first (16 bands of 5 rows), and
vantage-point trees over the fingerprints search within the cells:

1. Equal texts become one class, so exact copies cost one row.
2. Every class of a cell is compared with the smallest class of that cell. Groups
   of copies become connected by these stars, never by all their pairs.
3. Cells that still hold several components are searched in full by trees of
   their fingerprints. Of the pairs across components each class proposes its
   nearest ones; their links join components, and a further round proposes more,
   from what is still apart, until every pair that is left has been compared. A
   cell of more than ``CELL_ROWS`` classes is cut into slices, and every two
   slices meet in a group of their own, so no task holds a whole large cell.

A pair is a link only if the shingle sets themselves are as similar as asked, so
there are no false links. Links are missed only by chance, at exactly 0.8 about 3
of 1,000 pairs, and fewer above: by the bands (0.17 %), by more than ``RADIUS``
differing bits of the fingerprint (0.1 %) or more than ``SKETCH_BITS`` of the 128
min-hash bits (0.05 %) or ``SKETCH_BYTES`` of their 128 bytes (0.02 %). Shingles are compared by 64-bit hashes.

Texts themselves are dealt out twice, however many rounds there are: once to find
those that share a cell, which are written and read by every round, and once to find
the kept documents and remove repeated rows. Rounds deal the texts of cells that
have a candidate partner, and their shingle hashes.

Defined cases: a null text is the empty text; texts without words are near each
other and nothing else; a null id takes part and counts as the largest; of rows
repeated in full one stays; an empty table stays empty; further columns come
along untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import fresh, tune
from broadsheet.llm.components import components
from broadsheet.llm.simhash import build, probe
from broadsheet.session import materialise

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 5
HASHES = 128  # min-hash values; the bands use the first of them, the sketch one bit of each
RADIUS = 18
SKETCH_BITS = 24
SKETCH_BYTES = 42  # bytes of the min-hash values that may differ, one of each
CELL_ROWS = 2_048
PROPOSED, WIDER = 2, 8  # pairs a class proposes in the first round, and how many times more in each further one
BLOCK = 4_096  # shingles permuted at a time

# multipliers (odd) and increments of the permutations, the same in every task
_random = np.random.default_rng(42)
_TIMES = _random.integers(0, 2**64, HASHES, np.uint64) | np.uint64(1)
_PLUS = _random.integers(0, 2**64, HASHES, np.uint64)
_MIX = _random.integers(0, 2**64, (BANDS, ROWS), np.uint64) | np.uint64(1)
_BAND = _random.integers(0, 2**64, BANDS, np.uint64)


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text; none for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.array([], np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(size, len(words))
    n = len(words) - k + 1
    h = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((h(joined[a:b]) for a, b in spans), np.uint64, n))


def sketch(values: np.ndarray) -> tuple[int, int, int, np.ndarray, bytes]:
    """SimHash of the distinct shingles, two words of min-hash bits, keys of the bands (signed longs), min-hash bytes."""
    ones, least = np.zeros(64, np.int64), np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(values), BLOCK):
        block = values[at : at + BLOCK]
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        np.minimum(least, (block[None, :] * _TIMES[:, None] + _PLUS[:, None]).min(axis=1), out=least)
    fp = np.packbits(ones * 2 > len(values), bitorder="little").view("<i8")[0]
    # the high bits of a minimum are nearly constant, its middle is not
    low = np.packbits((least >> np.uint64(20) & np.uint64(1)).astype(np.uint8)).view("<i8")
    keys = (least[: BANDS * ROWS].reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) + _BAND
    keys = (keys ^ keys >> np.uint64(31)) * _TIMES[0]
    return int(fp), int(low[0]), int(low[1]), keys.view(np.int64), (least >> np.uint64(20)).astype(np.uint8).tobytes()


_SKETCHES = "doc_id long, h1 long, h2 long, fp long, s1 long, s2 long, bands array<long>, bytes binary"


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [sketch(shingles(t.as_py(), size)) for t in b.column(3)]
            fps, s1, s2 = (pa.array([r[k] for r in rows], pa.int64()) for k in range(3))
            keys = np.concatenate([r[3] for r in rows]) if rows else np.array([], np.int64)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * BANDS), pa.array(keys))
            columns = [b.column(0), b.column(1), b.column(2), fps, s1, s2, bands, pa.array([r[4] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2", "fp", "s1", "s2", "bands", "bytes"])

    return run


def _hashes(text: Column) -> tuple[Column, Column]:
    """Two hashes of a text under seeds of their own: 128 bits that stand for it."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(F.lit("first"), text), F.xxhash64(F.lit("second"), text)


def _bits(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def classes_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = WORDS) -> DataFrame:
    """One row per different text: ``node, h1, h2, least, fp, s1, s2, bands, bytes``; ``least`` is its smallest id."""
    tune(docs.sparkSession)
    h1, h2 = _hashes(F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), h1.alias("h1"), h2.alias("h2"), F.col(text).alias("text"))
    rows = rows.mapInArrow(_sketches(size), _SKETCHES)
    kinds = rows.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("least"), *[F.any_value(c).alias(c) for c in ("fp", "s1", "s2", "bands", "bytes")]
    )
    # numbers are given once, in the written table
    return materialise(kinds.withColumn("node", F.monotonically_increasing_id()), "text-classes")


# ---- candidates ---------------------------------------------------------------------


def _ends(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``u, v`` whose sketches allow the similarity."""
    side = classes.select("node", "fp", "s1", "s2")
    u, v = (side.toDF(e, *[f"{e}_{c}" for c in ("fp", "s1", "s2")]) for e in "uv")
    both = pairs.join(u, "u").join(v, "v")
    near = (_bits("u_fp", "v_fp") <= RADIUS) & (_bits("u_s1", "v_s1") + _bits("u_s2", "v_s2") <= SKETCH_BITS)
    return both.filter(near).select("u", "v")


def _search(nodes, fps, sketches, roots, home, same_slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of one group that may be near and lie in different components, and their differing bytes."""
    a, b = (np.arange(len(nodes)),) * 2 if same_slice else (np.nonzero(home)[0], np.nonzero(~home)[0])
    none = np.array([], np.int64)
    found = [(none, none, none)]
    for i, j in probe(build(fps[a]), fps[a], fps[b], RADIUS):
        i, j = b[i], a[j]
        ok = roots[i] != roots[j]
        if same_slice:
            ok &= nodes[i] < nodes[j]
        i, j = i[ok], j[ok]
        for at in range(0, len(i), 1 << 16):
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            apart = (sketches[x] != sketches[y]).sum(axis=1)
            ok = apart <= SKETCH_BYTES
            found.append((nodes[x[ok]], nodes[y[ok]], apart[ok]))
    u, v, apart = (np.concatenate(c) for c in zip(*found, strict=True))
    return np.minimum(u, v), np.maximum(u, v), apart


def _nearest(u: np.ndarray, v: np.ndarray, apart: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the ``most`` nearest of either end."""
    kept = np.zeros(len(u), bool)
    for end, other in ((u, v), (v, u)):
        order = np.lexsort((other, apart, end))
        first = np.nonzero(np.diff(end[order], prepend=-1))[0]
        place = np.arange(len(end)) - np.repeat(first, np.diff(np.append(first, len(end))))
        kept[order[place < most]] = True
    return kept


def _across(most: int):
    """Rows ``cell, a, b, home, node, root, fp, bytes`` come sorted by the first three; a group is bounded."""

    def answer(c: list[np.ndarray]) -> pa.RecordBatch:
        cuts = np.nonzero((c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1]) | (c[2][1:] != c[2][:-1]))[0] + 1
        out = []
        for lo, hi in zip([0, *cuts], [*cuts, len(c[0])], strict=True):
            fps, home = c[6][lo:hi].view(np.uint64), c[3][lo:hi].astype(bool)
            u, v, apart = _search(c[4][lo:hi], fps, c[7][lo:hi], c[5][lo:hi], home, c[1][lo] == c[2][lo])
            kept = _nearest(u, v, apart, most)
            out.append((u[kept], v[kept], np.full(int(kept.sum()), not kept.all())))
        u, v, cut = (pa.array(np.concatenate(x)) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([u, v, cut], ["u", "v", "cut"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [x.to_numpy(zero_copy_only=False) for x in batch.columns[:7]]
            now.append(np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint8).reshape(-1, HASHES))
            held = now if held is None else [np.concatenate(p) for p in zip(held, now, strict=True)]
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
            start = int(np.argmax(last))
            if start:
                yield answer([x[:start] for x in held])
                held = [x[start:] for x in held]
        if held is not None:
            yield answer(held)

    return run


def _unconnected(cells: DataFrame, classes: DataFrame, stars: DataFrame, cell_rows: int, most: int) -> DataFrame:
    """Candidate pairs ``u, v`` across components, from all cells that hold several; ``cut`` if there are more."""
    roots = stars.select(F.col("node").alias("r_node"), "root")
    members = cells.join(roots, F.col("node") == F.col("r_node"), "left")
    members = members.select("cell", "n", "node", F.coalesce("root", "node").alias("root"))
    several = members.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi")
    rows = members.join(several.select("cell"), "cell").join(classes.select("node", "fp", "bytes"), "node")
    slices = F.ceil(F.col("n") / cell_rows).cast("long")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), slices)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))
    )
    rows = rows.select(
        "cell", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        (F.col("own") <= F.col("other")).cast("int").alias("home"), "node", "root", "fp", "bytes",
    )
    keys = ["cell", "a", "b"]
    pairs = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_across(most), "u long, v long, cut boolean")
    return pairs.groupBy("u", "v").agg(F.max("cut").alias("cut"))


# ---- links -----------------------------------------------------------------------------


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t.as_py(), size).view(np.int64) for t in b.column(1)]
            for node, values in zip(b.column(0), found, strict=True):  # a row at a time: a text may be very long
                one = pa.array([values.tolist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([node.as_py()], pa.int64()), one], ["node", "grams"])

    return run


def cell_texts(docs: DataFrame, classes: DataFrame, cells: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``node, text`` of every class that shares a cell; a row that is repeated in full comes as often."""
    inside = cells.select(F.col("node").alias("c_node")).distinct()
    wanted = classes.join(inside, F.col("node") == F.col("c_node")).select("node", "least", F.col("h1").alias("c1"), F.col("h2").alias("c2"))
    h1, h2 = _hashes(F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), h1.alias("h1"), h2.alias("h2"), F.col(text).alias("text"))
    same = (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")) & F.col("doc_id").eqNullSafe(F.col("least"))
    return materialise(rows.join(wanted, same).select("node", "text"), "cell-texts")


def similar(pairs: DataFrame, texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """The pairs ``u, v`` whose shingle sets are as similar as asked; ``texts`` has the ``node, text`` of their ends."""
    needed = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    grams = texts.join(needed, "node", "left_semi").select("node", "text").mapInArrow(_sets(size), "node long, grams array<long>")
    grams = materialise(grams.groupBy("node").agg(F.any_value("grams").alias("grams")), "shingle-sets")
    both = pairs.join(grams.toDF("u", "u_grams"), "u").join(grams.toDF("v", "v_grams"), "v")
    common, total = F.size(F.array_intersect("u_grams", "v_grams")), F.size("u_grams") + F.size("v_grams")
    near = (F.col("total") == 0) | (F.col("common") + F.lit(1e-9) >= similarity * (F.col("total") - F.col("common")))
    sized = both.select("u", "v", common.alias("common"), total.alias("total"))
    return materialise(sized.filter(near).select("u", "v"), "links")


def groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    similarity: float = SIMILARITY, size: int = WORDS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``h1, h2, least, root`` per different text: its hashes, its smallest id, and its group's name."""
    classes = classes_of(docs, text, doc_id, size)
    cells = classes.select("node", F.explode(F.array_distinct("bands")).alias("cell"))
    hubs = cells.groupBy("cell").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    cells = materialise(cells.join(hubs, "cell"), "cells")
    texts = cell_texts(docs, classes, cells, text, doc_id)
    star = cells.filter("node != hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    tested = materialise(_ends(star, classes), "candidates")
    links = similar(tested, texts, similarity, size)
    stars = materialise(components(links), "components")
    most, cut = PROPOSED, True
    while cut:
        pairs = materialise(_unconnected(cells, classes, stars, cell_rows, most), "candidates")
        cut = pairs.filter("cut").limit(1).count() > 0
        new = materialise(pairs.select("u", "v").join(tested, ["u", "v"], "left_anti"), "new-candidates")
        more = similar(new, texts, similarity, size)
        if not more.isEmpty():
            links = links.union(more)
            stars = materialise(components(links), "components")
        tested, most = tested.union(new), most * WIDER
    stars = stars.select(F.col("node").alias("s_node"), "root")
    members = classes.join(stars, F.col("node") == F.col("s_node"), "left")
    return members.select("h1", "h2", "least", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """``doc_id, component_id`` per row: the smallest id of its group (null if all are null)."""
    members = materialise(groups(docs, text, doc_id, **how), "members")
    ids = members.groupBy(F.col("root").alias("id_root")).agg(F.min("least").alias("component_id"))
    known = members.join(ids, F.col("root") == F.col("id_root")).select("h1", "h2", "component_id")
    h1, h2 = _hashes(F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), h1.alias("h1"), h2.alias("h2"))
    return rows.join(known, ["h1", "h2"]).select("doc_id", "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """One document per group, the one with the smallest id; columns as given.

    Texts of a group that share this id are told apart by their hashes.
    """
    order = F.struct(F.col("least").isNull().alias("nameless"), "least", "h1", "h2")
    first = groups(docs, text, doc_id, **how).groupBy("root").agg(F.min(order).alias("k")).select("k.least", "k.h1", "k.h2")
    h1, h2 = _hashes(F.col(text))
    # plain columns without nulls, the same for the join and the repeated rows: texts are dealt out once for both
    a, b, i, n = (fresh(docs, c) for c in ("_h1", "_h2", "_id", "_nameless"))
    number = F.col(doc_id).cast("long")
    rows = docs.withColumns({a: h1, b: h2, i: F.coalesce(number, F.lit(0)), n: number.isNull()})
    named = F.coalesce("least", F.lit(0)).alias(i), F.col("least").isNull().alias(n)
    first = first.select(F.col("h1").alias(a), F.col("h2").alias(b), *named)
    return rows.join(first, [a, b, i, n], "left_semi").dropDuplicates([doc_id, a, b, i, n]).select(*docs.columns)
