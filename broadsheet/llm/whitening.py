"""Whitening of embeddings through distinct vectors weighted by their copies.

Components become whole numbers, and identical vectors are grouped, combined on the map
side, so that the fit and the projection see each distinct vector once, with its number
of copies (or one) as its weight. Means come from exact integer sums. The covariance is
a sum of weighted products of centred blocks, one block per Arrow batch and one matrix
per task; only its ``dims * (dims + 1) / 2`` cells meet on the driver, which takes the
eigenvectors. Each distinct vector is whitened once and written; rows fetch their
vector's result by the SHA-256 of the vector.

Vectors with more than a thousandth of all rows, fewer than a thousand by that, reach the
rows as a broadcast; all others go through a shuffle in which no key has more rows than
that share.

Defined cases: rows whose vector is null, or holds a null or non-finite component, or one
whose whole number passes 2^61 in size, take no part; a shorter vector is continued with
zero components, and where all are empty the result is; rows with a null or repeated id
each get their rows; a component whose variance is zero within double precision has a
null ``whitened`` (as with a single distinct vector) and no part in the error; ``deviation`` is null where it does not fit a
long; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import tune
from broadsheet.session import materialise

HOT_SHARE = 1000  # a vector with more than this part of all rows is hot
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_EXACT = 2**62


def whole_numbers(df: DataFrame, vec_id: str, vector: str, scale: int, shift: int) -> DataFrame:
    """``vec_id, x``: components as ``floor(scale * c) + shift``; rows that take no part are left out."""
    scaled = F.transform(F.col(vector), lambda c: scale * c.cast("double"))
    # NaN counts as the largest value
    fits = F.forall(scaled, lambda c: c.isNotNull() & (F.abs(c) < float(_EXACT // 2)))
    x = F.when(F.col(vector).isNotNull() & fits, F.transform(scaled, lambda c: F.floor(c).cast("long") + F.lit(shift).cast("long")))
    return df.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).filter(F.col("x").isNotNull())


def _key(x: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", x.cast("array<string>")), 256))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _weighted_sums(x: np.ndarray, w: np.ndarray) -> list[int]:
    """Exact sums of weighted whole numbers."""
    if float(np.abs(x.astype(float)).max(initial=0)) * float(w.sum()) < _EXACT:
        return (w @ x).tolist()
    return (w.astype(object) @ x.astype(object)).tolist()


@dataclass
class Centre:
    """An exact mean: whole part and rest of ``sums / n``."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of ``(n * x - sums) ** 2``, exact; None beyond a long."""
        far = float(np.abs(self.centred(x)).max(initial=0)) * self.n
        dims = max(1, x.shape[1])
        if float(np.abs(x.astype(float)).max(initial=0)) * self.n < _EXACT and far * far * dims < _EXACT:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact.tolist()]


def _covariance(df: DataFrame, dims: int, n: int, blocks: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of the weighted products of centred blocks, over ``n``."""
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            d, w = blocks(b)
            total += (d * w[:, None]).T @ d
        cells = [pa.array(np.arange(len(upper[0])), pa.int32()), pa.array(total[upper])]
        yield pa.RecordBatch.from_arrays(cells, ["cell", "v"])

    cells = df.mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((dims, dims))
    for cell, v in cells:
        i, j = upper[0][cell], upper[1][cell]
        out[i, j] = out[j, i] = v / n
    return out


def _sums(distinct: DataFrame, dims: int) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * dims, 0
        for b in batches:
            w = b.column("weight").to_numpy()
            total = [s + t for s, t in zip(total, _weighted_sums(_matrix(b.column("x"), dims), w), strict=True)]
            n += int(w.sum())
        numbers = pa.array(list(map(Decimal, [n, *total])), pa.decimal128(38))
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), numbers], ["at", "s"])

    found = distinct.mapInArrow(run, "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").alias("s")).collect()
    numbers = [int(s) for _, s in sorted(found)]
    return Centre(numbers[0], numbers[1:])


def _principal(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and their unit eigenvectors; the largest entry of each is positive."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return np.maximum(values, 0), vectors * signs


def whiten(
    df: DataFrame,
    components: int = 32,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    shift: int = 1_000_000,
    weights: str = "counts",
) -> DataFrame:
    """One row per row of ``df`` and principal component; see ``SCHEMA`` for the columns.

    ``weights="counts"`` fits on all rows, ``"one"`` on each distinct vector once.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    spark = tune(df.sparkSession)
    rows = whole_numbers(df, vec_id, vector, scale, shift)
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return spark.createDataFrame([], SCHEMA)
    zeros = F.array_repeat(F.lit(shift).cast("long"), F.lit(dims) - F.size("x"))
    rows = rows.withColumn("x", F.when(F.size("x") < dims, F.concat("x", zeros)).otherwise(F.col("x")))
    weight = F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("long")
    grouped = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"), weight.alias("weight"))
    distinct = materialise(grouped, "distinct-vectors")

    centre = _sums(distinct, dims)
    n = centre.n
    v = _covariance(
        distinct, dims, n, lambda b: (centre.centred(_matrix(b.column("x"), dims)), b.column("weight").to_numpy())
    )
    values, axes = _principal(v, components)
    k, trace = len(values), float(np.trace(v))
    sound = values > dims * np.finfo(float).eps * max(float(values.max(initial=0)), 0.0)
    projection = axes[:, sound] / np.sqrt(values[sound])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), dims)
            y = np.full((len(x), k), np.nan)
            y[:, sound] = centre.centred(x) @ projection
            flat = pa.array(y.ravel(), from_pandas=True)  # null where there is no variance
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("copies"), b.column("weight"), pa.array(centre.deviations(x), pa.int64()), lists],
                ["key", "copies", "weight", "deviation", "y"],
            )

    keyed = distinct.select("x", "copies", "weight", _key(F.col("x")).alias("key"))
    done = materialise(
        keyed.mapInArrow(project, "key binary, copies long, weight long, deviation long, y array<double>"), "whitened-vectors"
    )
    error = _identity_error(done, k, n, sound)

    total = done.agg(F.sum("copies")).first()[0]
    is_hot = F.col("copies") * HOT_SHARE > total
    hot, cold = (done.filter(c).select("key", "deviation", "y") for c in (is_hot, ~is_hot))
    asked = rows.select("vec_id", _key(F.col("x")).alias("key"))
    near = asked.join(F.broadcast(hot), "key")
    far = asked.join(F.broadcast(hot.select("key")), "key", "left_anti").join(cold, "key")
    explained = F.array(*[F.lit(float(e / trace) if trace > 0 else None).cast("double") for e in values])
    return near.union(far).select("vec_id", F.posexplode("y").alias("at", "whitened"), "deviation").select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(done: DataFrame, k: int, n: int, sound: np.ndarray) -> float | None:
    """Largest entry by which the covariance of the whitened vectors differs from the identity."""
    if not sound.any():
        return None
    means = done.select(F.posexplode("y").alias("at", "v"), "weight").groupBy("at").agg(F.sum(F.col("v") * F.col("weight")).alias("s"))
    mean = np.zeros(k)
    for at, s in means.collect():
        mean[at] = (s or 0.0) / n

    def centred(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return (_matrix(b.column("y"), k) - mean)[:, sound], b.column("weight").to_numpy()

    found = _covariance(done.select("y", "weight"), int(sound.sum()), n, centred)
    return float(np.abs(found - np.eye(len(found))).max())
