"""Connected components of an edge table by alternating star contractions.

Each round hangs every node's larger neighbours on its smallest neighbour (large
star), then its smaller ones (small star). Edges never grow in number, a hub's
edges are joined rather than gathered, and the number of rounds grows with the
logarithm of the nodes. Rounds are written to the shared folder, so a lost
executor costs no earlier round. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.session import materialise


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller one."""
    u, v = F.greatest("u", "v"), F.least("u", "v")
    return edges.filter("u != v").select(u.alias("u"), v.alias("v")).distinct()


def _hang(sides: DataFrame, keep: DataFrame) -> DataFrame:
    """Hang the ``b`` of ``keep`` on the smallest neighbour of its ``a`` in ``sides``."""
    least = sides.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
    hung = keep.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("u"), F.col("m").alias("v"))
    return hung


def _round(edges: DataFrame) -> DataFrame:
    both = edges.selectExpr("u as a", "v as b").union(edges.selectExpr("v as a", "u as b"))
    large = _tidy(_hang(both, both.filter("b > a")))
    large = materialise(large, "large-star")
    down = large.selectExpr("u as a", "v as b")
    least = down.groupBy("a").agg(F.min("b").alias("b"))
    small = _hang(down, down).union(least.selectExpr("a as u", "b as v"))
    return materialise(_tidy(small), "small-star")


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``u, v`` (longs): the smallest node it reaches.

    Nodes without an edge to another node are not listed.
    """
    edges = materialise(_tidy(edges), "edges")
    before = _state(edges)
    while before[0]:
        edges = _round(edges)
        now = _state(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
