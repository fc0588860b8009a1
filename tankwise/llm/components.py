"""Connected components of a graph of numbered nodes, with joins and aggregates only.

Alternates two steps until no edge changes: every node's larger neighbours are tied to its smallest
neighbour, then its smaller ones are. No step needs a node's neighbours in one place: the smallest comes
from an aggregate that combines before the shuffle, and is joined back to the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankwise.session import release, stage


def _least(edges: DataFrame) -> DataFrame:
    """For each node ``u`` of directed edges (u, v): the least of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_least(both), "u").filter(F.col("v") > F.col("u"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = down.join(down.groupBy("u").agg(F.min("v").alias("m")), "u")
    return (
        tied.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .unionByName(tied.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Changes whenever the set of edges does."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a, b``): root is the smallest node that can be
    reached. Loops and repeated links are allowed; each round's edges are written to the shared folder."""
    edges = stage(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = _mark(edges)
    while True:
        following = stage(_small_star(_large_star(edges)))
        release(edges)
        edges, before, seen = following, seen, _mark(following)
        if seen == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
