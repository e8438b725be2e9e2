"""Connected components by alternating star contraction.

Each round replaces edges by edges to the smallest neighbour, first over larger neighbours,
then over smaller ones (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).
The number of rounds grows with the logarithm of the longest path, not with its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lamina.session import StepFolder


def _attach_smallest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the smallest node among u and all v of that u.

    The minima are combined before their shuffle. A hub's edges stay splittable: nothing after
    this join needs the edges of one node together, so adaptive execution may cut its partition.
    """
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(smallest, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _attach_smallest(both)
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Needs edges from the larger to the smaller node, as the large star leaves them."""
    with_min = _attach_smallest(edges)
    moved = with_min.filter(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    kept = with_min.select(F.col("u"), F.col("m").alias("v"))
    return moved.union(kept).filter(F.col("u") != F.col("v")).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    pair = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(pair), F.sum(pair % 1_000_003)).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has an edge; component is its smallest node.

    Null ends and loops are left out; the order of the ends and repeated edges do not matter.
    Rounds go on until nothing changes; each is written to the session's shared folder, and the
    one before is deleted.
    """
    steps = StepFolder(edges.sparkSession)
    current = steps.cut(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    seen = _fingerprint(current)
    while seen[0]:
        current = steps.cut(_small_star(_large_star(current)))
        now = _fingerprint(current)
        steps.drop_older()
        if now == seen:
            break
        seen = now
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
