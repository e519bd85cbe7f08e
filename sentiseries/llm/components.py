"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sentiseries.sources.storage import stored


_FILE = 200_000


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return row["n"], row["x"] or 0


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): nodes with an edge, and the smallest node of their component.

    ``edges`` has columns a and b of one orderable type; loops and nulls are ignored.
    Every round is written to the shared folder, so a lost executor costs a re-read; as
    few edges are left, in a file for each ``_FILE`` of them and not one a partition.
    Rounds end when the edges no longer change: then each is (node, root).
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = stored(small_star(large_star(edges)).coalesce(state[0] // _FILE + 1), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
