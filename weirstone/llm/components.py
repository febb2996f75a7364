"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from weirstone.llm.runtime import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the least node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b")))


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges written and read again, and what tells them from others; that is observed on the write, no job of its own."""
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")
    held = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), total), "edges")
    return held, (seen.get["n"], seen.get["s"])


def star_forest(edges: DataFrame) -> DataFrame:
    """(a, b) of the nodes of ``edges`` (a, b) that are not the least of their component: b is that least node.

    Both steps only min-aggregate, which combines before the shuffle, and join
    a row per node to the edges, so a node with very many neighbours is not
    gathered anywhere. Every round is written to the shared folder. A forest and
    new edges together make the next forest: nothing starts again from the edges it came from.
    """
    edges, now = _kept(edges.where("a <> b").select("a", "b").distinct())
    before = None
    while now != before and now[0]:
        before = now
        edges, now = _kept(_small_star(_large_star(edges)).distinct())
    return edges


def members(forest: DataFrame) -> DataFrame:
    """(node, component) of the nodes of a star forest."""
    nodes = forest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(forest.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b): the component is its least node."""
    return members(star_forest(edges))
