"""Connected components of a distributed edge list.

Every task first joins its own edges with a union-find forest, which leaves one edge per node. Rounds of the
large-star and small-star steps then join the forests of all tasks. Each round writes its edges to the shared folder, removes those of the round before, and only
two counts per round reach the driver. A node of very many edges is one row per task after partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import map_batches, release, written


class Forest:
    """Union-find with path halving; the smallest member is the root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, node: int) -> int:
        parent = self.parent
        while (up := parent.get(node, node)) != node:
            parent[node] = above = parent.get(up, up)
            node = above
        return node

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _local(batches):
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch["a"], batch["b"]):
            forest.join(a, b)
    nodes = list(forest.parent)
    yield {"a": nodes, "b": [forest.find(node) for node in nodes]}


def local_forest(edges: DataFrame) -> DataFrame:
    """(a, b) with b < a: the same components with at most one edge per node and task."""
    return map_batches(edges.select("a", "b"), _local, "a long, b long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return (both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("root").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("root"))
    below = edges.join(least, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return below.unionByName(least.select("a", F.col("root").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of ``edges`` (a, b); root is the smallest id that can be reached. Loops and repeated edges are fine."""
    now = written(local_forest(edges.where("a is not null and b is not null")), "forest")
    while True:
        upper = now.groupBy("a").agg(F.count("*").alias("n"))
        inner = now.join(upper.withColumnRenamed("a", "b"), "b", "left_semi").limit(1).count()
        if not inner and not upper.where("n > 1").limit(1).count():
            break
        before, now = now, written(_small_star(_large_star(now)), "forest")
        release(before)
    roots = now.select(F.col("b").alias("id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots.select("id", F.col("id").alias("root")))
