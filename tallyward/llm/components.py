"""Connected components of a link table by contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links`` (a, b: long): equal labels exactly for connected nodes.

    Each round moves every node to the first, in a random but repeatable order, of all that it reaches by two links, and
    keeps the links between different places: a star is one place after a round, however many links its centre has, and
    a constant share of the nodes goes in each round. Nulls and links of a node with itself add nothing. All tables are
    written to the shared folder; only a row count of links comes back.
    """
    edges = stage(links.select("a", "b").where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionAll(edges.select("b", "a"))
        # The first of a node and its neighbours; then the least of what the neighbours have, to which each adds the node.
        own, other = (F.struct(F.xxhash64(c, F.lit(len(moves))).alias("o"), F.col(c).alias("b")) for c in ("a", "b"))
        near = both.groupBy("a").agg(F.min(other).alias("near")).select(F.col("a").alias("node"), F.least("near", own).alias("near"))
        reached = both.join(near, F.col("b") == F.col("node")).groupBy("a").agg(F.min("near").alias("near"))
        move = stage(reached.select(F.col("a").alias("node"), F.col("near.b").alias("place")), "moves")
        moves.append(move)
        moved = edges.join(move, F.col("a") == F.col("node")).select(F.col("place").alias("a"), "b")
        moved = moved.join(move, F.col("b") == F.col("node")).select("a", F.col("place").alias("b"))
        edges = stage(moved.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))

    def follow(table: DataFrame, move: DataFrame) -> DataFrame:
        later = move.select(F.col("node").alias("__node"), F.col("place").alias("__place"))
        return table.join(later, F.col("place") == F.col("__node"), "left").select(
            "node", F.coalesce("__place", "place").alias("place"))

    return reduce(follow, moves[1:], moves[0]).select("node", F.col("place").alias("label"))


class Forest:
    """Union-find of a bounded number of items inside one task."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
