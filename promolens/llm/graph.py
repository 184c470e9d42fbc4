"""Connected components by contraction, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of the undirected ``edges`` (a, b): the smallest id that links reach.

    Each round merges every vertex into the neighbour, or itself, that comes first in a random but fixed order, so the
    number of edges falls by a constant factor and long chains need few rounds. Minima are combined before they are
    shuffled, and joins read written tables, so the hot end of a star is split. Ids are longs. Loops are allowed.
    """
    first = F.struct(F.xxhash64("b"), F.col("b"))
    left = keep(edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), "edges")
    vertices = left.select(F.col("a").alias("id")).union(left.select("b")).distinct()
    labels = vertices.withColumn("root", F.col("id"))
    left = left.filter("a <> b")
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select("b", "a")).union(left.select("a", F.col("a").alias("b"))).union(left.select("b", "b"))
        merged = keep(both.groupBy("a").agg(F.min(first).alias("m")).select(F.col("a").alias("v"), F.col("m.b").alias("m")), "merged")
        ends = left.join(merged, F.col("a") == F.col("v")).select(F.col("m").alias("a"), "b")
        ends = ends.join(merged, F.col("b") == F.col("v")).select("a", F.col("m").alias("b"))
        left = keep(ends.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        moved = labels.join(merged, F.col("root") == F.col("v"), "left").select("id", F.coalesce("m", "root").alias("root"))
        labels = keep(moved, "labels")
    least = keep(labels.groupBy("root").agg(F.min("id").alias("component")), "least")
    return keep(labels.join(least, "root").select("id", "component"), "components")


class Forest:
    """Union-find over the rows of one task; tells which links join what was apart."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y
