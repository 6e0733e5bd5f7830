"""Maximum spanning forest of a weighted edge DataFrame, and its partitions along a grid (LK-13, LK-15).

Boruvka's rounds: every component takes its heaviest edge to another one (of equally heavy
ones the one with the smallest ends, so that the order is total and no cycle can close), the
edges taken join components, and of the edges between two components only the heaviest is
carried on. Components at least halve with every round, so rounds are logarithmic. What is
kept at a component is one row from a map-side combined aggregate, whatever its degree.

The forest holds, for every threshold, the same components as all edges at or above it. So
one forest of at most n - 1 edges, cut at each threshold of a grid, gives all partitions: they are
found together, as components of (threshold, node), again in logarithmic rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.graph import connected_components, packed
from wardline.session import checkpoint_dir


def spanning_forest(edges: DataFrame, src: str = "src", dst: str = "dst", weight: str = "weight") -> DataFrame:
    """(src, dst, weight) of a maximum spanning forest: src < dst, loops and lighter parallels left out.

    Edges with a NULL end or weight take no part.
    """
    checkpoint_dir(edges.sparkSession)
    ends = [F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b"), F.col(weight).alias("w")]
    simple = edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & F.col(weight).isNotNull() & (F.col(src) != F.col(dst))).select(*ends)
    left = simple.groupBy("a", "b").agg(F.max("w").alias("w")).select(F.col("a").alias("u"), F.col("b").alias("v"), "a", "b", "w").checkpoint()
    taken = left.limit(0)
    while n := left.count():
        left = packed(left, n)
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v"), "a", "b", "w"))
        heaviest = F.min(F.struct((-F.col("w")).alias("w"), "a", "b", "v")).alias("e")
        picked = both.groupBy("u").agg(heaviest).select("u", F.col("e.v").alias("v"), F.col("e.a").alias("a"), F.col("e.b").alias("b"), (-F.col("e.w")).alias("w"))
        picked = packed(picked, n).checkpoint()
        taken = packed(taken.unionByName(picked).dropDuplicates(["a", "b"]), n).checkpoint()
        label = connected_components(picked.select(F.col("u").alias("node")), picked, "node", "u", "v")
        one = label.select(F.col("node").alias("u"), F.col("component").alias("cu"))
        two = label.select(F.col("node").alias("v"), F.col("component").alias("cv"))
        moved = left.join(one, "u").join(two, "v").filter(F.col("cu") != F.col("cv"))
        best = moved.groupBy(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).agg(F.min(F.struct((-F.col("w")).alias("w"), "a", "b")).alias("e"))
        left = packed(best.select("u", "v", F.col("e.a").alias("a"), F.col("e.b").alias("b"), (-F.col("e.w")).alias("w")), n).checkpoint()
    return taken.select(F.col("a").alias(src), F.col("b").alias(dst), F.col("w").alias(weight))


def passed(value: str, grid: Sequence[float]) -> Column:
    """Number (from 0) of the highest threshold of a sorted grid that ``value`` reaches; -1 below all."""
    return F.size(F.filter(F.array(*[F.lit(float(t)) for t in grid]), lambda t: t <= F.col(value))) - 1


def partitions_along(forest: DataFrame, alone: DataFrame, grid: Sequence[float], src: str = "src", dst: str = "dst", weight: str = "weight") -> DataFrame:
    """(step, node, component) for every threshold of the sorted grid and every node that is listed there.

    A node is listed at a threshold if an edge at or above it touches the node, or if
    ``alone`` (node, weight) lists it with such a weight. All others are components of their own.
    """
    steps = lambda df, w: df.withColumn("top", passed(w, grid)).filter(F.col("top") >= 0).withColumn("step", F.explode(F.sequence(F.lit(0), F.col("top"))))
    cut = steps(forest, weight).select(F.struct("step", F.col(src).alias("id")).alias("u"), F.struct("step", F.col(dst).alias("id")).alias("v")).checkpoint()
    own = steps(alone, "weight").select(F.struct("step", F.col("node").alias("id")).alias("node"))
    nodes = cut.select(F.col("u").alias("node")).unionByName(cut.select(F.col("v").alias("node"))).unionByName(own)
    found = connected_components(nodes, cut, "node", "u", "v")
    return found.select(F.col("node.step").alias("step"), F.col("node.id").alias("node"), F.col("component.id").alias("component"))
