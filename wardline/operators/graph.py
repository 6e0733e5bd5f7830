"""Connected components of an edge DataFrame (LK-12).

Alternating large-star and small-star contractions: every node is re-linked to the
smallest node of its neighbourhood, once for its larger and once for its smaller
neighbours. The number of rounds grows with the logarithm of the longest chain; the loop
ends when a round changes no edge and has no other limit. Each round's edges are cut with
``checkpoint()`` (the cluster's ``spark.checkpoint.dir``), so a lost executor repeats one
round at most; the driver receives one count and one checksum per round. Tasks follow the
edges: once they fit one task, a round no longer shuffles, whatever the number of shuffle
partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import checkpoint_dir

#: edges per task: contracted edges get few, so that late rounds do not write thousands of tiny files
EDGES_PER_TASK = 50_000


#: rounds of more edges look for centres; a centre has more edges than this, and than a thousandth of all
MANY_EDGES, LEAST_CENTRE = 1_000_000, 1_000


def _with_least(edges: DataFrame, ends: DataFrame, rows: int) -> DataFrame:
    """``edges`` (u, v), a part of ``ends``, with ``m``, the smallest node around u in ``ends``, u itself included."""
    least = ends.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree"))
    if rows <= MANY_EDGES:
        return edges.join(least.select("u", "m"), "u")
    # their degrees add up to twice the edges at most: this bounds what is broadcast
    centre = F.col("degree") > max(LEAST_CENTRE, rows // 1000)
    centres = least.filter(centre).select(F.col("u").alias("_c"), F.col("m").alias("_m"))
    at_centres = edges.join(F.broadcast(centres), F.col("u") == F.col("_c"), "left")
    near = at_centres.filter(F.col("_c").isNotNull()).select("u", "v", F.col("_m").alias("m"))
    far = at_centres.filter(F.col("_c").isNull()).select("u", "v").join(least.filter(~centre).select("u", "m"), "u")
    return near.unionByName(far)


def _each(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """A row (u, v) for each of the named pairs of columns, in the task that holds the edge."""
    structs = [F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs]
    return edges.select(F.explode(F.array(*structs)).alias("e")).select("e.u", "e.v")


def _around() -> Column:
    return F.least(F.col("u"), F.min("v").over(Window.partitionBy("u")))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Larger neighbours of a node are linked to the smallest node around it (u is the larger end of each edge)."""
    both = _each(edges, ("u", "v"), ("v", "u"))
    if rows <= EDGES_PER_TASK:  # they lie in one task, which needs no join
        found = both.select("u", "v", _around().alias("m")).where(F.col("v") > F.col("u"))
    else:
        found = _with_least(edges.select(F.col("v").alias("u"), F.col("u").alias("v")), both, rows)
    return found.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    found = edges.select("u", "v", _around().alias("m")) if rows <= EDGES_PER_TASK else _with_least(edges, edges, rows)
    return _each(found, ("v", "m"), ("u", "m")).where(F.col("u") != F.col("v")).distinct()


def packed(edges: DataFrame, rows: int) -> DataFrame:
    """``edges`` in no more tasks than ``rows`` rows call for."""
    return edges.coalesce(max(1, -(-rows // EDGES_PER_TASK)))


#: edges that a task holds before it thins them
EDGES_HELD = 500_000


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node to the smallest node that these edges connect it with; nodes with a loop only keep it."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    looped = np.unique(a[a == b])
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low != high
        a, b = low[open_], high[open_]
        np.minimum.at(label, b, a)
        while not np.array_equal(further := label[label], label):
            label = further
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    loops = np.setdiff1d(looped, np.concatenate([moved, label[moved]]))
    return nodes[np.concatenate([label[moved], loops])], nodes[np.concatenate([moved, loops])]


def thinned(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges with the same components, fewer than the nodes of each task (loops stay where a node has no
    other edge). For lists of many edges among few nodes; edges with a NULL end take no part."""
    known = edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(src, dst)
    names = known.columns

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows, least = 0, EDGES_HELD
        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
            rows += batch.num_rows
            if rows >= least:
                held = [_stars(*map(np.concatenate, zip(*held)))]
                rows = len(held[0][0])
                least = max(EDGES_HELD, 2 * rows)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _stars(*map(np.concatenate, zip(*held)))], names=names)

    return known.mapInArrow(thin, known.schema)


def connected_components(nodes: DataFrame, edges: DataFrame, node_col: str = "node", src: str = "src", dst: str = "dst") -> DataFrame:
    """Return (node, component) with component = smallest node id of the component.

    ``nodes`` must contain every node (isolated ones are kept as singletons);
    ``edges`` are undirected. Node ids must be orderable (numbers or strings).
    """
    checkpoint_dir(nodes.sparkSession)
    ends = F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")
    stars = edges.where(F.col(src) != F.col(dst)).select(*ends).distinct().checkpoint()
    state = None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state or now[0] == 0:
            break
        state = tuple(now)
        stars = packed(stars, now[0])
        stars = packed(_small_star(packed(_large_star(stars, now[0]), now[0]), now[0]), now[0]).checkpoint()
    found = stars.select(F.col("u").alias(node_col), F.col("v").alias("component"))
    return nodes.select(node_col).distinct().join(found, node_col, "left").select(node_col, F.coalesce("component", F.col(node_col)).alias("component"))
