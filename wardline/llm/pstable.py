"""Near-duplicate embeddings by Euclidean p-stable hashing.

Normalised vectors are projected on seeded Gaussian directions; each projection is shifted,
divided by ``WIDTH`` and rounded down, and ``depth`` such numbers make the bucket of a
table. Vectors that share a bucket in any table are candidates; a pair links if its cosine,
in double precision on the original values, is ``LEAST`` or more.

Depth and number of tables follow the number of vectors: the depth so that a vector meets
``FAR`` unrelated ones per table (orthogonal vectors agree in one projection with
probability 0.486), the tables so that a pair at exactly the threshold is missed with
probability ``MISS``. Closer pairs are missed far more rarely.

Links are counted without listing them where vectors crowd: vectors within half the angle
of the threshold around a pivot link with each other, so such a ball counts as a whole. Pairs of balls are compared by their pivots first, and only where the
angles leave a link possible are their members compared, by exact cosine. Equal vectors are
one class with a count.

Cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
without id, link with nothing and are kept; vectors of different lengths do not link; equal
vectors always link; rows repeated with one id and vector count as one; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import cut
from wardline.llm.vectors import VALID_SQL, normal_zeros, numbered
from wardline.operators.graph import connected_components

LEAST = 0.9
WIDTH = 2.0
FAR = 0.2
MISS = 0.02


def agree(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection of two vectors at this distance agrees."""
    t = width / distance
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan(n: int, least: float = LEAST) -> tuple[int, int]:
    """(depth, tables) for n vectors."""
    far, near = agree(math.sqrt(2)), agree(math.sqrt(2 - 2 * least))
    depth = max(1, math.ceil(math.log(max(n, 2) / FAR) / -math.log(far)))
    return depth, math.ceil(math.log(MISS) / math.log1p(-(near**depth)))


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def bucket_hashes(x: np.ndarray, depth: int, tables: int, seed: int = 5) -> np.ndarray:
    """One 64-bit value per row and table: the quantised projections of normalised rows, mixed."""
    rng = np.random.default_rng([seed, x.shape[1]])
    directions = rng.standard_normal((x.shape[1], depth * tables))
    shifts = rng.uniform(0, WIDTH, depth * tables)
    odd = rng.integers(1, 2**62, depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64).astype(np.uint64)
    h = (cells.reshape(len(x), tables, depth) * odd).sum(2, dtype=np.uint64)
    h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def _hashing(depth: int, tables: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.iloc[a : a + 512]
                for _, same in part.groupby(part["embedding"].map(len)):
                    yield pd.DataFrame({"c": same["c"], "hashes": list(bucket_hashes(_stack(same["embedding"]), depth, tables))})

    return run


def _cosines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, same in batch.groupby(batch["va"].map(len)):
            x, y = _stack(same["va"]), _stack(same["vb"])
            same = same.assign(cosine=(x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)))
            yield same[["a", "b", "cosine"]]


def _with_cosine(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    one = classes.select(F.col("c").alias("a"), F.col("embedding").alias("va"))
    two = classes.select(F.col("c").alias("b"), F.col("embedding").alias("vb"))
    full = pairs.join(two, "b").join(one, "a").where(F.size("va") == F.size("vb")).select("a", "b", "va", "vb")
    return full.mapInPandas(_cosines, "a struct<id:long,h:long>, b struct<id:long,h:long>, cosine double")


def link_classes(classes: DataFrame, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """(balls, links) of the vector classes (c, embedding, copies).

    balls: (c, ball), the pivot whose ball a class is in (itself if alone); classes of one
    ball link with each other. links: (a, b) of linked classes of different balls.
    """
    depth, tables = plan(classes.count(), least)
    hashed = classes.select("c", "embedding").mapInPandas(_hashing(depth, tables), "c struct<id:long,h:long>, hashes array<long>")
    rows = cut(hashed).select("c", F.posexplode("hashes").alias("t", "h"))
    shared = rows.groupBy("t", "h").agg(F.min("c").alias("first"), F.max("c").alias("last")).where(F.col("first") < F.col("last"))
    members = cut(rows.join(cut(shared.drop("last")), ["t", "h"]))
    half = math.sqrt((1 + least) / 2) + 1e-9  # cosine of half the angle
    star = members.where(F.col("c") != F.col("first")).select(F.col("first").alias("a"), F.col("c").alias("b")).distinct()
    star = cut(_with_cosine(cut(star), classes))
    nearest = star.where(F.col("cosine") >= half).groupBy(F.col("b").alias("c")).agg(F.min("a").alias("pivot"))
    balls = cut(classes.select("c").join(nearest, "c", "left").select("c", F.coalesce("pivot", "c").alias("ball")))
    # pairs of balls that share a bucket, by their pivots
    size = balls.groupBy("ball").agg(F.max(F.col("c") != F.col("ball")).alias("wide"))
    tagged = members.join(balls, "c").select("t", "h", "ball").distinct()
    low = tagged.select("t", "h", F.col("ball").alias("a"))
    high = tagged.select("t", "h", F.col("ball").alias("b"))
    met = cut(low.join(high, ["t", "h"]).where(F.col("a") < F.col("b")).select("a", "b").distinct())
    apart = _with_cosine(met, classes)
    apart = apart.join(size.withColumnRenamed("ball", "a").withColumnRenamed("wide", "wa"), "a").join(size.withColumnRenamed("ball", "b").withColumnRenamed("wide", "wb"), "b")
    reach = math.acos(least)
    wide = F.col("wa").cast("int") + F.col("wb").cast("int")
    bound = F.when(wide == 0, least).when(wide == 1, math.cos(reach * 1.5) - 1e-9).otherwise(math.cos(reach * 2) - 1e-9)
    close = cut(apart.where(F.col("cosine") >= bound).select(F.col("a").alias("ball_a"), F.col("b").alias("ball_b")))
    in_a = balls.select(F.col("c").alias("a"), F.col("ball").alias("ball_a"))
    in_b = balls.select(F.col("c").alias("b"), F.col("ball").alias("ball_b"))
    across = close.join(in_a, "ball_a").join(in_b, "ball_b").select("a", "b")
    links = cut(_with_cosine(across, classes).where(F.col("cosine") >= least).select("a", "b"))
    return balls, links


def near_duplicate_vectors(embeddings: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    good = cut(numbered(rows).withColumn("embedding", normal_zeros("embedding")).distinct())
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = cut(classes.select(F.struct("id", F.xxhash64("embedding").alias("h")).alias("c"), "embedding", "copies"))
    balls, links = link_classes(classes, least)
    weight = classes.select("c", "copies")
    weighed = cut(balls.join(weight, "c"))
    inside = weighed.groupBy("ball").agg(F.sum("copies").alias("in_ball"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    outside = both.join(weight.withColumnRenamed("c", "b"), "b").groupBy(F.col("a").alias("c")).agg(F.sum("copies").alias("across"))
    edges = links.unionByName(balls.where(F.col("c") != F.col("ball")).select(F.col("c").alias("a"), F.col("ball").alias("b")))
    parts = cut(connected_components(balls.select("c"), edges, "c", "a", "b"))
    per = weighed.join(inside, "ball").join(outside, "c", "left").join(parts, "c")
    per = per.select("c", (F.col("in_ball") - 1 + F.coalesce("across", F.lit(0))).alias("n_links"), F.col("component.id").alias("component_id"))
    found = good.select("vec_id", F.col("embedding").alias("v")).join(classes.select("c", F.col("embedding").alias("v")), "v").join(per, "c").select(F.col("vec_id").alias("id"), F.xxhash64("v").alias("h"), "n_links", "component_id")
    keyed = rows.select("vec_id", F.xxhash64(normal_zeros("embedding")).alias("h"))
    out = keyed.join(found, (keyed["vec_id"] == found["id"]) & (keyed["h"] == found["h"]), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


#: the same over all pairs
ALL_PAIRS_SQL = f"""
WITH RECURSIVE {VALID_SQL.strip()},
e AS (SELECT a.vec_id AS s, b.vec_id AS d FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.9),
walk(node, label) AS (SELECT vec_id, vec_id FROM v UNION SELECT e.d, w.label FROM walk w JOIN e ON w.node = e.s),
c AS (SELECT node, min(label) AS component_id FROM walk GROUP BY node),
n AS (SELECT s, COUNT(*) AS n_links FROM e GROUP BY s)
SELECT m.vec_id, COALESCE(n.n_links, 0) AS n_links, COALESCE(c.component_id, m.vec_id) AS component_id,
       COALESCE(c.component_id, m.vec_id) IS NOT DISTINCT FROM m.vec_id AS kept
FROM embeddings m LEFT JOIN c ON m.vec_id = c.node LEFT JOIN n ON m.vec_id = n.s
"""
