"""Exact percentiles of any number of different values (AG-4).

``percentile`` buffers all different values of a group in one task. Here the rank that is
asked for is closed in on: an approximate sketch (mergeable, of bounded size) proposes two
values around the rank, one exact count tells how many rows lie below and between them, and
the next pass looks only between. Each pass narrows the rows by a factor of hundreds; once few
are left, they are sorted. Counts alone decide, so the result is exact whatever the sketch says:
a bracket that misses the rank is answered by the side on which the rank was found to lie.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.session import checkpoint_dir

#: rows that are sorted in one task, steps of the sketch's grid, and the sketch's accuracy
GATHER, GRID, ACCURACY = 10_000, 256, 4_000
FEW_RANKS = 10_000


def _matches(by: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"t.{c}"))
    return on


def kth_values(rows: DataFrame, by: Sequence[str], value: str, ranks: DataFrame, gather: int = GATHER) -> DataFrame:
    """``ranks`` (by..., n, k) with ``x``, the k-th smallest (from 0) of the group's n values.

    ``ranks`` holds a few rows per group; up to ``FEW_RANKS`` of them are broadcast, more are
    joined by group.
    """
    checkpoint_dir(rows.sparkSession)
    # open ranks: the value lies above ``low`` and below ``high`` (NULL: open end), ``below`` rows are known not to be above low
    open_ = ranks.withColumns({"low": F.lit(None).cast("double"), "high": F.lit(None).cast("double"), "below": F.lit(0).cast("long"), "inside": F.col("n").cast("long")}).drop("n").checkpoint()
    key = [*by, "k"]
    done = []
    while n_open := open_.count():
        small = F.broadcast if n_open <= FEW_RANKS else lambda df: df
        t = small(open_.select(F.struct(*open_.columns).alias("t")))
        v = F.col(value)
        near = rows.join(t, _matches(by) & (F.col("t.low").isNull() | (v > F.col("t.low"))) & (F.col("t.high").isNull() | (v < F.col("t.high"))))
        few = F.col("t.inside") <= gather
        sorted_ = near.filter(few).groupBy("t").agg(F.sort_array(F.collect_list(v)).alias("vs"))
        sorted_ = sorted_.select("t.*", F.element_at("vs", (F.col("t.k") - F.col("t.below") + 1).cast("int")).alias("x"))
        # two neighbours of the grid on either side of the rank's place
        grid = F.percentile_approx(v, F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]), F.lit(ACCURACY))
        sketch = near.filter(~F.coalesce(few, F.lit(False))).groupBy("t").agg(grid.alias("grid"), F.count(F.lit(1)).alias("n"))
        place = (F.col("t.k") - F.col("t.below")) / F.col("n") * GRID
        at = lambda i: F.element_at("grid", (F.greatest(F.lit(0), F.least(F.lit(GRID), i)) + 1).cast("int"))
        asked = sketch.select("t", at(F.floor(place) - 1).alias("a"), at(F.ceil(place) + 1).alias("b"))
        asked = small(asked.select(F.struct("t.*", "a", "b").alias("t")))
        between = rows.join(asked, _matches(by) & (F.col("t.low").isNull() | (v > F.col("t.low"))) & (F.col("t.high").isNull() | (v < F.col("t.high"))))
        a, b = F.col("t.a"), F.col("t.b")
        counted = between.groupBy("t").agg(F.count_if(v < a).alias("under"), F.count_if(v == a).alias("at_a"), F.count_if((v > a) & (v < b)).alias("mid"), F.count_if((v == b) & (b > a)).alias("at_b"))
        # where the rank lies: below a, on a, between, on b, above b
        c0 = F.col("t.below") + F.col("under")
        c1 = c0 + F.col("at_a")
        c2 = c1 + F.col("mid")
        c3 = c2 + F.col("at_b")
        k = F.col("t.k")
        step = counted.select(
            *[F.col(f"t.{c}").alias(c) for c in key],
            F.when((k >= c0) & (k < c1), a).when((k >= c2) & (k < c3), b).alias("x"),
            F.when(k < c0, F.col("t.low")).when(k < c2, a).otherwise(b).alias("low"),
            F.when(k < c0, a).when(k < c2, b).otherwise(F.col("t.high")).alias("high"),
            F.when(k < c0, F.col("t.below")).when(k < c2, c1).otherwise(c3).alias("below"),
            F.when(k < c0, F.col("under")).when(k < c2, F.col("mid")).alias("inside"),
        ).checkpoint()
        done += [sorted_.select(*key, "x").checkpoint(), step.filter(F.col("x").isNotNull()).select(*key, "x")]
        open_ = step.filter(F.col("x").isNull()).drop("x").select(*key, "low", "high", "below", "inside")
    if not done:
        return open_.select(*key, F.lit(None).cast("double").alias("x"))
    return reduce(lambda a, b: a.unionByName(b), done)


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, fractions: Mapping[str, float], gather: int = GATHER) -> DataFrame:
    """Per group, percentiles with linear interpolation as columns named by ``fractions``; NULL and NaN values are left out.

    Groups without a value are missing from the result.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in fractions.items()]))
    places = counts.filter("_n > 0").select(*by, "_n", asked.alias("a")).withColumn("pos", F.col("a.p") * (F.col("_n") - 1))
    places = places.select(*by, F.col("a.name").alias("name"), F.floor("pos").alias("i"), F.ceil("pos").alias("j"), "pos", F.col("_n").alias("n")).checkpoint()
    ranks = places.select(*by, "n", F.explode(F.array("i", "j")).alias("k")).distinct()
    found = kth_values(rows, by, "_v", ranks, gather)
    ends = places
    small = F.broadcast if found.count() <= FEW_RANKS else lambda df: df
    for end in ("i", "j"):
        one = found.select(F.struct(*by, F.col("k")).alias("t"), F.col("x").alias(f"x{end}"))
        ends = ends.join(small(one), _matches(by) & (F.col(end) == F.col("t.k"))).drop("t")
    level = F.when(F.col("i") == F.col("j"), F.col("xi")).otherwise((F.col("j") - F.col("pos")) * F.col("xi") + (F.col("pos") - F.col("i")) * F.col("xj"))
    per = ends.select(*by, "name", level.alias("x"))
    return per.groupBy(*by).agg(*[F.max(F.when(F.col("name") == n, F.col("x"))).alias(n) for n in fractions])
