"""Systematic sampling (SMP-1) and largest-remainder allocation (GEN-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import checkpoint_dir


def global_rank(df: DataFrame, key: str) -> DataFrame:
    """1-based rank of a unique ``key`` in ascending order, without a window over all rows.

    Rows are dealt out by ranges of the key; a row's rank is the number of rows in the
    ranges before its own plus its number within the range. One path at any size: the
    ranges are as many as the session's shuffle partitions, and their cut at one moment is
    kept (checkpoint), so that counts and numbers speak of the same ranges.
    """
    checkpoint_dir(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    staged = df.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id()).checkpoint()
    counts = staged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    ranked = staged.withColumn("_number", number).join(offsets, "_range")
    return ranked.withColumn("rank", (F.col("_off") + F.col("_number")).cast("long")).drop("_range", "_number", "_off")


def systematic_sample(
    df: DataFrame,
    key: str,
    n: int,
    forced: DataFrame | None = None,
    notice: str | None = None,
) -> DataFrame:
    """SMP-1: every k-th row by ``key`` (k = max(total // n, 1)), the first ``n`` of
    them, plus the ``forced`` keys; each row stamped with a ``notice`` (SNK-14)."""
    total = df.select(F.count(F.lit(1))).scalar()
    step = F.greatest(F.floor(total / F.lit(n)), F.lit(1))
    ranked = global_rank(df.select(key), key)
    chosen = ranked.filter(((F.col("rank") - 1) % step == 0) & ((F.col("rank") - 1) / step < n)).select(key)
    picked = df.join(chosen, key, "left_semi")
    if forced is not None:
        extra = df.join(forced.select(key).distinct(), key, "left_semi")
        picked = picked.unionByName(extra).distinct()
    if notice is not None:
        picked = picked.withColumn("notice", F.lit(notice))
    return picked


def largest_remainder(
    weights: DataFrame,
    group: Sequence[str],
    order: str,
    weight_col: str,
    total_col: str,
) -> DataFrame:
    """GEN-4: split an integer total per group over its rows proportionally to weight;
    floors first, then one extra unit to the largest remainders (ties: ``order`` asc).

    The window is per group over its rows (e.g. the days of one month), bounded.
    """
    wsum = F.sum(weight_col).over(Window.partitionBy(*group))
    exact = F.col(total_col) * F.col(weight_col) / wsum
    staged = weights.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact").cast("long"))
    staged = staged.withColumn("_left", F.col(total_col) - F.sum("_floor").over(Window.partitionBy(*group)))
    rk = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(F.col("_exact") - F.col("_floor")), F.col(order)))
    out = staged.withColumn("_rk", rk)
    return out.withColumn("allocated", (F.col("_floor") + F.when(F.col("_rk") <= F.col("_left"), 1).otherwise(0)).cast("long")).drop(
        "_exact", "_floor", "_left", "_rk"
    )
