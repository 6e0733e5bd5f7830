"""Exact percentiles without a buffer of the values."""

import random

import numpy as np
from pyspark.sql import functions as F

from wardline.operators.selection import exact_percentiles

LEVELS = {"p0": 0.0, "p10": 0.1, "median": 0.5, "p99": 0.99, "p100": 1.0}


def check(spark, rows, gather):
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: [r[n] for n in LEVELS] for r in exact_percentiles(df, ["g"], "x", LEVELS, gather).collect()}
    groups = {}
    for g, x in rows:
        if x is not None and x == x:
            groups.setdefault(g, []).append(x)
    want = {g: [float(np.quantile(xs, p)) for p in LEVELS.values()] for g, xs in groups.items()}
    assert got.keys() == want.keys()
    for g in want:
        assert np.allclose(got[g], want[g], rtol=1e-12, atol=1e-12), g


def test_all_different_values_repeats_and_missing_ones(spark):
    dice = random.Random(3)
    rows = [("wide", dice.choice([-1, 1]) * 10 ** dice.uniform(-300, 300)) for _ in range(4000)]
    rows += [("few", float(dice.choice([0, 0, 0, 1, 2, -0.0]))) for _ in range(900)] + [("one", 7.5)] + [("none", None), ("none", float("nan"))]
    rows += [(None, float(i)) for i in range(50)] + [("steps", float(i // 100)) for i in range(1000)]
    for gather in (10_000, 20):
        check(spark, rows, gather)


def test_no_group_is_gathered(spark):
    df = spark.range(200_000).select(F.lit("all").alias("g"), F.xxhash64("id").cast("double").alias("x"))
    got = exact_percentiles(df, ["g"], "x", {"median": 0.5}, gather=500).first()
    want = df.agg(F.percentile("x", 0.5)).first()[0]
    assert got["median"] == want
    assert exact_percentiles(df.limit(0), ["g"], "x", {"median": 0.5}).collect() == []
