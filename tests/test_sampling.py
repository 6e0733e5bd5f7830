import random

from pyspark.sql import functions as F

from wardline.operators.sampling import global_rank, largest_remainder, systematic_sample


def test_global_rank_matches_sort(spark):
    random.seed(7)
    keys = random.sample(range(1, 1_000_000), 3000)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["rank"] for r in global_rank(df, "k").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_systematic_sample_brute_force(spark):
    keys = list(range(5, 2000, 3))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    forced = spark.createDataFrame([(7,), (8,)], "k long")  # 7 is not a key: ignored
    got = sorted(r["k"] for r in systematic_sample(df, "k", 50, forced, "note").collect())
    step = max(len(keys) // 50, 1)
    sampled = {k for i, k in enumerate(sorted(keys)) if i % step == 0 and i // step < 50}
    assert len(sampled) == 50
    assert got == sorted(sampled | ({7, 8} & set(keys)))


def test_largest_remainder_sums_to_total(spark):
    rows = [("g", d, w, 10) for d, w in [(1, 1), (2, 1), (3, 1)]] + [("h", d, w, 7) for d, w in [(1, 5), (2, 3), (3, 2)]]
    df = spark.createDataFrame(rows, "grp string, day int, w long, total long")
    out = largest_remainder(df, ["grp"], "day", "w", "total")
    sums = {r["grp"]: r["s"] for r in out.groupBy("grp").agg(F.sum("allocated").alias("s")).collect()}
    assert sums == {"g": 10, "h": 7}
    g = {r["day"]: r["allocated"] for r in out.filter("grp = 'g'").collect()}
    assert g == {1: 4, 2: 3, 3: 3}  # tie on remainder -> earliest day first
