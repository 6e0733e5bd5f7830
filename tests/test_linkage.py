"""Linkage operators on hand-made records."""

import itertools
import random

from pyspark.sql import functions as F

from wardline.operators import graph
from wardline.operators import linkage as L
from wardline.operators.forest import partitions_along, spanning_forest
from wardline.operators.graph import _large_star, _small_star, connected_components, packed, thinned
from wardline.sinks import files

COMPS = [
    L.TextComparison("name", "name"),
    L.Comparison("size", "size", ((2, "exact", L.exact), (1, "diff<=2", L.abs_diff_at_most(2)))),
    L.Comparison("born", "born", ((2, "exact", L.exact), (1, "days<=31", L.days_apart_at_most(31)))),
]


def test_comparison_levels_one_pair_per_level(spark):
    pairs = [
        ("martha", "martha", 5, 5, "1980-01-01", "1980-01-01"),
        ("martha", "marhta", 5, 7, "1980-01-01", "1980-01-20"),
        ("jellyfish", "smellyfish", 5, 9, "1980-01-01", "1981-01-01"),
        ("abc", "xyz", None, 1, None, "1980-01-01"),
    ]
    df = spark.createDataFrame(pairs, "name_l string, name_r string, size_l int, size_r int, born_l string, born_r string")
    df = df.withColumn("born_l", F.to_date("born_l")).withColumn("born_r", F.to_date("born_r"))
    g = [tuple(r) for r in L.gammas(df, COMPS).select("gamma_name", "gamma_size", "gamma_born").collect()]
    assert g == [(3, 2, 2), (2, 1, 1), (1, 0, 0), (0, -1, -1)]


def test_components_with_singletons(spark):
    nodes = spark.createDataFrame([(c,) for c in "ABCDEF"], "node string")
    edges = spark.createDataFrame([("A", "B"), ("B", "C"), ("D", "E")], "src string, dst string")
    got = {r["node"]: r["component"] for r in connected_components(nodes, edges).collect()}
    assert got == {"A": "A", "B": "A", "C": "A", "D": "D", "E": "D", "F": "F"}


def test_components_long_chain(spark):
    nodes = spark.range(0, 40).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(39)], "src long, dst long")
    comp = connected_components(nodes, edges)
    assert comp.select("component").distinct().collect()[0][0] == 0


def test_em_recovers_planted_m():
    """Patterns drawn from known m/u: EM (u fixed) must get m back."""
    comps = [L.Comparison(f"c{i}", f"c{i}", ((1, "exact", L.exact),), null_level=False) for i in range(3)]
    m_true = {"c0": {0: 0.1, 1: 0.9}, "c1": {0: 0.2, 1: 0.8}, "c2": {0: 0.05, 1: 0.95}}
    u = {"c0": {0: 0.95, 1: 0.05}, "c1": {0: 0.9, 1: 0.1}, "c2": {0: 0.8, 1: 0.2}}
    lam = 0.2
    counts = {}
    for pat in itertools.product([0, 1], repeat=3):
        pm = lam * m_true["c0"][pat[0]] * m_true["c1"][pat[1]] * m_true["c2"][pat[2]]
        pu = (1 - lam) * u["c0"][pat[0]] * u["c1"][pat[1]] * u["c2"][pat[2]]
        counts[pat] = 100000 * (pm + pu)
    patterns = [p + (c,) for p, c in counts.items()]
    m, _ = L.em(patterns, comps, u, 0.1, ["c0", "c1", "c2"], max_iter=200, tol=1e-9)
    for n in m_true:
        assert abs(m[n][1] - m_true[n][1]) < 0.02


def test_profiles_and_block_pairs_multiplicity(spark):
    random.seed(3)
    recs = [(i, "a" if i < 6 else "b", i % 2) for i in range(10)]
    pop = spark.createDataFrame(recs, "id long, k string, v int")
    prof, members = L.profiles(pop, "id", ["k", "v"])
    pairs = L.block_pairs(prof, [["k"]])
    total = pairs.agg(F.sum("w")).first()[0]
    assert total == 6 * 5 / 2 + 4 * 3 / 2  # all record pairs inside each block, no pair listed twice
    assert members.count() == 10


def test_model_json_round_trip():
    m = L.Model(0.01, {"a": {0: 0.1, 1: 0.9}}, {"a": {0: 0.8, 1: 0.2}}, [{"rule": 0}])
    back = L.Model.from_json(m.to_json())
    assert back.m == m.m and back.u == m.u and back.prior == m.prior


def test_pairs_of_cut_blocks_are_those_of_all_pairs(spark):
    """One block with a third of the profiles, NULL keys, overlapping rules, tiny sub-blocks and tasks."""
    dice = random.Random(6)
    rows = [(i, "hot" if i % 3 == 0 else dice.choice(["a", "b", None]), dice.choice(["x", "y", None]), i % 5, 1 + i % 2) for i in range(300)]
    prof = spark.createDataFrame(rows, "pid long, k string, q string, v int, n long")
    rules = [["k"], ["q", "v"]]
    got = L.sided_pairs(prof, rules, ["k", "v"], sub_block=7, pairs_per_task=1000)
    want = []
    for p, a in enumerate(rows):
        for b in rows[p:]:
            rule = 0 if a[1] is not None and a[1] == b[1] else 1 if a[2] is not None and a[2] == b[2] and a[3] == b[3] else None
            w = a[4] * b[4] if a is not b else a[4] * (a[4] - 1) // 2
            if rule is not None and w:
                want.append((a[0], b[0], w, rule, a[1], b[1], a[3], b[3]))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    loads = got.filter("rule = 0").groupBy(F.spark_partition_id()).count()
    assert loads.agg(F.max("count")).first()[0] < sum(1 for x in want if x[3] == 0) / 3  # the hot block is spread


def test_counts_need_no_list_of_pairs(spark):
    prof = spark.createDataFrame([(i, "k", i % 7, 1) for i in range(50)], "pid long, k string, v int, n long")
    comps = [L.Comparison("v", "v", ((1, "exact", L.exact),))]
    counted = L.gammas(L.sided_pairs(prof, [["k"]], ["v"]), comps).groupBy("gamma_v").agg(F.sum("w"))
    plan = counted._jdf.queryExecution().toString()
    final, partial = plan.rfind("Exchange hashpartitioning(gamma_v"), plan.rfind("SortMergeJoin")
    assert final < partial or partial == -1  # summed in the task that forms the pairs
    assert {r[0]: r[1] for r in counted.collect()} == {1: 1 * 28 + 6 * 21, 0: 1225 - 154}


def components_of(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_star_centres_are_spread(spark, monkeypatch):
    monkeypatch.setattr(graph, "LEAST_CENTRE", 5)
    monkeypatch.setattr(graph, "MANY_EDGES", 10)
    dice = random.Random(1)
    edges = [(1000, i) for i in range(200)] + [(2000 + i, 1999) for i in range(50)] + [(dice.randrange(300), dice.randrange(300)) for _ in range(100)]
    nodes = sorted({n for e in edges for n in e})
    got = connected_components(spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "src long, dst long"))
    assert {r[0]: r[1] for r in got.collect()} == components_of(nodes, edges)


def test_spanning_forest_keeps_every_partition(spark):
    dice = random.Random(2)
    for n, m, weights in ((40, 90, 5), (60, 400, 50), (30, 0, 1)):
        edges = [(dice.randrange(n), dice.randrange(n), dice.randrange(weights) / weights) for _ in range(m)]
        edges += [(0, i, 0.5) for i in range(n // 2)] + [(3, 3, 0.9), (None, 1, 0.4), (1, 2, None)]
        forest = [tuple(r) for r in spanning_forest(spark.createDataFrame(edges, "src long, dst long, weight double")).collect()]
        sound = [e for e in edges if None not in e]
        assert len(set(components_of(range(n), [e[:2] for e in forest]).values())) == n - len(forest)  # no cycle
        for t in sorted({e[2] for e in sound}):
            at = lambda es: components_of(range(n), [e[:2] for e in es if e[2] >= t])
            assert at(forest) == at(sound)


def test_partitions_along_a_grid(spark):
    forest = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.6), (5, 6, 0.5)], "src long, dst long, weight double")
    alone = spark.createDataFrame([(7, 0.6), (8, 0.1)], "node long, weight double")
    got = {tuple(r) for r in partitions_along(forest, alone, [0.5, 0.6, 0.95]).collect()}
    assert got == {(0, 1, 1), (0, 2, 1), (0, 3, 1), (0, 5, 5), (0, 6, 5), (0, 7, 7), (1, 1, 1), (1, 2, 1), (1, 3, 1), (1, 7, 7)}


def test_pair_numbers_unrank_to_all_pairs(spark):
    low, high = L.unranked(F.col("q"))
    got = L.pair_numbers(spark, 4950, 10_000).select(low.alias("low"), high.alias("high")).collect()
    assert sorted((r[0], r[1]) for r in got) == sorted((a, b) for b in range(100) for a in range(b))
    ends = [0, 1, 2, 499999999500000000 - 1, 499999999500000000, 2**61, 2**61 + 1]
    for q, a, b in spark.createDataFrame([(q,) for q in ends], "q long").select("q", low.alias("low"), high.alias("high")).collect():
        assert 0 <= a < b and b * (b - 1) // 2 + a == q


def test_random_pairs_are_different_and_spread(spark):
    total, n = 5 * 10**15, 2000
    q = sorted(r[0] for r in L.pair_numbers(spark, total, n).collect())
    assert len(set(q)) == n and 0 <= q[0] and q[-1] < total
    assert all(x * n // total == k for k, x in enumerate(q))  # one of each stratum
    assert q != sorted(r[0] for r in L.pair_numbers(spark, total, n, seed=1).collect())
    pop = spark.createDataFrame([(10 * i, i % 3) for i in range(100)], "id long, v int")
    pairs = L.random_pairs(pop, "id", ["id", "v"], n=500).collect()
    assert len({(r.id_l, r.id_r) for r in pairs}) == 500 and all(r.id_l < r.id_r and r.v_l == r.id_l // 10 % 3 for r in pairs)
    comps = [L.Comparison("v", "v", ((1, "exact", L.exact),))]
    assert abs(L.estimate_u(pop, "id", comps)["v"][1] - 1617 / 4950) < 1e-3  # all pairs: 34, 33 and 33 records agree


def test_record_pairs_of_cut_profiles_are_all_pairs(spark, monkeypatch):
    members = spark.createDataFrame([(i, 0) for i in range(40)] + [(100 + i, 100) for i in range(7)], "id long, pid long")
    pairs = spark.createDataFrame([(0, 0, 780), (0, 100, 280)], "pid_l long, pid_r long, w long")
    monkeypatch.setattr(L, "PAIRS_PER_TASK", 100)
    listed = L.record_pairs(pairs, members, per_list=8)
    assert listed.rdd.getNumPartitions() == 11  # tasks follow the pairs that are listed, not the two rows they come from
    want = [*itertools.combinations(range(40), 2), *itertools.product(range(40), range(100, 107))]
    assert sorted((r["id1"], r["id2"]) for r in listed.collect()) == sorted(want)


def _parts(spark, rows) -> str:
    folder = files.fresh_dir(spark, "parts")
    df = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    df.write.parquet(f"{folder}/part.parquet")
    return folder


def test_components_of_records_without_listing_their_pairs(spark, monkeypatch):
    from wardline.plans import linkage_plans as P

    monkeypatch.setattr(L, "record_pairs", None)
    rows = [(i, "red cup", "b1", "t", 5, 1.0) for i in range(1, 6)]  # copies of one part
    rows += [(10, "red cup", "b1", "t", 7, 1.0), (10, "tin", "b3", "t", 9, 1.0), (11, "tin", "b3", "t", 9, 2.0)]  # a key that comes twice ties two groups
    rows += [(20, "mug", None, "t", 3, 1.0), (21, "mug", None, "t", 3, 1.0), (30, "pan", "b2", "t", 4, 1.0), (30, "pan", "b2", "t", 4, 1.0)]
    got = P.lk12_components_exact_edges(spark, _parts(spark, rows)).collect()
    assert sorted((r["id"], r["component"]) for r in got) == [*((i, 1) for i in range(1, 6)), (10, 1), (11, 1), (20, 20), (21, 21), (30, 30)]


def test_blocking_counts_candidates(spark):
    from wardline.plans.checks import dq46_blocking_completeness as query

    copies = [(i, "red cup", "b1", "t", 5, 1.0) for i in range(1, 6)] + [(10, "red cup", "b1", "t", 7, 1.0)]
    got = query(spark, _parts(spark, copies)).first()
    assert (got["n_disjunctive_join"], got["n_union_by_counts"]) == (15, 15)
    got = query(spark, _parts(spark, [(1, "cup", "b1", "t", 5, 1.0), (2, "pan", "b2", "u", 6, 1.0)])).first()
    assert (got["n_disjunctive_join"], got["n_union_by_counts"]) == (0, 0)


def test_profiles_without_partner_stay_where_they_are(spark):
    prof = spark.createDataFrame([(i, 1, f"k{i // 2 if i < 6 else i}") for i in range(30)], "pid long, n long, key string")
    pairs = L.sided_pairs(prof, [["key"]])
    assert sorted((r["pid_l"], r["pid_r"]) for r in pairs.collect()) == [(0, 1), (2, 3), (4, 5)]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Join LeftOuter" not in plan


def test_rounds_that_fit_one_task_do_not_shuffle(spark, capsys):
    edges = packed(spark.createDataFrame([(2, 1), (3, 2), (5, 4), (6, 5), (6, 3)], "u long, v long"), 5)
    stars = _small_star(packed(_large_star(edges, 5), 5), 5)
    stars.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert sorted(map(tuple, stars.collect())) == [(2, 1), (3, 1), (4, 2), (5, 4), (6, 2)]
    many = 10**6  # the same round for edges in many tasks
    assert sorted(map(tuple, _small_star(_large_star(edges, many), many).collect())) == [(2, 1), (3, 1), (4, 2), (5, 4), (6, 2)]


def test_pairs_of_parts_are_formed_where_they_are_used(spark, monkeypatch):
    """Pairs grow with the square of a block: none is kept, settled ones are not sent to Python, single records meet without lists."""
    from pyspark.sql import DataFrame

    from wardline.plans import linkage_plans as P

    dice = random.Random(9)
    rows = [(i, dice.choice(["red cup", "red cop", "tin pan", None]), dice.choice(["b1", "b2"]), dice.choice(["t", "u"]), dice.randrange(4), 900 + dice.randrange(40) / 10) for i in range(60)]
    rows += [(70 + i, *rows[0][1:]) for i in range(3)] + [(5, "red cup", "b1", "t", 1, 900.0), (5, "tin pan", "b2", "u", 1, 901.0)]  # copies, and a key of three parts
    folder = _parts(spark, rows)
    kept = []
    checkpoint = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda df, *a: kept.append(df.columns) or checkpoint(df, *a))
    lk = P.Linkage(P.Tables(spark, folder))
    assert not any("pid_l" in c for c in kept)
    # as it was: every pair of profiles compared and listed by its members
    pairs = L.gammas(L.sided_pairs(lk.prof, P.RULES, L.compared_columns(lk.comps)), lk.comps).select("pid_l", "pid_r", "rule", "w", *P.GAMMA_COLS).checkpoint()
    ids = lk.members.select(F.col("pid").alias("p"), "id")
    listed = pairs.join(ids.select(F.col("p").alias("pid_l"), F.col("id").alias("a")), "pid_l").join(ids.select(F.col("p").alias("pid_r"), F.col("id").alias("b")), "pid_r")
    listed = listed.filter("pid_l != pid_r or a < b").select(F.least("a", "b").alias("id1"), F.greatest("a", "b").alias("id2"), "rule", *P.GAMMA_COLS)
    got = P.lk2_candidate_pairs(spark, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, listed.collect()))
    assert got.count() == lk.record_pairs().count() > 500
    monkeypatch.setattr(L, "MAX_REPEATED", 0)
    assert sorted(map(str, P.lk2_candidate_pairs(spark, folder).collect())) == sorted(map(str, listed.collect()))


def test_thinned_edges_keep_the_components(spark):
    dice = random.Random(3)
    edges = [(dice.randrange(400), dice.randrange(400)) for _ in range(300)] + [(a, b) for a in range(500, 540) for b in range(500, 540)] + [(900, 900), (None, 3)]
    nodes = sorted({n for e in edges for n in e if n is not None})
    few = thinned(spark.createDataFrame(edges, "src long, dst long").coalesce(1)).collect()
    assert len(few) < len(nodes) and {n for e in few for n in e} == set(nodes)
    assert components_of(nodes, few) == components_of(nodes, [e for e in edges if None not in e])
    words = thinned(spark.createDataFrame([("b", "a"), ("c", "b"), ("z", "z")], "src string, dst string").coalesce(1)).collect()
    assert sorted(map(tuple, words)) == [("a", "b"), ("a", "c"), ("z", "z")]
