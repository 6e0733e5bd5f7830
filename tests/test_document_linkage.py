"""Linkage on documents: levels, a fitted model that finds planted copies, refusals."""

import random

import pytest
from pyspark.sql import functions as F

from wardline.operators import linkage as L
from wardline.plans import document_linkage as D


class Planted:
    """A documents table with known copies."""

    def __init__(self, spark, rows):
        self.spark = spark
        self.documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 12)))
    rows, truth = [], set()
    for i in range(150):
        text = [word() for _ in range(rnd.randint(60, 140))]
        lang = rnd.choice(["en", "fr"])
        rows.append((i, " ".join(text), lang, f"s{i % 7}"))
        if i < 60:  # an edited copy: a few short words changed
            short = [k for k, w in enumerate(text) if len(w) < 7]
            for k in rnd.sample(short, 3):
                text[k] = word()[:6]
            rows.append((1000 + i, " ".join(text), lang, f"s{i % 7}"))
            truth.add((i, 1000 + i))
    rows += [(5000, None, "en", "s1"), (5001, "", "en", "s1"), (5002, "", "fr", "s2")]
    return Planted(spark, rows), truth


def test_fitted_model_finds_planted_copies(planted):
    table, truth = planted
    run = D.Run(table)
    model = run.fit()
    assert not L.untrained(run.comps, model.sessions)
    found = {(r["id1"], r["id2"]) for r in run.record_pairs(run.scored(model).filter(F.col("probability") >= 0.5)).collect()}
    assert len(found & truth) >= 0.95 * len(truth) and len(found - truth) <= 2
    clusters = {r["id"]: r["cluster_id"] for r in run.clusters(run.scored(model)).collect()}
    assert sum(clusters[b] == a for a, b in truth) >= 0.95 * len(truth)
    assert clusters[5001] == 5001 and clusters[5002] == 5002  # blanks never link
    metrics = run.metrics_along(run.scored(model), [D.THRESHOLD]).first()
    assert metrics["n_records"] == 212 and metrics["n_found_restricted"] <= metrics["n_true_restricted"]


def test_two_column_levels(spark):
    rows = [("a", "x", "a", "x"), ("a", "x", "a", "y"), (None, "x", "a", "x"), ("a", "x", "b", None)]
    df = spark.createDataFrame(rows, "p_l string, q_l string, p_r string, q_r string")
    level = lambda neutral: [r[0] for r in df.select(L.PairComparison("m", ("p", "q"), neutral).gamma(lambda c: F.col(f"{c}_l"), lambda c: F.col(f"{c}_r"))).collect()]
    assert level(False) == [1, 0, 2, 2] and level(True) == [1, 0, -1, -1]


def test_text_levels_use_distinct_values(spark):
    rows = [("martha", "martha"), ("martha", "marhta"), ("jellyfish", "smellyfish"), ("abc", "xyz"), (None, "abc"), ("martha", "marhta")]
    df = spark.createDataFrame(rows, "t_l string, t_r string")
    assert [r[0] for r in L.gammas(df, [L.TextComparison("t", "t")]).orderBy("t_l", "t_r").select("gamma_t").collect()] == [-1, 0, 1, 2, 2, 3]


def test_degenerate_models_are_refused():
    comps = [L.Comparison("c", "c", ((1, "exact", L.exact),), null_level=False)]
    with pytest.raises(ValueError):
        L.refuse_degenerate(L.Model(0.01, {"c": {0: 0.8, 1: 0.2}}, {"c": {0: 0.5, 1: 0.5}}), comps)
    with pytest.raises(ValueError):
        L.refuse_degenerate(L.Model(0.0, {"c": {0: 0.1, 1: 0.9}}, {"c": {0: 0.5, 1: 0.5}}), comps)
    L.refuse_degenerate(L.Model(0.01, {"c": {0: 0.1, 1: 0.9}}, {"c": {0: 0.5, 1: 0.5}}), comps)


def test_components_of_a_long_chain(spark):
    from wardline.operators.graph import connected_components

    nodes = spark.range(1000).withColumnRenamed("id", "node")
    edges = spark.range(999).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert connected_components(nodes, edges).agg(F.countDistinct("component")).first()[0] == 1


def test_variants_form_their_pairs_once(planted, monkeypatch):
    run = D.Run(planted[0])
    named = {"full": run.comps, "no_tf": D.comparisons(use_tf=False), "window": D.comparisons(length_window=25)}
    apart = {}
    for name, comps in named.items():
        one = run.variant(comps)
        apart[name] = (one.fit(), sorted(map(tuple, one.patterns.select(*sorted(one.patterns.columns)).collect()), key=repr))
    calls = []
    monkeypatch.setattr(L, "sided_pairs", lambda *a, made=L.sided_pairs, **k: calls.append("pairs") or made(*a, **k))
    monkeypatch.setattr(L, "random_pairs", lambda *a, made=L.random_pairs, **k: calls.append("random") or made(*a, **k))
    for name, one in run.variants(named).items():
        model, patterns = apart[name]
        assert sorted(map(tuple, one.patterns.select(*sorted(one.patterns.columns)).collect()), key=repr) == patterns
        fitted = one.fit()
        assert all(abs(fitted.m[c][g] - p) < 1e-9 for c, levels in model.m.items() for g, p in levels.items())
        assert all(abs(fitted.u[c][g] - p) < 1e-9 for c, levels in model.u.items() for g, p in levels.items())
    assert sorted(calls) == ["pairs", "random"]


def test_shared_runs_last_as_long_as_they_are_asked_for(spark, monkeypatch):
    made = []
    monkeypatch.setattr(D, "Run", lambda t: made.append(t) or type("R", (), {"comps": [], "patterns": None, "scored": lambda self, m, of=None: spark.range(1)})())
    monkeypatch.setattr(D, "fixed_model", lambda comps: None)
    from wardline.session import checkpoint_dir

    checkpoint_dir(spark)
    with D.shared_runs():
        D.fixed_run(spark, "one")
        D.fixed_run(spark, "one", patterns=True)
        D.fixed_run(spark, "other")
    assert len(made) == 2
    D.fixed_run(spark, "one")
    D.fixed_run(spark, "one")
    assert len(made) == 4


def test_linkage_tables_are_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(x):
        made.add(1)
        return x

    levels = [F.lit(1).alias(g) for g in D.GAMMAS]
    scored = spark.range(4).select(*[F.col("id").alias(c) for c in ("pid_l", "id1", "id2")], F.lit(0).alias("rule"), *levels, F.lit(1.0).alias("match_weight"), F.lit(0.7).alias("probability"), F.lit(1).alias("w"), F.lit(True).alias("is_true"))

    class Made:
        record_pairs = staticmethod(lambda pairs: pairs.withColumn("id1", noted.asNondeterministic()("id1")))
        clusters = staticmethod(lambda pairs: pairs.select(F.col("pid_l").alias("id")))
        truth_pairs = staticmethod(lambda: 4)

    monkeypatch.setattr(D, "fitted_run", lambda *a: (Made, scored))
    found = {r["table_name"]: (r["n_rows"], r["n_rows_of_run"]) for r in D.snk15_linkage_tables(spark, "any").collect()}
    assert found == {"pairs": (4, 4), "clusters": (4, 4), "evaluation": (len(D.GRID), len(D.GRID))}
    assert made.value == 4  # not once more for every time the table is written
