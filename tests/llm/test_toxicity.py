"""The classifier chain: held-out accuracy, the chain itself, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from wardline.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    chain = toxicity.train_chain(docs, labels.where(half))
    rows = toxicity.score(docs, chain).join(labels.where(~half), "doc_id").collect()
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["p_toxic"] >= 0.5 for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["p_toxic"] >= 0.5 for r in rows if not r["toxic"]) <= 0.01 * len(rows)
    right = sum((r["p_low_quality"] >= 0.5) == (r["quality"] == 0) for r in rows)
    assert right >= 0.97 * len(rows)


def test_later_models_use_earlier_probabilities():
    """A category that is the earlier one flipped on a weak feature is only learnt through the chain."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 3)).astype(np.float32)
    first = (x[:, 0] > 0).astype(float)
    model = toxicity.fit(x, first)
    p = toxicity._sigmoid(model.logit(x))
    later = toxicity.fit(np.concatenate([x[:, 1:], toxicity._link(p)], axis=1), first)
    assert later.weights[-1] > 0.5 and model.weights[0] > 1


def test_edge_cases(spark):
    texts = [f"nasty word{i % 5} here" if i % 3 == 0 else f"plain word{i % 5} here" for i in range(60)]
    docs = [(i, t, 1) for i, t in enumerate(texts)] + [(100, None, 1), (101, "", 1), (102, "... !!", 1), (5, texts[5], 2), (None, "nasty nasty", 3), (103, "nasty " * 50_000, 4)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, P_toxic int")
    labels = [(i, 1 if i % 2 else 0, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (999, 1, 1), (7, None, None), (100, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == 66
    by = {r["doc_id"]: r["toxic"] for r in got}
    assert not by[100] and not by[101] and not by[102] and by[None] and by[103]
    assert all(by[i] == (i % 3 == 0) for i in range(60))
    clean = toxicity.drop_toxic(docs, labels)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted([i for i in range(60) if i % 3] + [5, 100, 101, 102])


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["p_toxic"] for r in toxicity.toxicity_report(docs, none).collect()} == {1: 0.5, 2: 0.0}
    one_class = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert [r["toxic"] for r in toxicity.toxicity_report(docs, one_class).collect()] == [False, False]
    assert toxicity.toxicity_report(docs.limit(0), one_class).collect() == []


def test_the_fit_uses_the_whole_bound(spark, monkeypatch):
    """12,000 labelled rows, the bound that the README states."""
    sizes = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda x, y, use=None: (sizes.append((len(x), int(use.sum()))), fit(x, y, use, steps=1))[1])
    docs = spark.range(12_500).select(F.col("id").alias("doc_id"), F.concat(F.when(F.col("id") % 3 == 0, "nasty word").otherwise("plain word"), (F.col("id") % 5).cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    toxicity.train_chain(docs, labels)
    assert max(sizes) == (12_000, 12_000)


def test_fitting_gives_its_memory_back(spark, monkeypatch):
    """The driver goes on with the next stage: what fitting took is not kept."""
    given = []
    monkeypatch.setattr(toxicity, "give_back", lambda: given.append(1))
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "bad bad words") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 1 - i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(docs, labels).count() > 0
    assert given == [1]
