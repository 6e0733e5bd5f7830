"""The pipeline's stages in order, each against its operator's rule, and the registered queries."""

import collections
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from test_line_dedup import brute as brute_lines  # noqa: E402
from test_mixing_and_sharding import targets  # noqa: E402
from test_order_minhash import groups  # noqa: E402

from wardline.llm import piece_sampling, queries  # noqa: E402
from wardline.llm.common import written  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, SF), f"test-{name}")
        steps[name] = (before, docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = steps["toxicity"]
    left = {r["doc_id"] for r in after}
    assert sum(labels.get(r["doc_id"]) == 0 and r["doc_id"] not in left for r in before) <= 3
    assert sum(labels.get(r["doc_id"]) == 1 and r["doc_id"] not in left for r in before) >= 0.8 * sum(labels.values())
    before, after = steps["line_dedup"]
    assert {r["doc_id"]: r["text"] for r in after} == brute_lines([(r["doc_id"], r["text"]) for r in before], 50)
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = steps["minhash_near_dedup"]
    group = groups([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted({group[r["doc_id"]] for r in before})
    before, after = steps["mixing"]
    size, goal = targets([(r["doc_id"], r["text"], r["source"]) for r in before])
    taken = collections.Counter()
    for r in after:
        taken[r["source"]] += len(r["text"].encode().split())
    assert all(abs(taken[s] - goal[s]) <= 0.1 * goal[s] + 50 for s in goal) and size
    before, after = steps["sentencepiece"]
    sampler = piece_sampling.Sampler(piece_sampling.load_vocabulary())
    assert len(after) == len(before) and all(sampler.decode(r["piece_ids"]) == r["text"] for r in after)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    norm = lambda x: round(x, 6) if isinstance(x, float) else x
    assert sorted(repr([norm(r[names.index(c)]) for c in sorted(names)]) for r in cursor.fetchall()) == sorted(repr([norm(r[c]) for c in sorted(names)]) for r in df.collect())
