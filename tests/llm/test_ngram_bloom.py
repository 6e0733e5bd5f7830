"""The language model: exact base scores, quantised counts, the model against exact counts."""

import collections
import math
import re
import zlib

import numpy as np

from wardline.llm import ngram_bloom as lm

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</end>"]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def check(rows, docs):
    """Base columns against plain counting; returns the counts of words and pairs."""
    words, pairs = collections.Counter(), collections.Counter()
    for d, t in docs:
        if not held_out(d):
            ts = tokens(t)
            words.update(ts)
            pairs.update(zip(["<start>", *ts], ts))
    n, v = sum(words.values()), len(words)
    expected = collections.Counter()
    for d, t in docs:
        ts = tokens(t)
        base = sum(math.log10((words[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ts)
        expected[(d, held_out(d), len(ts), sum(words[x] > 0 for x in ts), n, round(base, 4))] += 1
    assert collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows) == expected
    return words, pairs, n, v


def test_base_scores_and_model(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(None, None), (5000001, ""), (5000002, " É ABC\x0bdef"), (3, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = lm.score_texts(df).collect()
    words, pairs, n, v = check(rows, docs)
    # the score against exact counts: quantising and false hits move a token by little
    mu = rows[0]["mu"]
    by = {r["doc_id"]: r for r in rows}
    for d, t in docs[:60]:
        ts = tokens(t)
        exact = 0.0
        for u, w in zip(["<start>", *ts], ts):
            context = words["</end>"] if u == "<start>" else words[u]
            exact += math.log10((pairs[u, w] + mu * (words[w] + 0.1) / (n + 0.1 * (v + 1))) / (context + mu))
        assert abs(by[d]["score"] - exact) <= 0.1 * len(ts) + 1
    trained = [r for r in rows if not r["held_out"]]
    assert sum(r["score"] for r in trained) > sum(r["base_score"] for r in trained)
    monkeypatch.setattr(lm, "FREQUENT", 500)  # most words now take the join
    check(lm.score_texts(df).collect(), docs)


def test_counts_are_read_back():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**63, 20_000).astype(np.uint64) * np.uint64(2))
    counts = np.minimum(rng.zipf(1.6, len(keys)), 10**7)
    segments = {}
    edges = np.append(lm._bucket_edges(4)[1:], np.uint64(2**64 - 1))
    for b in range(4):
        mine = lm._bucket_of(keys, 4) == b
        assert (keys[mine] <= edges[b]).all()
        segments[b] = lm.build_segment(keys[mine], counts[mine], 1 << 24).tobytes()
    got = lm.Filter(segments, 4).counts(keys)
    assert (got >= lm.LEVEL_VALUE[lm.levels(counts)] - 1e-9).all()  # never understated
    small = counts <= 3
    assert (got[small] == counts[small]).mean() > 0.95
    assert (np.abs(np.log(got / counts)) <= np.log(lm.BASE)).mean() > 0.95
    other = rng.integers(0, 2**63, 20_000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert (lm.Filter(segments, 4).counts(other) > 0).mean() < 0.05


def test_empty_table_and_long_text(spark):
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = [(1, "word " * 200_000, 1), (2, None, 1)]
    rows = lm.score_texts(spark.createDataFrame(docs, "doc_id long, text string, key int")).collect()
    assert sorted(r["n_tokens"] for r in rows) == [1, 200_001]
    check(rows, [(d, t) for d, t, _ in docs])


def test_a_filter_beyond_the_broadcast_keeps_every_ngram(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(None, None), (5000001, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 14)  # many buckets
    whole = lm.score_texts(df).collect()
    monkeypatch.setattr(lm, "MAX_FILTER_BYTES", 1 << 12)
    rows = lm.score_texts(df).collect()
    check(rows, docs)
    by = {r["doc_id"]: r for r in whole}
    assert {r["mu"] for r in rows} == {r["mu"] for r in whole} and {r["doc_id"] for r in rows} == set(by)
    assert all(abs(r["score"] - by[r["doc_id"]]["score"]) < 1e-6 for r in rows)


def test_segments_keep_once_seen_ngrams():
    keys = np.unique(np.random.default_rng(4).integers(0, 2**63, 50_000).astype(np.uint64))
    segment = lm.build_segment(keys, np.ones(len(keys), np.int64), 1 << 17)  # far fewer bits than entries need
    assert (lm.Filter({0: segment.tobytes()}, 1).counts(keys) > 0).all()


def test_frequent_ngrams_are_probed_once(monkeypatch):
    rng = np.random.default_rng(3)
    keys, counts = np.sort(rng.integers(1, 2**63, 3000).astype(np.uint64)), rng.integers(1, 200, 3000)
    f = lm.Filter({0: lm.build_segment(keys, counts).tobytes()}, 1)
    asked = np.concatenate([keys[::-1], rng.integers(1, 2**63, 500).astype(np.uint64)])
    first = f.levels(asked)
    assert (first[:3000] >= lm.levels(counts)[::-1]).all()
    frequent, sizes, probed = int((first >= lm.KEPT_LEVEL).sum()), [], lm.Filter._probed
    monkeypatch.setattr(lm.Filter, "_probed", lambda self, k: sizes.append(len(k)) or probed(self, k))
    assert (f.levels(asked) == first).all()
    assert frequent > 0 and sizes == [len(asked) - frequent]
    monkeypatch.setattr(lm, "KEPT", 10)  # a full store keeps what it has, and answers stay the same
    g = lm.Filter({0: f.data.tobytes()}, 1)
    assert (g.levels(asked) == first).all() and (g.levels(asked) == first).all() and len(g.kept[0]) == 0
