"""Sampled segmentations: exact round trip, probabilities, reproducibility."""

import collections
import math
import tracemalloc

import numpy as np
import pytest

from wardline.llm import piece_sampling as ps

ODD = [None, "", " ", "a", " hello  world\n\tx ", "▁ literal ▁▁ ▁x", "日本語 𝒳 é́ \r\n 😀😀", "x" * 150_000, " " * 3000 + "\n", "The quick\x00 brown \x7f fox ", "tail  "]


@pytest.fixture(scope="module")
def vocabulary():
    return ps.load_vocabulary()


@pytest.fixture(scope="module")
def sampler(vocabulary):
    return ps.Sampler(vocabulary)


def test_round_trip(sampler):
    ids = sampler.encode(ODD, list(range(len(ODD))))
    for text, x in zip(ODD, ids):
        assert (x is None) == (text is None)
        assert text is None or sampler.decode(x.tolist()) == text


def test_rows_do_not_depend_on_their_batch(sampler, monkeypatch):
    keys = [7, None, *range(len(ODD) - 2)]
    whole = sampler.encode(ODD, keys)
    alone = [sampler.encode([t], [k])[0] for t, k in zip(ODD, keys)]
    monkeypatch.setattr(ps, "CHUNK", 1000)
    cut = sampler.encode(ODD, keys)
    for a, b, c in zip(whole, alone, cut):
        assert (a is None and b is None and c is None) or (np.array_equal(a, b) and np.array_equal(a, c))
    other = sampler.encode([ODD[4]] * 50, list(range(50)))
    assert len({tuple(x) for x in other}) > 1  # other keys, other segmentations
    assert any(not np.array_equal(a, b) for a, b in zip(other, sampler.encode([ODD[4]] * 50, list(range(50)), seed=1)))


def test_memory_of_a_large_batch(sampler):
    """Two million characters of different words take the memory of one chunk, beside their ids."""
    texts = [" ".join(f"word{i * 100 + k:x} other{k}" for k in range(100)) for i in range(1100)]
    assert 1_700_000 < sum(map(len, texts)) < 2_500_000
    tracemalloc.start()
    try:
        ids = sampler.encode(texts, list(range(len(texts))))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sampler.decode(ids[7].tolist()) == texts[7]
    assert most < 160e6, most


@pytest.mark.parametrize("unit", [" hello", "thereof", "étés", "a丁\U0001f600"])
def test_segmentations_come_in_proportion(vocabulary, sampler, unit):
    """Against an enumeration of all segmentations."""
    known = {vocabulary["pieces"][i].replace(ps.SPACE, " "): i for i in vocabulary["normal"]}
    found = {}

    def walk(i, ids, logp):
        if i == len(unit):
            found[tuple(ids)] = logp
            return
        if unit[i] not in known:
            walk(i + 1, [*ids, *(vocabulary["bytes"][b] for b in unit[i].encode())], logp + vocabulary["logp"].min() - 1.0)
        for j in range(i + 1, len(unit) + 1):
            if unit[i:j] in known:
                k = known[unit[i:j]]
                walk(j, [*ids, k], logp + vocabulary["logp"][k])

    walk(0, [], 0.0)
    total = sum(map(math.exp, found.values()))
    n = 20_000
    drawn = collections.Counter(tuple(x) for x in sampler.encode([unit] * n, list(range(n))))
    assert set(drawn) <= set(found)
    for ids, logp in found.items():
        p = math.exp(logp) / total
        assert abs(drawn[ids] / n - p) <= 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_dataframes(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no key", "y"), (3, ODD[3], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string")
    encoded = ps.encode_documents(docs)
    assert encoded.columns == [*docs.columns, "_piece_ids"]
    back = ps.decode_documents(encoded, ids="_piece_ids").collect()
    assert len(back) == len(rows) and all(r["decoded"] == r["text"] for r in back)
    report = ps.encoding_report(docs).collect()
    assert all(r["lossless"] for r in report)
    assert len({r["ids_sha256"] for r in report if r["doc_id"] == 3}) == 1
    assert ps.encode_documents(docs.limit(0)).collect() == [] and ps.encoding_report(docs.limit(0)).collect() == []


def test_documents(spark):
    rows = ps.encoding_report(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert rows and all(r["lossless"] and r["n_pieces"] > 0 for r in rows)
