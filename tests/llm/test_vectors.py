"""Near-duplicate vectors and nearest neighbours against all pairs."""

import collections

import numpy as np
import pytest

from wardline.llm import multi_index, pstable

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, c int"


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 64)).astype(np.float32)
    out = []
    for b in base:
        for _ in range(int(rng.integers(1, 8))):
            out.append((b + rng.standard_normal(64) * rng.choice([0, 0.05, 0.2, 0.3])).astype(np.float32).tolist())
    odd = [None, [0.0] * 64, [float("nan")] * 64, [1.0, None], [1.0, 2.0], [2.0, 4.0], [float("inf")] * 64, [], out[5], out[5]]
    hot = [(base[3] + rng.standard_normal(64) * 0.02).astype(np.float32).tolist() for _ in range(200)] + [base[3].tolist()] * 50
    out = list(enumerate(out + odd + hot))
    return [(*r, 0) for r in out] + [(*out[7], 1), (None, out[0][1], 2)]


def all_links(rows):
    """vec_id -> (links to other ids, smallest reachable id), by all pairs."""
    vectors = {i: v for i, v, *_ in rows if i is not None}
    by_length = collections.defaultdict(list)
    for i, v in vectors.items():
        if good(v):
            by_length[len(v)].append(i)
    links = {i: [] for i in vectors}
    for ids in by_length.values():
        x = np.stack([np.asarray(vectors[i], np.float64) for i in ids])
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, near in enumerate(x @ x.T >= 0.9):
            links[ids[a]] = [ids[b] for b in np.flatnonzero(near) if b != a]
    part = {}
    for i in sorted(vectors):
        todo = [i] if i not in part else []
        while todo:
            j = todo.pop()
            if j not in part:
                part[j] = i
                todo += links[j]
    return {i: (len(links[i]), part[i]) for i in vectors}


def test_links_and_components(spark, rows):
    expected = all_links(rows)
    got = pstable.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    assert found.pop(None) == (0, None)
    wrong = [i for i in expected if found[i] != expected[i]]
    assert len(wrong) <= 0.02 * len(expected)  # pairs close to the threshold may be missed
    assert all(found[i][0] <= expected[i][0] for i in expected)  # none is made up
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_embeddings_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pstable.near_duplicate_vectors(table).collect()}
    assert found == all_links([(r["vec_id"], r["embedding"]) for r in table.collect()])


def test_tables_follow_theory():
    for n in (1000, 10**6):
        depth, tables = pstable.plan(n)
        assert n * pstable.agree(2**0.5) ** depth <= pstable.FAR
        assert (1 - pstable.agree(0.2**0.5) ** depth) ** tables <= pstable.MISS
    rng = np.random.default_rng(0)
    a = rng.standard_normal((400, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.standard_normal((400, 64))
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    b = 0.9 * a + np.sqrt(1 - 0.81) * side  # cosine 0.9 exactly
    share = (pstable.bucket_hashes(a, 1, 64) == pstable.bucket_hashes(b, 1, 64)).mean()
    assert abs(share - pstable.agree(0.2**0.5)) < 0.03


def brute_nearest(vectors, q, k=10):
    x = np.asarray(vectors[q], np.float64)
    near = sorted((float(np.sqrt(((x - np.asarray(v, np.float64)) ** 2).sum())), i) for i, v in vectors.items() if i != q and len(v) == len(x))
    return near[:k]


def test_search_is_exact_on_few_vectors(spark, rows):
    vectors = {i: v for i, v, *_ in rows if i is not None and good(v)}
    found = collections.defaultdict(list)
    for r in multi_index.search_embeddings(spark.createDataFrame(rows, SCHEMA), 10, 10).collect():
        found[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    assert set(found) == {i for i in vectors if i % 10 == 0}
    for q, near in found.items():
        expected = brute_nearest(vectors, q)
        assert [r for r, *_ in sorted(near)] == list(range(1, len(expected) + 1))
        assert [v for *_, v in sorted(near)] == [v for _, v in expected]
        assert np.allclose([s for _, s, _ in sorted(near)], [s for s, _ in expected], atol=1e-12)


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r["vec_id"]: r["embedding"] for r in table.collect()}
    found = collections.defaultdict(set)
    for r in multi_index.search_embeddings(table, 10, 100).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = sum(len(found[q] & {v for _, v in brute_nearest(vectors, q)}) for q in found)
    assert hits >= 0.9 * 10 * len(found)


def test_cells_come_in_order_of_their_summed_distance():
    rng = np.random.default_rng(4)
    one, two = rng.random(9), rng.random(7)
    counts = rng.integers(0, 4, (9, 7))
    cells = multi_index.cells_by_distance(one, two, counts, 10**9)
    assert sorted(cells) == sorted(zip(*map(list, np.nonzero(counts))))
    sums = [one[i] + two[j] for i, j in cells]
    assert sums == sorted(sums)
    assert sum(counts[c] for c in multi_index.cells_by_distance(one, two, counts, 12)) >= 12


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pstable.near_duplicate_vectors(empty).collect() == [] and multi_index.search_embeddings(empty).collect() == []
    few = spark.createDataFrame([(100, [1.0, 0.0], 1), (200, None, 1)], SCHEMA)
    assert multi_index.search_embeddings(few).collect() == []
    assert {(r["vec_id"], r["n_links"], r["kept"]) for r in pstable.near_duplicate_vectors(few).collect()} == {(100, 0, True), (200, 0, True)}
