"""Near-duplicate documents against alignment of all pairs that share words."""

import collections
import random

import numpy as np
import xxhash

from pyspark.sql import functions as F

from wardline.llm import order_minhash as om
from wardline.sinks.scratch import Scratch

SF = "/root/testdata/sf0.01"


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + (x == y))
    return table[-1][-1]


def groups(docs):
    """Smallest doc_id of each document's group, from all pairs (text pairs without a common word run are unlike)."""
    first, parent = {}, {d: d for d, t in docs if t is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    by_run = collections.defaultdict(list)
    for d, t in sorted((d, t) for d, t in docs if t is not None):
        if t in first:
            join(d, first[t])
            continue
        first[t] = d
        w = om.words(t)
        for run in {tuple(w[i : i + 2]) for i in range(len(w) - 1)}:
            by_run[run].append(d)
    texts, seen = dict(docs), collections.Counter()
    for ds in by_run.values():
        if len(ds) <= 60:
            for i, a in enumerate(ds):
                for b in ds[i + 1 :]:
                    seen[a, b] += 1
    for (a, b), n in seen.items():
        if n >= 3 and om.similarity(texts[a], texts[b]) >= om.SIMILARITY:
            join(a, b)
    return {d: root(d) if t is not None else d for d, t in docs}


def test_alignment_is_the_common_subsequence():
    rnd = random.Random(5)
    for _ in range(300):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randint(1, 25))] for _ in range(2))
        assert om.aligned_words(a, b, 99) == lcs(a, b)
        longer = max(len(a), len(b))
        if lcs(a, b) >= 0.8 * longer:  # the band loses nothing that reaches the threshold
            assert om.aligned_words(a, b, int(0.2 * longer) + 1) == lcs(a, b)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    expected = groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    rows = om.near_duplicates(docs).collect()
    assert sum(r["class_id"] != expected[r["doc_id"]] for r in rows) == 0
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in rows)


def test_histograms_never_undercount_shared_words():
    rnd = random.Random(8)
    for _ in range(400):
        sides = []
        for _ in range(2):
            n = rnd.choice((0, 1, 5, 60, 300, 9000))
            ws = [f"w{rnd.randrange(rnd.choice((3, 500, 10**6)))}" for _ in range(n)]
            ids = np.array([xxhash.xxh64_intdigest(w) for w in ws], np.uint64)
            sides.append((collections.Counter(ws), om._counters(om.histogram(ids), n), n))
        (x, hx, nx), (y, hy, ny) = sides
        assert hx.sum() == nx and hy.sum() == ny
        assert sum((x & y).values()) <= om.shared_at_most(hx, hy) == om.shared_at_most(hy, hx) <= min(nx, ny)


def edited(words, rnd, share):
    return " ".join(w if rnd.random() > share else f"z{rnd.randrange(9999)}" for w in words)


def test_hot_group_and_common_passage(spark):
    """Many copies of one text, and unlike documents that share a long passage."""
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randrange(5000)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    docs = [(i, edited(base, rnd, 0.03)) for i in range(150)]
    docs += [(1000 + i, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(30)])) for i in range(200)]
    pairs = [(2000 + 2 * i, [word() for _ in range(30)] + passage + [word() for _ in range(30)]) for i in range(40)]
    docs += [(d, " ".join(w)) for d, w in pairs] + [(d + 1, edited(w, rnd, 0.03)) for d, w in pairs]
    rows = {r["doc_id"]: r["class_id"] for r in om.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {rows[i] for i in range(150)} == {0}
    assert all(rows[1000 + i] == 1000 + i for i in range(200))
    assert sum(rows[d + 1] != d for d, _ in pairs) == 0


def test_edge_cases(spark):
    long = " ".join(f"l{i % 7919}" for i in range(60_000))
    docs = [
        (3, "Same text here!", 1), (1, "Same text here!", 2), (None, "Same text here!", 3), (5, None, 4), (6, None, 5), (7, "", 6), (8, "", 7), (9, "!!", 8), (10, "?!", 9),
        (20, long, 10), (21, long + " more", 11), (30, "repeated row", 12), (30, "repeated row", 12), (31, "a", 13),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, Node int")
    got = {(r["doc_id"], r["class_id"], r["kept"]) for r in om.near_duplicates(df).collect()}
    assert {(3, 1, False), (1, 1, True), (None, 1, False), (5, 5, True), (6, 6, True), (7, 7, True), (8, 7, False), (9, 9, True), (10, 10, True), (20, 20, True), (21, 20, False), (31, 31, True)} <= got
    out = om.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 5, 6, 7, 9, 10, 20, 30, 31]
    assert om.near_duplicates(df.limit(0)).collect() == [] and om.drop_near_duplicates(df.limit(0)).collect() == []


def test_scattered_edits_up_to_the_threshold(spark):
    """10 to 20 % of the words replaced at random places."""
    rnd = random.Random(11)
    docs, pairs = [], []
    for i in range(240):
        n, share = rnd.choice((40, 100, 300)), (0.1, 0.15, 0.2)[i % 3]
        text = [f"w{rnd.randrange(50_000)}" for _ in range(n)]
        other = list(text)
        for at in rnd.sample(range(n), round(share * n)):
            other[at] = f"z{rnd.randrange(50_000)}"
        assert om.similarity(" ".join(text), " ".join(other)) >= om.SIMILARITY
        docs += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(other))]
        pairs.append((share, 2 * i))
    rows = {r["doc_id"]: r["class_id"] for r in om.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = collections.Counter(share for share, d in pairs if rows[d + 1] == d)
    assert found[0.1] == 80 and found[0.15] >= 79 and found[0.2] >= 75
    assert om.pair_sketches(0.7) > om.pair_sketches(0.8) > om.pair_sketches(0.9)


def test_few_pairs_are_compared_in_few_tasks(spark):
    """Tasks follow the pairs, not the number of shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = spark.createDataFrame([(i % 7, 100 + i) for i in range(600)], "a long, b long")
        nodes = spark.createDataFrame([(i, f"t{i}") for i in range(700)], "node long, x string")
        met = om._beside(pairs, nodes)
        assert met.rdd.getNumPartitions() == 2
        assert sorted(map(tuple, met.select("a", "b", "xa", "xb").collect())) == sorted((i % 7, 100 + i, f"t{i % 7}", f"t{100 + i}") for i in range(600))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_links_follow_members_not_shared_sketches(spark):
    """A large group of near copies, amid unlike documents that share a passage with it: about one link to a member."""
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randrange(50_000)}"
    passage = [word() for _ in range(40)]
    base = [word() for _ in range(60)] + passage + [word() for _ in range(60)]
    docs = [(i, edited(base, rnd, 0.06)) for i in range(400)]
    docs += [(1000 + i, " ".join([word() for _ in range(50)] + passage + [word() for _ in range(50)])) for i in range(300)]
    keyed = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.md5(F.col("text").cast("binary")))
    scratch = Scratch(spark, "test-links")
    classes = om.text_classes(keyed, om.SIMILARITY, scratch)
    name = {r["node"]: r["rep"] for r in classes.select("node", "rep").collect()}
    links = [(name[r["a"]], name[r["b"]]) for r in om.find_links(keyed, classes, om.SIMILARITY, scratch).collect()]
    scratch.clear()
    texts = dict(docs)
    assert all(om.similarity(texts[a], texts[b]) >= om.SIMILARITY for a, b in links)
    assert {d for link in links for d in link} == set(range(400))
    assert 399 <= len(links) <= 600
    rows = {r["doc_id"]: r["class_id"] for r in om.near_duplicates(keyed.select("doc_id", "text")).collect()}
    assert all(rows[d] == (0 if d < 400 else d) for d in rows)
