"""Mixing to target weights and stratified shards against direct computation."""

import collections
import hashlib
import re
import zlib

from wardline.llm import mixing, sharding

SF = "/root/testdata/sf0.001"
ROWS = [(i, f"w{i} " * (i % 7), ["b", "a", "c", None, "d"][i % 5], i, "x") for i in range(60)] + [(7, None, "a", 1, "x"), (7, None, "a", 1, "x"), (8, "", None, 2, "x"), (None, "one two", "b", 3, "x")]
SCHEMA = "doc_id long, text string, source string, size long, rate string"


def targets(rows):
    """Water-filling by repetition, as the rule reads."""
    size = collections.Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, full, left = {}, set(), 1.5 * sum(size.values())
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * size[s]]
        if not over:
            return size, goal | share
        for s in over:
            goal[s] = 2.0 * size[s]
            left -= goal[s]
            full.add(s)


def check_mix(docs):
    got = mixing.mixing_report(docs).collect()
    size, goal = targets([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - goal[r["source"]]) < 1e-6
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    return got, taken, goal


def test_targets_and_copies(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got, taken, _ = check_mix(docs)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    words = collections.Counter()
    for r in mixed.collect():
        words[r["source"]] += len((r["text"] or "").split())
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}
    again = sorted(map(repr, mixing.mixing_report(docs).collect()))
    assert again == sorted(map(repr, got))


def test_targets_are_met_on_documents(spark):
    _, taken, goal = check_mix(spark.read.parquet(f"{SF}/documents.parquet"))
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 0.1 * goal[s] + 50


def test_empty_mix(spark):
    assert mixing.mixing_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixing.mix_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    blank = spark.createDataFrame([(1, None, None, 1, "x"), (2, "", "a", 1, "x")], SCHEMA)
    assert [r["taken"] for r in mixing.mixing_report(blank).collect()] == [0, 0]


def brute_shards(rows, n_shards=8):
    by_source = collections.defaultdict(list)
    for doc_id, text, source in rows:
        digest = hashlib.md5(f"shard:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
        raw = (text or "").encode()
        by_source[source].append((digest, doc_id is None, doc_id, zlib.crc32(raw), len(raw) + 1))
    order = []
    for source, found in by_source.items():
        for r, x in enumerate(sorted(found)):
            order.append(((2 * r + 1) / (2 * len(found)), source is None, source or "", x))
    order.sort(key=lambda y: (y[0], y[1], y[2], y[3]))
    out = []
    for p, (_, none, source, x) in enumerate(order):
        shard = p * n_shards // len(order)
        out.append((x[2], x[4], x[3], shard, p - (shard * len(order) + n_shards - 1) // n_shards, None if none else source))
    return sorted(map(repr, out))


def test_shards_against_direct_ranking(spark):
    for docs in (spark.createDataFrame(ROWS, SCHEMA), spark.read.parquet(f"{SF}/documents.parquet")):
        rows = sharding.shard_report(docs, 8).collect()
        got = sorted(repr((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"], r["source"])) for r in rows)
        assert got == brute_shards([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
        counts = collections.Counter(r["shard"] for r in rows)
        assert max(counts.values()) - min(counts.values()) <= 1
        for s in counts:
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_every_shard_has_the_mixture(spark):
    rows = sharding.shard_report(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 8).collect()
    whole = collections.Counter(r["source"] for r in rows)
    part = collections.Counter((r["shard"], r["source"]) for r in rows)
    assert all(abs(part[s, src] - whole[src] / 8) <= 1 for s in range(8) for src in whole)


def test_shards_keep_all_columns_and_take_few_rows(spark):
    docs = spark.createDataFrame(ROWS[:3], "doc_id long, text string, source string, dig long, bucket1 string")
    out = sharding.shard_documents(docs, 8)
    assert out.columns == [*docs.columns, "shard", "slot"] and out.count() == 3
    assert sharding.shard_report(docs.limit(0), 8).collect() == []
