"""Url verdicts against a plain reading of the rules, colliding keys, and the two ways of probing."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardline.llm import url_filter as uf
from wardline.llm.queries import op12_url_verdicts

SF = "/root/testdata/sf0.01"
URLS = [
    None, "", "no scheme", "://", "http://", "http://a.com", "http://A.COM/", "https://example.com/en/1?x#y", "http://www.example.com/en/", "http://m.www.Example.com/en/a",
    "http://notexample.com/en/", "http://x.net/es/", "http://x.net/es", "http://net/fr/?q", "ftp://casino-win.example.org/", "http://a.com/casino/", "http://casino.com/",
    "http://u:p@b.com:80/x://y/z", "http://É.com/Ä#", "http://a\nb.com/x\ny?z", "x http://first.com/a http://second.net/es/", "http://" + "a." * 5000 + "net/es/" + "z" * 50_000, "http://..com//",
]


def plain(url, rules=uf.RULES, words=uf.BLOCKED_WORDS):
    head, found, rest = (url or "").partition("://")
    host = re.split("[/?#]", rest, maxsplit=1)[0] if found else ""
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0] if found else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    word = next((w for w in re.split("[-._]", host) if w in words), None)
    if fits:
        return host, path, max(fits)[2], max(fits)[3], word
    return host, path, None, "block" if word else "allow", word


def results(frame):
    return sorted(tuple(r) for r in frame.select("page_id", "host", "path", F.coalesce("rule", F.lit("-")), "verdict", F.coalesce("blocked_word", F.lit("-"))).collect())


@pytest.mark.parametrize("bound", [uf.MAX_INDEX_BYTES, 0])
def test_urls_are_judged_as_the_rules_read(spark, bound):
    pages = spark.createDataFrame(list(enumerate(URLS)) * 2, "page_id long, url string")
    got = results(uf.judge_urls(pages, uf.rules_table(spark), max_index_bytes=bound).drop("url"))
    want = sorted((i, h, p, r or "-", v, w or "-") for i, u in list(enumerate(URLS)) * 2 for h, p, r, v, w in [plain(u)])
    assert got == want


@pytest.mark.parametrize("bound", [uf.MAX_INDEX_BYTES, 0])
def test_many_rules(spark, bound):
    dice = np.random.default_rng(12)
    host = lambda n: ".".join("abc"[i] for i in dice.integers(0, 3, n))
    rules = list({(host(dice.integers(1, 4)), "/" + "xy"[dice.integers(0, 2)] * int(dice.integers(0, 4)), "block"): None for _ in range(60)})
    rules = [(h, p, ("block", "allow")[len(h + p) % 2]) for h, p, _ in rules]
    urls = [f"http://{host(dice.integers(1, 6))}/{''.join('xyz'[i] for i in dice.integers(0, 3, 3))}" for _ in range(500)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = results(uf.judge_urls(pages, uf.rules_table(spark, rules), ("b",), max_index_bytes=bound).drop("url"))
    assert got == sorted((i, h, p, r or "-", v, w or "-") for i, u in enumerate(urls) for h, p, r, v, w in [plain(u, rules, ("b",))])


def test_keys_are_those_of_spark(spark):
    texts = ["", "a", "example.com/en/", "é" * 50, "x" * 1000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("k")).collect()
    assert all(xxhash.xxh64_intdigest(r.t.encode(), uf.SEED) == r.k % 2**64 for r in rows)


def test_strings_decide_between_equal_keys(tmp_path, monkeypatch):
    monkeypatch.setattr(uf.xxhash, "xxh64_intdigest", lambda t, seed: len(t) % 2)  # nearly all collide
    texts = sorted((b"aa", b"b", b"cc", b"d", b"ee", b"fff"), key=lambda t: (len(t) % 2, t))
    path = tmp_path / "index"
    parts = (np.array([6], np.uint64), np.array([len(t) % 2 for t in texts], np.uint64), np.cumsum([len(t) for t in texts], dtype=np.uint64), np.zeros(6, np.int32), np.zeros(6, np.uint8))
    path.write_bytes(b"".join(p.tobytes() for p in parts) + b"".join(texts))
    found = uf.DigestArray(str(path)).find([(t, 0) for t in (b"fff", b"aa", b"zz", b"b", b"z", b"cc")])
    assert [texts[i] if i >= 0 else None for i in found] == [b"fff", b"aa", None, b"b", None, b"cc"]


def test_empty_tables_rules_and_clashes(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = uf.rules_table(spark).limit(0)
    assert results(uf.judge_urls(pages, none, ()).drop("url")) == [(1, "a.com", "/", "-", "allow", "-")]
    assert uf.judge_urls(pages.limit(0), uf.rules_table(spark)).count() == 0
    with pytest.raises(ValueError):
        uf.judge_urls(pages.withColumn("Host", F.lit(1)), uf.rules_table(spark))
    assert uf.url_report(pages.withColumn("host", F.lit(1))).count() == 1
    assert uf.keep_allowed(pages, uf.rules_table(spark)).columns == ["page_id", "url"]
    twice = uf.rules_table(spark, [("com", "/", "allow"), ("com", "/", "block")])
    assert results(uf.judge_urls(pages, twice, ()).drop("url"))[0][4] == "block"


def test_query(spark):
    assert {r.verdict for r in op12_url_verdicts(spark, SF).select("verdict").distinct().collect()} == {"allow", "block"}
