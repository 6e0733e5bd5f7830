"""Personal data: base spans against plain patterns, discovered identifiers, edge cases."""

import collections
import hashlib
import math
import re

from pyspark.sql import functions as F

from wardline.llm import pii

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(map(int, reversed(digits))):
        total += c if i % 2 == 0 else c * 2 - 9 * (c > 4)
    return total % 10 == 0


def accepted(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if accepted(kind, m.group())]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans)]


def check(docs):
    rows = pii.pii_report(docs).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert len(rows) == sum(map(len, texts.values()))
    for r in rows:
        expected = [brute(t) for t in texts[r["doc_id"]]]
        counts = [r[f"n_{k}"] for k in PLAIN]
        assert (r["base_sha256"], counts) in [(hashlib.sha256(",".join(x).encode()).hexdigest(), [sum(s.startswith(k + ":") for s in x) for k in PLAIN]) for x in expected]
        assert any(set(x) <= set(r["spans"].split(",")) | {""} for x in expected)
    return rows


def test_base_spans_of_documents(spark):
    rows = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sum(r["n_email"] + r["n_phone"] for r in rows) > 0


def test_odd_texts(spark):
    odd = [
        None, "", "a@b.c_d@e.fg x@y..z a@b.c.@d.e", "😀 +1 (988) 555-2485 é a.b@c.de 1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.4",
        "4539 1488 0343 6467 4111-1111-1111-1111 12", "+1" + " " * 3000 + "2", "+12345678901 +1+1+12 3", "1" * 19 + ".1.1.1.1 " + "1." * 5000, "a@" * 5000,
        "x" * 60_000 + " " + "9" * 5000 + " a@" + "b." * 9000 + "c",
    ]
    rows = [(i, t, "x") for i, t in enumerate(odd)] + [(3, odd[3], "y"), (None, odd[3], "z")]
    check(spark.createDataFrame(rows, "doc_id long, text string, base string"))


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"word{chr(97 + i % 26)} contact mail: u{i}@x.org and also call me at +1 555 123 {4000 + i} thanks") for i in range(20)]
    rows += [(100, "please contact mail: john.doe77@localhost soon"), (101, "call me at 555-1234567 now"), (102, "again john.doe77@localhost"), (103, "clean code 1234567 here")]
    got = {r["doc_id"]: r["spans"] for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got[100] == "context:21:41" and got[101] == "context:11:22"
    assert got[102] == "context:6:26"  # the same identifier in a new context
    assert got[103] == ""  # identifier-like, but no pattern leads to it


def graph(rows):
    """Accepted strings by the rule, in plain Python: (text, whether it is a seed, its patterns) and all texts."""
    texts, found = rows
    links = collections.Counter()
    seeds = set()
    for v, seed, patterns in found:
        seeds |= {v} if seed else set()
        for p in patterns:
            links[p, v] += 1
    occurs = collections.Counter()
    for t in texts:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+|(?<=[=:])", t.lower()) if w]
        occurs.update((w,) for w in words)
        occurs.update(zip(words, words[1:]))
    by_pattern, by_string = collections.defaultdict(dict), collections.defaultdict(set)
    for (p, v), n in links.items():
        by_pattern[p][v] = n
        by_string[v].add(p)
    score = {v: float(v in seeds) for v in by_string}
    while True:
        conf = {p: sum(n * score[v] for v, n in vs.items()) / max(occurs[p], sum(vs.values())) for p, vs in by_pattern.items() if sum(score[v] >= pii.ACCEPT for v in vs) >= pii.MIN_SEEDS}
        new = {v: 1.0 if v in seeds else 1 - math.prod(1 - min(conf[p], 1 - 1e-9) for p in ps if p in conf) for v, ps in by_string.items()}
        rise = max(new[v] - score[v] for v in new)
        score = new
        if rise <= pii.SETTLED:
            return {v for v in score if v not in seeds and score[v] >= pii.ACCEPT}


CHAIN = (
    [f"filler{i % 7} mail: u{i}@x.org end" for i in range(6)]  # seeds induce "mail:"
    + [f"write mail: name{i}77x@local now" for i in range(4)]  # found by it
    + [f"login name{i}77x@local here" for i in range(4)]  # which induces "login"
    + [f"login other{i}9{i}9x@box here" for i in range(3)]  # found by that
    + [f"badge other{i}9{i}9x@box" for i in range(3)]  # which induces "badge"
    + ["badge 7778889 there", "ticket 1234567 there", "mail: soon"]
)


def test_discovered_identifiers_induce_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(CHAIN)), "doc_id long, text string")
    words = [re.findall(r"[^ :]+:?", t) for t in CHAIN]
    like = re.compile(r"[^@]@[^@]|\d.*\d.*\d")
    found = []
    for ws in words:
        for i, w in enumerate(ws):
            if like.search(w) and len(w) >= 6:
                found.append((w, re.fullmatch(PLAIN["email"], w) is not None, [(ws[i - 1].lower(),)] * (i > 0) + [(ws[i - 2].lower(), ws[i - 1].lower())] * (i > 1)))
    expected = graph((CHAIN, found))
    assert "7778889" in expected and "other0909x@box" in expected and "1234567" not in expected
    got = {r["v"] for r in pii.score_graph(docs, pii.instances(docs)).collect()}
    assert got == expected


def test_words_far_in_front_are_read(spark):
    far = "x" * 300
    rows = [(0, f"one two{' ' * 200}a@b.org"), (1, f"one {far} c@d.org"), (2, f"e@f.org{far} two g@h.org"), (3, f"{far} {far} {far} i@j.org"), (4, f"k@l.org {far}{' ' * 130}m@n.org")]
    found = pii.instances(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["v"]: r["patterns"] for r in found.collect()}
    want = {"a@b.org": ["two", "one two"], "c@d.org": [far, f"one {far}"], "g@h.org": ["two"], "i@j.org": [far, f"{far} {far}"], "m@n.org": [far]}
    for v, phrases in want.items():
        words = [p.split() for p in phrases]
        keys = spark.range(1).select(*[pii._pattern(len(w), *[F.lit(x) for x in w]) for w in words]).first()
        assert got[v] == list(keys), v


def test_patterns_counted_by_shuffle_as_by_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([("a a b a",), ("a b",), (None,), ("",)], "text string")
    patterns = spark.range(1).select(F.explode(F.array(pii._pattern(1, F.lit("a")), pii._pattern(2, F.lit("a"), F.lit("b")))).alias("p"))
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    one = sorted(map(tuple, pii.pattern_occurrences(docs, patterns).collect()))
    monkeypatch.setattr(pii, "BROADCAST_PATTERNS", 0)
    assert sorted(map(tuple, pii.pattern_occurrences(docs, patterns).collect())) == one
    assert sorted(n for _, n in one) == [2, 4]


def test_empty_table(spark):
    assert pii.pii_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
