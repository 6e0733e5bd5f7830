"""Repeated runs of lines against a search over all windows."""

import random
import re

from wardline.llm import line_dedup

SF = "/root/testdata/sf0.001"


def brute(docs, least):
    """Delete every line in a window of ``least`` words that begins earlier elsewhere."""
    docs = sorted(((d, t) for d, t in docs if t is not None), key=lambda x: (x[0] is not None, x[0]))
    lines = [re.split(r"\n(?=[ \t\x0b\f\r]*[^ \t\x0b\f\r\n])", t) for _, t in docs]
    keys = [[x.strip(" \t\n\r\x0b\f") for x in ls] for ls in lines]

    def windows(k):
        for p in range(len(k)):
            words = 0
            for e in range(p, len(k)):
                if not k[e]:
                    break
                words += len(re.findall(r"[^\x20\x09-\x0D]+", k[e]))
                if words >= least:
                    yield p, e + 1

    first = {}
    for n, k in enumerate(keys):
        for p, e in windows(k):
            first.setdefault(tuple(k[p:e]), (n, p))
    out = {}
    for n, ((d, _), ls, k) in enumerate(zip(docs, lines, keys)):
        gone = {i for p, e in windows(k) if first[tuple(k[p:e])] < (n, p) for i in range(p, e)}
        out[d] = "\n".join(x for i, x in enumerate(ls) if i not in gone)
    return out


def check(spark, docs, least):
    expected = brute(docs, least)
    rows = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), least).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["text"] == expected.get(r["doc_id"])
    return expected


def test_random_lines(spark):
    rnd = random.Random(3)
    lines = ["a b", "c d e", "f", "g h i j", "k l m n o p q r", "", "  ", "s\r"]
    docs = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 25)))) for i in range(40)]
    docs += [(100, None), (101, ""), (None, "x y z\nq r s"), (102, "\n\n x y z\n\n\nq r s\n")]
    assert check(spark, docs, 6) != check(spark, docs, 12)


def test_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r["text"]) < 20_000]
    expected = check(spark, docs, 50)
    assert any(expected[d] != t for d, t in docs)


def test_planted_passage_and_columns(spark):
    passage = "\n".join(" ".join(f"p{i}x{j}" for j in range(20)) for i in range(3))
    docs = [(5, f"own five\n{passage}\nend five", 1), (3, f"own three\n{passage}\nend three", 2), (9, passage, 3), (9, passage, 3), (4, "short line\nend", 4), (6, "short line\nend", 5)]
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string, Runs int"))
    assert out.columns == ["doc_id", "text", "Runs"]
    got = sorted((r["doc_id"], r["text"]) for r in out.collect())
    assert got == [(3, docs[1][1]), (4, docs[4][1]), (5, "own five\nend five"), (6, docs[5][1]), (9, ""), (9, "")]
    report = {r["doc_id"]: r for r in line_dedup.line_report(spark.createDataFrame(docs, "doc_id long, text string, Runs int")).collect()}
    assert (report[5]["runs"], report[5]["n_removed"], report[5]["copied_from"]) == ("1-4", 3, "3")


def test_long_text_and_empty_table(spark):
    long = "\n".join(f"line {i} with some words of its own" for i in range(3000))
    rows = line_dedup.dedup_lines(spark.createDataFrame([(1, long), (2, "head\n" + long)], "doc_id long, text string")).collect()
    assert {r["doc_id"]: len(r["text"]) for r in rows} == {1: len(long), 2: len("head")}
    assert line_dedup.line_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
