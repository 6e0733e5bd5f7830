"""Alignment against plain loops over tokens, and the tokenizers on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wardline.llm import token_alignment as ta
from wardline.llm.common import read
from wardline.llm.queries import op11_align_tokens

TEXTS = [
    None, "", " ", "  two  spaces ", "It's a <|endoftext|> and <s>plain</s> <unk> <0x41> text.", "literal ▁ sign", "tab\tand\r\nlines\n\n end\n", "naïve café — “quotes” 😀 漢字 и ещё",
    "\x00\x1f\x85\xa0 odd", "ǅ ² ½ ª º µ ·  ­", "e\u0301 combining", "a" * 3000, "word " * 4000, "same text", "same text", "١٢٣ ⅷ 一二", "'s't're'S",
]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(ta.MODEL_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=ta.MODEL_B)


def plain_tokens(models, text):
    """Ids and byte texts of both sides, straight from the tokenizers on the whole text."""
    a, b = models
    if not text:
        return None
    bytes_a = ta._aligner(ta.MODEL_A, ta.MODEL_B).a.model.texts
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a = [bytes_a[i] for i in ids_a]
    parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    return (ids_a, parts_a, ids_b, parts_b) if b"".join(parts_a) == whole == b"".join(parts_b) else None


def plain(models, texts):
    """The report's columns without doc_id, by loops."""
    found = []
    for text in texts:
        tokens = plain_tokens(models, text)
        if tokens is None:
            found.append(None)
            continue
        ids_a, parts_a, ids_b, parts_b = tokens
        spans = []
        for parts in (parts_a, parts_b):
            at, own = 0, []
            for p in parts:
                own.append((at, at + len(p)))
                at += len(p)
            spans.append(own)
        linked, j = Counter(), 0
        for i, (s, e) in zip(ids_a, spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                linked[i, ids_b[k]] += 1
                k += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, at = [], [0, 0]
        for cut in cuts:
            sides = []
            for side, ids in enumerate((ids_a, ids_b)):
                begin = at[side]
                while at[side] < len(ids) and spans[side][at[side]][1] <= cut:
                    at[side] += 1
                sides.append(",".join(map(str, ids[begin : at[side]])))
            groups.append("|".join(sides))
        found.append((len(ids_a), len(ids_b), len(cuts), linked, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count, top = Counter(p for f in found if f for p in f[3]), defaultdict(int)
    for (a, _), c in count.items():
        top[a] = max(top[a], c)
    for f in found:
        if f is None:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            n_a, n_b, n_groups, linked, sha = f
            yield n_a, n_b, n_groups, linked.total(), sum(n for p, n in linked.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in linked.items()), sha


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def check(models, frame, texts_by_id):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in frame.collect()}
    ids = list(texts_by_id)
    assert got == dict(zip(ids, plain(models, [texts_by_id[i] for i in ids])))


@pytest.mark.parametrize("chunk, segment", [(ta.CHUNK, ta.SEGMENT), (200, 1000)])
def test_report_is_the_plain_reading(spark, models, chunk, segment):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(3)
    check(models, ta.alignment_report(docs, chunk=chunk, segment=segment), dict(enumerate(TEXTS)))


def test_query_is_the_plain_reading(spark, models):
    rows = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    check(models, op11_align_tokens(spark, "/root/testdata/sf0.01"), {r.doc_id: r.text for r in rows})


def test_units_are_encoded_as_whole_texts(models):
    dice = random.Random(11)
    signs = "abcÄéñß ʼ'.,-—0129²\n\t\r\x0b\x85\xa0\u2003▁漢😀ſtheing  "
    aligner = ta.Aligner()
    for _ in range(2000):
        text = " " + "".join(dice.choice(signs) for _ in range(dice.randint(1, 40)))
        ids, n, exact = aligner.a.encode([text])
        assert ids.tolist() == models[0].encode(text, add_special_tokens=False).ids and exact.all()
        ids, n, exact = aligner.b.encode([text])
        assert ids.tolist() == models[1].encode(text[1:]) or "▁" in text


def test_forgetting_units_changes_nothing(monkeypatch):
    texts = [t for t in TEXTS if t]
    want = [x.tolist() for x in ta.Aligner().a.encode(texts)]
    monkeypatch.setattr(ta, "MAX_UNITS", 3)
    aligner = ta.Aligner()
    for _ in range(2):
        assert [x.tolist() for x in aligner.a.encode(texts)] == want


def test_common_units_stay_when_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(ta, "MAX_UNITS", 40)
    encoder, asked = ta.Aligner().b, Counter()
    encode = encoder.model.encode
    monkeypatch.setattr(encoder.model, "encode", lambda units: asked.update(units) or encode(units))
    for k in range(20):
        encoder.encode([" often again often again " + " ".join(f"u{k}x{i}" for i in range(10))])
        assert len(encoder.number) <= 40 + 13
    assert asked[" often"] == asked[" again"] == 1 and asked[" u0x0"] == 1


def test_units_that_do_not_come_back_whole():
    """Known by unit: a text with U+2581 beside exact ones, in one call and of more than one byte a character."""
    texts = [" é plain", " ▁ é", " plain", " x▁"]
    for encoder in (ta.Aligner().a, ta.Aligner().b):
        ids, n, exact = encoder.encode(texts)
        alone = [encoder.encode([t]) for t in texts]
        assert ids.tolist() == [i for one in alone for i in one[0].tolist()]
        assert exact.tolist() == [one[2].item() for one in alone]
    assert exact.tolist() == [True, False, True, False]


def test_intervals_with_gaps():
    a = np.array([[0, 2], [2, 5], [7, 9], [9, 12]])
    b = np.array([[0, 1], [1, 6], [8, 9], [11, 14]])
    groups = ta.coalesce(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
    assert [g.tolist() for g in groups] == [[0, 0, 1, 2], [0, 0, 1, 2]]
    left, right = ta.links(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
    assert list(zip(left.tolist(), right.tolist())) == [(i, j) for i, (s, e) in enumerate(a) for j, (t, f) in enumerate(b) if s < f and t < e]


def test_null_ids_repeated_rows_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b"), (7, "a b"), (7, "a b"), (2**60 + 1, "c")], "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.n_a, r.count_sum) for r in ta.alignment_report(docs).collect())
    assert [r[0] for r in rows] == [str(2**60 + 1), "7", "7", "None"] and rows[1] == rows[2] and rows[1][2] == 6
    assert ta.alignment_report(docs.limit(0)).collect() == []
    assert ta.alignment_report(docs.selectExpr("doc_id", "text", "1 AS segment", "2 AS pair", "3 AS count")).count() == 4
