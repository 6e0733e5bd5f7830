"""Repair of conversations against a search over all edits and a plain reading of the damage."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from wardline.llm import conversation_repair as cr
from wardline.llm.common import read
from wardline.llm.queries import op13_repair_conversations

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Least (cost, edits) by search over (rows done, roles left): rows are (initial, must go, truncated)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, done, last = heapq.heappop(heap)
        if (done, last) in seen:
            continue
        seen.add((done, last))
        if done == len(rows) and last in ("", "a"):
            return cost, edits
        due = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, edits + "I", done, due))
        if done < len(rows):
            initial, gone, truncated = rows[done]
            heapq.heappush(heap, (cost + 2, edits + "D", done + 1, last))
            if not gone:
                extra = 5 * truncated
                if initial == due or initial == "s" and last == "":
                    heapq.heappush(heap, (cost + extra, edits + "K", done + 1, initial))
                heapq.heappush(heap, (cost + extra + 1, edits + "R", done + 1, due))
    raise AssertionError


ROWS = [(i, False, t) for i in "suax" for t in (False, True)] + [("u", True, False)]


def test_block_tables_find_the_cheapest_edits():
    cases = [c for n in range(4) for c in itertools.product(ROWS, repeat=n)]
    dice = random.Random(13)
    cases += [tuple(dice.choice(ROWS) for _ in range(dice.randint(4, 14))) for _ in range(3000)]
    cases += [tuple((dice.choice("ua"), False, dice.random() < 0.2) for _ in range(dice.randint(4, 30))) for _ in range(1000)]
    for block in (1, 3, cr.BLOCK):
        tables = cr.tables(block)
        for case in cases if block == cr.BLOCK else cases[::7]:
            symbols = bytes(cr.symbol(i, g, False, t) for i, g, t in case)
            assert tables.repair(symbols) == cheapest(case), case


def test_vectors_are_few():
    assert len(cr.tables().vectors) < 100


def damage(rows):
    """The damage, row by row."""
    text_of = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = text_of(role), text_of(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, "user" if kind == 4 else role, text


def judged(rows):
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of original rows."""
    white = " \t\n\x0b\x0c\r"
    left = {}
    for conv, turn, role, text in damage(rows):
        left.setdefault(conv, []).append((turn, role, text))
    for conv in dict.fromkeys(r[0] for r in rows):
        own = sorted(left.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(white)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)])
        out, at, last = [], 0, ""
        for e in audit:
            due = "assistant" if last == "u" else "user"
            if e == "I":
                out.append(due + ":")
            elif e != "D":
                out.append((own[at][1] if e == "K" else due) + ":" + own[at][2])
            if e != "D":
                last = own[at][1][:1] if e == "K" else due[0]
            at += e != "I"
        sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
        yield conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha


NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def key(row):
    return str(row[0])


def check(spark, rows):
    frame = spark.createDataFrame(rows, TURNS).repartition(3)
    got = sorted((tuple(r[n] for n in NAMES) for r in cr.repair_report(frame).collect()), key=key)
    assert got == sorted(judged(rows), key=key)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_is_the_plain_reading(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r[n] for n in NAMES) for r in op13_repair_conversations(spark, folder).collect()), key=key)
    assert got == sorted(judged(rows), key=key)


def test_hand_made_cases(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", "Same words.") for t in range(40)]  # repeats over many turns
    rows += [(2, 5, "user", "Hi.")] * 7 + [(2, 5, "assistant", "Yes.")] * 3  # repeated rows, ties of one turn
    rows += [(3, None, None, None), (3, 1, "", "x"), (3, 2, "tool", "y."), (None, 1, "user", "Hello."), (None, None, "assistant", "A.")]
    rows += [(4, 0, "system", "S."), (4, 100, "user", "long " * 100_000 + "."), (4, 101, "assistant", "é ü.\n\t ")]
    rows += [(n, 0, "user", "One.") for n in range(10, 60)]  # some lose their only row
    check(spark, rows)


def test_one_conversation_with_a_third_of_all_rows(spark):
    dice = random.Random(5)
    text = lambda: dice.choice(["Yes.", "No", "Well, then.", f"Number {dice.random()}."])
    rows = [(0, t, dice.choice(["user", "assistant"]), text()) for t in range(2000)]
    rows += [(1 + t // 8, t % 8, ("user", "assistant")[t % 2], text()) for t in range(4000)]
    check(spark, rows)


def test_empty_table_and_other_columns(spark):
    assert cr.repair_report(spark.createDataFrame([], TURNS)).collect() == []
    wide = spark.createDataFrame([(1, 1, "user", "Hi.", "a", 1, "d", "f")], TURNS + ", digest string, copies long, kind string, found string")
    assert cr.repair_report(wide).count() == 1


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be."), (1, 1, "assistant", "Q?"), (1, 2, "assistant", "A."), (1, 3, "user", "cut"), (2, 0, "user", " ")]
    out = cr.repair_conversations(spark.createDataFrame(rows, TURNS)).orderBy("conv_id", "turn").collect()
    assert [tuple(r) for r in out] == [(1, 0, "system", "Be."), (1, 1, "user", "Q?"), (1, 2, "assistant", "A.")]
