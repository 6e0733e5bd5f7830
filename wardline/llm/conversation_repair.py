"""Conversation structure repair with Four-Russians block tables.

The cheapest edits that bring a conversation's roles into the form ``(s?(ua)+)?`` (an
optional system turn, then user and assistant in turn) are a shortest path through four
states: nothing yet, behind a system turn, behind a user turn, behind an assistant turn. A row
is kept (K, 0), given the role that is due (R, 1) or deleted (D, 2); an empty turn of the role
that is due may be inserted anywhere (I, 5). Blank rows and duplicates must be deleted;
truncated rows that stay cost 5 more. Of the cheapest, the edits whose initials come first in
ASCII order are taken.

A row is one of ten symbols. The costs from a place to the end are a vector over the states;
less its smallest entry it is one of few, which are numbered. For every block of ``BLOCK``
symbols and every vector behind it, a table holds the vector before it and the cost that was
taken off. A conversation is worked through from its end by one lookup per block, keeping the
number of the vector at each border. Tracing goes forwards: a block is expanded backwards
from the vector at its right border, which gives the costs to the end at every place
inside, and at each place the least initial that loses nothing is taken. As that depends on
(state, block, vector) only, expanded blocks are remembered.

Spark prepares the rows. Equal rows of a turn are counted, not listed; a row is a duplicate if
its role and text occurred at an earlier turn, found from the least turn per (conversation,
role, digest of the text). One symbol per row is then read in order of the conversation, in a
stream. For the digest of the repaired text the rows' texts follow in the same order in a second
stream, behind a row with the edits: a task holds the edits of one conversation, never its texts.

Cases: null roles and texts count as one space, so does a null conversation or turn in the key
that chooses the damage; null conversations form one of their own; turns sort nulls first,
rows of one turn by role, then by the text's digest; roles that do not begin with s, u or a
can't be kept, nor can empty ones; texts of any length are only digested and streamed; a conversation
without rows has zeros, no edits and the digest of the empty text; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardline.llm.common import tidy

BLOCK = 4
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_FAR = 10**6
#: the state behind the role that is due in each state, and that role
_DUE = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: symbols: initial s, u, a or other, whole or truncated; a row to delete; no row
_INITIALS = "sua"
_GONE, _NONE = 8, 9
SYMBOLS = 10


def symbol(initial: str, blank: bool, duplicate: bool, truncated: bool) -> int:
    """The symbol of a row."""
    if blank or duplicate:
        return _GONE
    place = _INITIALS.find(initial) if initial else -1
    return (place if place >= 0 else 3) * 2 + bool(truncated)


def _keep(state: int, sym: int) -> int | None:
    """The state behind a kept row, if it may stand there."""
    initial = sym // 2
    if initial == 0:
        return _SYSTEM if state == _START else None
    due = _DUE[state]
    return due if sym < _GONE and initial == (1 if due == _USER else 2) else None


def _choices(state: int, sym: int) -> list[tuple[str, int, int]]:
    """(initial of the edit, cost, next state) of a row's edits in ASCII order."""
    out = [("D", DELETE, state)]
    if sym < _GONE:
        extra = TRUNCATED * (sym % 2)
        kept = _keep(state, sym)
        if kept is not None:
            out.append(("K", extra, kept))
        out.append(("R", REROLE + extra, _DUE[state]))
    return out


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    u, a = min(costs[_USER], INSERT + costs[_ASSISTANT]), min(costs[_ASSISTANT], INSERT + costs[_USER])
    return min(costs[_START], INSERT + u), min(costs[_SYSTEM], INSERT + u), u, a


END = _with_inserts([0, _FAR, _FAR, 0])


def before(costs: tuple[int, ...], sym: int) -> tuple[int, ...]:
    """Costs to the end in front of a row, from those behind it."""
    if sym == _NONE:
        return costs
    return _with_inserts([min(cost + costs[to] for _, cost, to in _choices(state, sym)) for state in range(4)])


def _normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least for c in costs), least


class BlockTables:
    """All normalised vectors, and the transition of every block of symbols for each of them."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        start, self.end_cost = _normal(END)
        self.vectors = [start]
        number = {start: 0}
        one: list[list[tuple[int, int]]] = []  # per vector and symbol: the vector in front, cost taken off
        at = 0
        while at < len(self.vectors):  # vectors are few: differences are bounded by the inserts
            row = []
            for sym in range(SYMBOLS):
                vector, least = _normal(before(self.vectors[at], sym))
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                row.append((number[vector], least))
            one.append(row)
            at += 1
        self.step = one
        to = np.array([[t for t, _ in row] for row in one])
        off = np.array([[c for _, c in row] for row in one])
        n = len(self.vectors)
        next_, cost = np.arange(n)[:, None], np.zeros((n, 1), np.int64)
        for _ in range(block):  # block numbers: the first symbol is the highest digit, worked off last
            width = next_.shape[1]
            front = np.arange(SYMBOLS)
            cost = (cost[:, None, :] + off[next_[:, None, :], front[None, :, None]]).reshape(n, SYMBOLS * width)
            next_ = to[next_[:, None, :], front[None, :, None]].reshape(n, SYMBOLS * width)
        self.next, self.cost = next_.tolist(), cost.tolist()
        self.traced: dict[tuple[int, int, int], tuple[str, int]] = {}

    def blocks(self, symbols: bytes) -> list[int]:
        """A conversation's symbols as block numbers; the last block is filled up with no rows."""
        padded = np.frombuffer(symbols + bytes([_NONE]) * (-len(symbols) % self.block), np.uint8).reshape(-1, self.block)
        return (padded @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))).tolist()

    def _expand(self, state: int, block: int, behind: int) -> tuple[str, int]:
        """The least edits of a block and the state they lead to."""
        digits = [block // SYMBOLS**p % SYMBOLS for p in range(self.block - 1, -1, -1)]
        costs = [self.vectors[behind]]
        for sym in reversed(digits):
            costs.append(before(costs[-1], sym))
        costs.reverse()  # absolute, relative to the right border
        edits = ""
        for i, sym in enumerate(digits):
            while True:
                here = costs[i][state]
                if sym == _NONE:
                    break
                options = [(e, cost + costs[i + 1][to], to) for e, cost, to in _choices(state, sym)]
                options.append(("I", INSERT + costs[i][_DUE[state]], _DUE[state]))
                edit, _, state = min(o for o in options if o[1] == here)
                edits += edit
                if edit != "I":
                    break
        return edits, state

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """(cost, initials of the cheapest edits) of a conversation."""
        blocks = self.blocks(symbols)
        vector, total, borders = 0, self.end_cost, [0]
        for block in reversed(blocks):
            total += self.cost[vector][block]
            vector = self.next[vector][block]
            borders.append(vector)
        borders.reverse()
        total += self.vectors[vector][_START]
        state, edits = _START, []
        for block, behind in zip(blocks, itertools.islice(borders, 1, None)):
            key = (state, block, behind)
            if key not in self.traced:
                self.traced[key] = self._expand(*key)
            part, state = self.traced[key]
            edits.append(part)
        while END[state]:  # behind the last row only inserts are left
            state = _DUE[state]
            edits.append("I")
        return total, "".join(edits)


_TABLES: dict[int, BlockTables] = {}


def tables(block: int = BLOCK) -> BlockTables:
    if block not in _TABLES:
        _TABLES[block] = BlockTables(block)
    return _TABLES[block]


# ---------------------------------------------------------------- rows


def prepared(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text, copies of any table of turns; nulls as one space."""
    return rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: conv_id, turn, role, text, copies (0: dropped, 2: repeated)."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = prepared(conversations, F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.withColumns({"text": text, "role": F.when(kind == 4, "user").otherwise(F.col("role"))})


def _counted(rows: DataFrame) -> DataFrame:
    """Different rows of a turn with their number and faults; a conversation without rows keeps one of number 0."""
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    there = F.col("copies") > 0
    facts = rows.select(
        "conv_id",
        F.when(there, turn).alias("at"),
        F.when(there, F.col("role")).alias("role"),
        F.when(there, F.md5(F.col("text").cast("binary"))).alias("digest"),
        F.when(there, blank).alias("blank"),
        F.when(there, truncated).alias("truncated"),
        "copies",
    )
    counted = facts.groupBy("conv_id", "at", "role", "digest").agg(F.sum("copies").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    same = ["conv_id", "role", "digest"]
    repeated = counted.where(F.col("n") > 0).groupBy(*same).agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("turns")).where(F.col("turns") > 1)
    repeated = repeated.select(*(F.col(c).alias("_" + c) for c in same), "first_at")
    on = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    joined = counted.join(repeated, on, "left")
    later = F.coalesce(F.col("at") > F.col("first_at"), F.lit(False))
    return joined.select("conv_id", "at", "role", "digest", "n", "blank", later.alias("later"), "truncated")


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation of ``prepared`` rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    ordered = _counted(rows).repartition("conv_id").sortWithinPartitions("conv_id", F.col("at").asc_nulls_first(), "role", "digest")
    narrow = ordered.select("conv_id", F.col("at.turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"), "n", F.coalesce("blank", F.lit(False)).alias("blank"), "later", F.coalesce("truncated", F.lit(False)).alias("truncated"))
    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string(AUDIT).fields])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        arrow = to_arrow_schema(schema)
        names = arrow.names
        conv, state, done = None, None, []

        def closed():
            cost, audit = tables(block).repair(bytes(state["symbols"]))
            span = 0 if state["least"] is None else state["most"] - state["least"] + 1 - state["turns"]
            return (conv, span, state["blank"], state["duplicate"], state["truncated"], state["illegal"], cost, audit)

        for batch in batches:
            for this, turn, initial, n, blank, later, truncated in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or this != conv:
                    if state is not None:
                        done.append(closed())
                    conv = this
                    state = {"symbols": bytearray(), "least": None, "most": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "last": None}
                if not n:
                    continue
                if turn is not None and turn != state["most"]:
                    state["least"] = turn if state["least"] is None else state["least"]
                    state["most"], state["turns"] = turn, state["turns"] + 1
                if state["last"] is not None:
                    state["illegal"] += state["last"] + initial not in ("su", "ua", "au")
                state["illegal"] += n - 1  # equal rows side by side
                state["last"] = initial
                if blank:
                    state["blank"] += n
                else:
                    state["duplicate"] += n - 1 + later
                    state["truncated"] += truncated and not later
                state["symbols"].append(symbol(initial, blank, later, truncated))
                state["symbols"].extend(bytes([_GONE]) * (n - 1))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), arrow.types)], names=names)
                done = []
        if state is not None:
            done.append(closed())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), arrow.types)], names=names)

    return narrow.mapInArrow(tidy(run), schema)


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation's edits, then its rows in the order of the edits."""
    head = found.select("conv_id", F.lit(0).alias("kind"), F.struct(*[f.name for f in T._parse_datatype_string(AUDIT).fields]).alias("found"))
    body = rows.where(F.col("copies") > 0).withColumns({"kind": F.lit(1), "digest": F.md5(F.col("text").cast("binary"))})
    both = head.unionByName(body, allowMissingColumns=True).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest")
    return both.select("conv_id", "kind", "role", "text", "copies", "found")


class _Turns:
    """Follows the state through the edits of one conversation."""

    def __init__(self, audit: str):
        self.edits, self.state = iter(audit), _START

    def _due(self) -> str:
        self.state = _DUE[self.state]
        return _ROLE[self.state]

    def row(self, role: str, text: str) -> list[tuple[str, str]]:
        out = []
        for edit in self.edits:
            if edit == "D":
                return out
            if edit == "K":
                self.state = _SYSTEM if role[:1] == "s" else _DUE[self.state]
                return [*out, (role, text)]
            out.append((self._due(), text if edit == "R" else ""))
            if edit == "R":
                return out
        return out

    def rest(self) -> list[tuple[str, str]]:
        return [(self._due(), "") for _ in self.edits]


def repair_conversations(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired turns: conv_id, turn (number from 0), role, text. Conversations that lose all rows are gone."""
    return _repaired(prepared(conversations), block, texts=True)


def repair_report(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Damaged conversations and their repair, as digests; a row per original conversation."""
    return _repaired(damaged(conversations), block, texts=False)


def _repaired(rows: DataFrame, block: int, texts: bool) -> DataFrame:
    ordered = _in_order(rows, audits(rows, block))
    own = [rows.schema["conv_id"]]
    if texts:
        schema = T.StructType([*own, *T._parse_datatype_string("turn long, role string, text string").fields])
    else:
        schema = T.StructType([*own, *T._parse_datatype_string(AUDIT + ", repaired_sha256 string").fields])
    names = [f.name for f in T._parse_datatype_string(AUDIT).fields]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        arrow = to_arrow_schema(schema)
        conv, found, turns, sha, number, done = None, None, None, None, 0, []

        def add(made):
            nonlocal number
            for role, text in made:
                if texts:
                    done.append((conv, number, role, text))
                else:
                    sha.update((("\n" if number else "") + role + ":" + text).encode())
                number += 1

        def close():
            if turns is not None:
                add(turns.rest())
                if not texts:
                    done.append((conv, *(found[n] for n in names), sha.hexdigest()))

        for batch in batches:
            for this, kind, role, text, copies, head in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    close()
                    conv, found, turns, sha, number = this, head, _Turns(head["audit"]), hashlib.sha256(), 0
                    continue
                for _ in range(copies):
                    add(turns.row(role, text))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), arrow.types)], names=arrow.names)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), arrow.types)], names=arrow.names)

    return ordered.mapInArrow(tidy(run), schema)
