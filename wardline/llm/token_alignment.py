"""Cross-tokenizer alignment by interval coalescing.

A text is encoded by tokenizer A (byte-level BPE, on space+text) and tokenizer B
(SentencePiece, which adds the space itself). Every token is an interval of the bytes of
space+text. All intervals of both sides are sorted by their starts (lexsort), the running
maximum of their ends is taken (maximum.accumulate), and a group begins where a start has
reached that maximum: there A and B tokens both end. Within a group the overlapping (A, B)
pairs, the links, are expanded from the places of A's borders among B's. A whole chunk of
texts is laid end to end and coalesced at once.

Tokens of both sides come from the tokenizers themselves, once per different unit: a unit is
what A's own splitting rule yields (for texts of characters below U+0250, whose classes are
the same everywhere; other texts are one unit), and for B a run that no piece crosses
(checked when the model is read). Units are kept from chunk to chunk; beyond ``MAX_UNITS``
those met most often stay, half as many at most.

Corpus-wide counts: a task cuts its documents into segments of ``SEGMENT`` characters and
writes, per document, its different (A id, B id) pairs with their times, and per segment how
many of its documents hold each pair. Segment rows are summed by pair, each A id's highest
count is taken, and the sums go back to the segments, which fill in their documents. Rows
that are shuffled are thus pairs of a segment, not links, and no count is held whole anywhere.

Cases: null and empty texts, and texts whose joined bytes on either side differ from
space+text (U+2581 in a text), have no tokens: zeros and ''. Special tokens' strings in a text
are plain text. Texts of any length are handled (a long one is a segment of its own); equal
texts get equal results; rows with one doc_id stay apart and count as documents of their own;
null ids stay null; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import tidy, written

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
#: characters that are aligned in one go, and that one segment's counts cover
CHUNK, SEGMENT = 2_000_000, 32_000_000
#: units that a worker remembers (memory only: the results are the same)
MAX_UNITS = 300_000
SPACE = "▁"

_TOP = 0x250


def _of_class(kind: str) -> str:
    return "".join(f"\\u{c:04x}" for c in range(_TOP) if unicodedata.category(chr(c)).startswith(kind))


_L, _N, _S = _of_class("L"), _of_class("N"), r"\t\n\x0b\x0c\r \x85\xa0"
#: A's splitting rule (contractions, letters, digits, other signs, white space) for characters below U+0250
_UNIT_A = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_UNIT_B = re.compile(r" *[^ \n\t]+| +|[\n\t]")
_BEYOND = re.compile(f"[^\\u0000-\\u{_TOP - 1:04x}]")


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids in a row, ids per unit)."""
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts


class ByteLevel:
    """Tokenizer A: units, their ids, and each id's bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        # the printable stand-ins of byte-level vocabularies: printable Latin-1 is itself, the rest follows from U+0100
        plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
        byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        size = self.model.get_vocab_size(with_added_tokens=True)
        self.texts = [b""] * size
        for token, i in self.model.get_vocab(with_added_tokens=True).items():
            self.texts[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def split(self, text: str) -> list[str]:
        return _UNIT_A.findall(text) if _BEYOND.search(text) is None else [text]

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.model.encode_batch_fast(units, add_special_tokens=False)])


class Pieces:
    """Tokenizer B: units, their ids, and each id's bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts, n = [], sp.get_piece_size()
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.texts.append(bytes([int(piece[3:5], 16)]))
                continue
            self.texts.append(piece.replace(SPACE, " ").encode())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and (SPACE in piece.lstrip(SPACE) or "\n" in piece or "\t" in piece):
                raise ValueError(f"piece {i} crosses the units of a text")
        self.lead = sp.encode("\n")  # the added space and a line break, which no piece joins to what follows

    def split(self, text: str) -> list[str]:
        return _UNIT_B.findall(text)

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        skip = len(self.lead)
        ids, counts = _flat(self.model.encode(["\n" + u for u in units], num_threads=1))
        own = np.ones(len(ids), bool)
        own[((np.cumsum(counts) - counts)[:, None] + np.arange(skip)).ravel()] = False
        return ids[own], counts - skip


class _Numbers(dict):
    """Units and their numbers, in the order in which they were first asked for."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


class Encoder:
    """One side's tokens of many texts at once, with remembered units."""

    def __init__(self, model: ByteLevel | Pieces):
        self.model = model
        self.widths = np.array([len(t) for t in model.texts], np.int64)
        self.number = _Numbers()
        self.ids, self.counts, self.exact, self.met = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Units met most often since they came stay, ``MAX_UNITS`` / 2 at most; those met once go."""
        often = np.argsort(-self.met, kind="stable")[: MAX_UNITS // 2]
        stay = np.sort(often[self.met[often] > 1])
        units = list(self.number)
        self.number = _Numbers(zip(map(units.__getitem__, stay.tolist()), range(len(stay))))
        self.ids = self.ids[self._places(stay)]
        self.counts, self.exact, self.met = self.counts[stay], self.exact[stay], self.met[stay] // 2

    def _places(self, which: np.ndarray) -> np.ndarray:
        """Where the ids of these units lie."""
        counts, starts = self.counts[which], np.cumsum(self.counts) - self.counts
        return np.arange(int(counts.sum())) + np.repeat(starts[which] - np.cumsum(counts) + counts, counts)

    def _learn(self, new: list[str]) -> None:
        ids, counts = self.model.encode(new)
        ends, wide = np.cumsum(counts), np.concatenate([[0], np.cumsum(self.widths[ids])])
        tails = wide[ends]
        joined, whole = b"".join(map(self.model.texts.__getitem__, ids.tolist())), "".join(new).encode()
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        if len(whole) != sizes.sum():
            sizes = np.fromiter((len(u.encode()) for u in new), np.int64, len(new))
        exact = np.ones(len(new), bool)
        if joined != whole or (tails != np.cumsum(sizes)).any():
            heads = wide[ends - counts].tolist()
            exact[:] = [joined[i:j] == u.encode() for i, j, u in zip(heads, tails.tolist(), new)]
        self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        self.exact, self.met = np.concatenate([self.exact, exact]), np.concatenate([self.met, np.zeros(len(new), np.int64)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts in a row, tokens per text, whether the joined bytes are the text's)."""
        if len(self.number) > MAX_UNITS:
            self._forget()
        split = [self.model.split(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        known = len(self.number)
        which = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if len(self.number) > known:
            self._learn(list(islice(self.number, known, None)))
        self.met += np.bincount(which, minlength=len(self.met))
        owner = np.repeat(np.arange(len(texts)), sizes)
        per_text = np.bincount(owner, self.counts[which], len(texts)).astype(np.int64)
        exact = np.bincount(owner, ~self.exact[which], len(texts)) == 0
        return self.ids[self._places(which)], per_text, exact


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A and every B interval (both sides in ascending order)."""
    starts, ends = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.empty(len(order), bool)
    breaks[0] = True
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(start_a)], group[len(start_a) :]


def links(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (A number, B number) whose intervals overlap."""
    low = np.searchsorted(end_b, start_a, "right")
    n = np.maximum(np.searchsorted(start_b, end_a, "left") - low, 0)
    a = np.repeat(np.arange(len(start_a)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


class Aligner:
    """Both tokenizers, and the alignment of chunks of texts."""

    def __init__(self, model_a: str = MODEL_A, model_b: str = MODEL_B):
        a, b = ByteLevel(model_a), Pieces(model_b)
        self.a, self.b = Encoder(a), Encoder(b)
        self.n_b, self.n_pairs = len(b.texts), len(a.texts) * len(b.texts)
        self.code = np.dtype("<u4") if self.n_pairs <= 2**32 else np.dtype("<u8")
        self.span = max(len(a.texts), len(b.texts))
        self.ends = [f"{i}{sep}".encode() for sep in (",", "|", ";") for i in range(self.span)]

    def align(self, texts: list[str | None]) -> dict:
        """Counts, digests and different pairs (with their times) of each text."""
        n = len(texts)
        out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
        out |= {"groups": [""] * n, "bounds": np.zeros(n + 1, np.int64), "pairs": np.zeros(0, np.int64), "times": np.zeros(0, np.int64)}
        spaced = [f" {t}" if t else "" for t in texts]
        ids_a, n_a, good_a = self.a.encode(spaced)
        ids_b, n_b, good_b = self.b.encode(spaced)
        good = good_a & good_b
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b = n_a * good, n_b * good
        if not len(ids_a):
            return out
        end_a, end_b = np.cumsum(self.a.widths[ids_a]), np.cumsum(self.b.widths[ids_b])
        start_a, start_b = end_a - self.a.widths[ids_a], end_b - self.b.widths[ids_b]
        group_a, group_b = coalesce(start_a, end_a, start_b, end_b)
        left, right = links(start_a, end_a, start_b, end_b)
        owner_a = np.repeat(np.arange(n), n_a)
        first = np.concatenate([[True], group_a[1:] != group_a[:-1]])
        out["n_a"], out["n_b"] = n_a, n_b
        out["n_groups"] = np.bincount(owner_a[first], minlength=n)
        out["n_links"] = np.bincount(owner_a[left], minlength=n)
        out["groups"] = self._digests(ids_a, ids_b, group_a, group_b, n_a + n_b)
        pair = ids_a[left].astype(np.int64) * self.n_b + ids_b[right]
        keys, times = np.unique(owner_a[left] * np.int64(self.n_pairs) + pair, return_counts=True)
        out["bounds"] = np.concatenate([[0], np.cumsum(np.bincount(keys // self.n_pairs, minlength=n))])
        out["pairs"], out["times"] = keys % self.n_pairs, times
        return out

    def _digests(self, ids_a, ids_b, group_a, group_b, sizes) -> list[str]:
        """Digest of ``a1,a2|b1;...`` per text: A's ids of a group, then B's, by computed places."""
        n = int(group_a[-1]) + 1
        until_a, until_b = np.cumsum(np.bincount(group_a, minlength=n)), np.cumsum(np.bincount(group_b, minlength=n))
        place_a = np.arange(len(ids_a)) + np.concatenate([[0], until_b[:-1]])[group_a]
        place_b = np.arange(len(ids_b)) + until_a[group_b]
        last_a, last_b = np.concatenate([group_a[1:] != group_a[:-1], [True]]), np.concatenate([group_b[1:] != group_b[:-1], [True]])
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        code[place_a] = ids_a + self.span * last_a
        code[place_b] = ids_b + 2 * self.span * last_b
        words = list(map(self.ends.__getitem__, code.tolist()))
        tails = np.cumsum(sizes).tolist()
        return [hashlib.sha256(b"".join(words[a:b])[:-1]).hexdigest() if b > a else "" for a, b in zip([0, *tails], tails)]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(model_a: str, model_b: str) -> Aligner:
    if (model_a, model_b) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[model_a, model_b] = Aligner(model_a, model_b)
    return _ALIGNERS[model_a, model_b]


ALIGNED = "segment long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, pair array<long>, docs array<int>"


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return pairs, np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)


def _chunks(batches: Iterator, chunk: int) -> Iterator[tuple[list, list]]:
    """(ids, texts) of at most ``chunk`` characters, or of one longer text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if size and size + len(t or "") > chunk:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i), texts.append(t)
            size += len(t or "") + 1
    if ids:
        yield ids, texts


def align_documents(docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B, chunk: int = CHUNK, segment: int = SEGMENT) -> DataFrame:
    """First pass over doc_id and text: a row per document, and a row per segment (null doc columns, its pairs and how many of its documents hold each)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T._parse_datatype_string(ALIGNED))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        aligner = _aligner(model_a, model_b)
        base, number, size = TaskContext.get().partitionId() << 32, 0, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def closed():
            pair, count = _merged(held)
            row = {f.name: [None] for f in arrow} | {"segment": [base + number], "pair": [pair.tolist()], "docs": [count.tolist()]}
            return pa.RecordBatch.from_pydict(row, schema=arrow)

        for ids, texts in _chunks(batches, chunk):
            found = aligner.align(texts)
            cuts = found["bounds"].tolist()
            pairs, times = found["pairs"].astype(aligner.code), found["times"].astype("<u4")
            rows = {k: found[k] for k in ("n_a", "n_b", "n_groups", "n_links")}
            rows |= {"segment": [base + number] * len(ids), "doc_id": ids, "groups_sha256": found["groups"]}
            rows |= {"pairs": [pairs[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], "times": [times[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]}
            rows |= {"pair": [None] * len(ids), "docs": [None] * len(ids)}
            yield pa.RecordBatch.from_pydict({f.name: rows[f.name] for f in arrow}, schema=arrow)
            held.append(np.unique(found["pairs"], return_counts=True))
            if len(held) % 4 == 0:
                held[:] = [_merged(held)]
            size += sum(len(t or "") for t in texts)
            if size >= segment:
                yield closed()
                held, number, size = [], number + 1, 0
        if held:
            yield closed()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), ALIGNED)


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair, a_id, count (documents that hold the pair), best (highest count of its A id)."""
    rows = aligned.where(F.col("pair").isNotNull()).select(F.explode(F.arrays_zip("pair", "docs")).alias("r"))
    counts = written(rows.groupBy(F.col("r.pair").alias("pair")).agg(F.sum("r.docs").alias("count")), "token-pairs")
    a_id = F.expr(f"cast(pair div {n_b} as int)")
    # one row per id of A's vocabulary at most: the bound of the broadcast
    top = counts.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("top"))
    return counts.withColumn("a_id", a_id).join(F.broadcast(top), "a_id").select("pair", "a_id", "count", (F.col("count") == F.col("top")).alias("best"))


REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def alignment_report(docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B, chunk: int = CHUNK, segment: int = SEGMENT) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligner = _aligner(model_a, model_b)
    n_b, code = aligner.n_b, aligner.code
    aligned = written(align_documents(docs, model_a, model_b, chunk, segment), "aligned")
    counts = pair_counts(aligned, n_b)
    asked = aligned.where(F.col("pair").isNotNull()).select(F.col("segment").alias("asking"), F.explode("pair").alias("pair"))
    answers = asked.join(counts, "pair").select("asking", "pair", "count", "best")
    # ids travel as text: pandas would turn numbers beside nulls into floating point
    own = aligned.where(F.col("pair").isNull()).drop("pair", "docs").withColumn("doc_id", F.col("doc_id").cast("string"))
    schema = T._parse_datatype_string(REPORT.replace("doc_id long", "doc_id string"))
    names = [f.name for f in schema.fields]

    def fill(rows: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        pair = answer["pair"].to_numpy(np.int64)
        order = np.argsort(pair)
        pair, count, best = pair[order], answer["count"].to_numpy(np.int64)[order], answer["best"].to_numpy(bool)[order]
        n_best, sums = [], []
        for p, t in zip(rows["pairs"], rows["times"]):
            at = np.searchsorted(pair, np.frombuffer(p, code).astype(np.int64))
            times = np.frombuffer(t, "<u4").astype(np.int64)
            n_best.append(int(times[best[at]].sum()))
            sums.append(int((times * count[at]).sum()))
        done = rows.drop(columns=["segment", "pairs", "times"])
        return done.assign(n_best=np.array(n_best, np.int64), count_sum=np.array(sums, np.int64))[names]

    return own.groupBy("segment").cogroup(answers.groupBy("asking")).applyInPandas(fill, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
