"""SentencePiece encoding by forward-filtering backward-sampling, and lossless decoding.

A text is cut into units that no piece crosses (spaces with the word behind them, line
breaks, tabs). The pieces of a unit form a lattice over its characters. Forward filtering
sums, for each character, the probability of all segmentations up to it; backward sampling
then draws a segmentation from the end, piece by piece, exactly in proportion to its
probability. The draws are a hash of (seed, row key, unit number, step), so a row is
segmented alike in every run, batch and cluster.

Piece probabilities follow the vocabulary's order, p ~ 1 / (rank + 1) ** ALPHA; pieces that
the model gives no rank of their own come last. A character without a piece becomes the
byte pieces of its UTF-8 form, so does a literal U+2581, since that sign stands for the
space. Decoding turns pieces back into exactly the text, whatever it was.

Distinct units are filtered once per chunk of ``CHUNK`` characters, in numpy; all their
occurrences are sampled together. The vocabulary (bounded by the model file) is read on
the driver and broadcast; its path is a parameter.

Cases: null texts give null ids; empty texts give no ids; units over ``MAX_UNIT``
characters without a space are sampled in stretches of that length; rows with one key get
the same draws (equal texts the same ids); a null key counts as a key of its own; texts of
any length are worked through in chunks; an empty table gives an empty result; extra
columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import fresh, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
#: characters that are filtered and sampled in one go: bounds a worker's memory, changes no result
CHUNK = 500_000
MAX_UNIT = 65_536
SPACE = "▁"

_UNIT = re.compile(r" *[^ \n\t]+| +|[\n\t]")
_NO_CHAR = 0x110000  # stands for a literal U+2581: no piece has it


def load_vocabulary(path: str = MODEL) -> dict:
    """Pieces, log probabilities and byte pieces of a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    for i in normal:
        if SPACE in pieces[i].lstrip(SPACE) or "\n" in pieces[i] or "\t" in pieces[i]:
            raise ValueError(f"piece {i} crosses the units of a text")
    bytes_ = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
    if len(bytes_) != 256:
        raise ValueError("the model has no byte pieces: decoding would not be lossless")
    lowest = min(sp.get_score(i) for i in normal)
    by_rank = sorted(normal, key=lambda i: (-sp.get_score(i), i))
    last = sum(sp.get_score(i) > lowest for i in normal)
    logp = np.full(n, -ALPHA * np.log(last + 1.0))
    for rank, i in enumerate(by_rank[:last]):
        logp[i] = -ALPHA * np.log(rank + 1.0)
    return {"pieces": pieces, "normal": normal, "logp": logp, "bytes": [bytes_[b] for b in range(256)]}


class Sampler:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: dict):
        self.pieces, self.logp = vocabulary["pieces"], vocabulary["logp"]
        self.byte_ids = np.asarray(vocabulary["bytes"], np.int32)
        self.texts = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for b, i in enumerate(vocabulary["bytes"]):
            self.texts[i] = bytes([b])
        # trie: sorted keys (node, character) -> child; node -> piece or -1
        edges: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i in vocabulary["normal"]:
            node = 0
            for c in map(ord, self.pieces[i].replace(SPACE, " ")):
                node = edges.setdefault((node, c), len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = i
        keys = np.array([(a << 21) | c for a, c in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.children = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.ends = np.array(ends, np.int64)
        self.roots = np.full(_NO_CHAR + 1, -1, np.int64)
        for (a, c), child in edges.items():
            if a == 0:
                self.roots[c] = child

    def _step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = (node << 21) | char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.children[at], -1)

    def lattice(self, units: list[str]) -> dict:
        """Forward filtering of distinct units: per character, the pieces that end there with their probabilities."""
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        chars[chars == ord(SPACE)] = _NO_CHAR
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        offset = np.arange(len(chars)) - np.repeat(starts, sizes)
        stop = np.repeat(ends, sizes)
        begin, last, piece = [], [], []
        at = np.arange(len(chars))
        node = self.roots[chars]
        single = (node >= 0) & (self.ends[np.maximum(node, 0)] >= 0)
        missing = at[~single]  # these become bytes: piece -1
        begin.append(missing), last.append(missing), piece.append(np.full(len(missing), -1))
        depth, live = 0, node >= 0
        at, node = at[live], node[live]
        while len(at):
            found = self.ends[node]
            hit = found >= 0
            begin.append(at[hit]), last.append(at[hit] + depth), piece.append(found[hit])
            depth += 1
            inside = at + depth < stop[at]
            at, node = at[inside], node[inside]
            node = self._step(node, chars[at + depth])
            live = node >= 0
            at, node = at[live], node[live]
        begin, last, piece = (np.concatenate(x).astype(np.int32) for x in (begin, last, piece))
        # by position in the unit, then by character: what ends there is summed in one go
        order = np.argsort(offset[last] * np.int64(len(chars)) + last, kind="stable")
        begin, last, piece = begin[order], last[order], piece[order]
        weight = np.where(piece >= 0, self.logp[piece], self.logp.min() - 1.0)
        new = np.flatnonzero(np.concatenate(([True], last[1:] != last[:-1]))) if len(last) else np.zeros(0, np.int64)
        nodes = last[new]  # the character of each lattice node, in order
        level = offset[nodes]
        cuts = np.concatenate((np.flatnonzero(np.concatenate(([True], level[1:] != level[:-1]))), [len(new)])) if len(new) else np.zeros(1, np.int64)
        bounds = np.append(new, len(last))
        alpha = np.zeros(len(chars))
        share = np.empty(len(last))
        first = offset[begin] == 0
        for a, b in zip(cuts[:-1], cuts[1:]):
            lo, hi = bounds[a], bounds[b]
            groups = new[a:b] - lo
            value = weight[lo:hi] + np.where(first[lo:hi], 0.0, alpha[begin[lo:hi] - 1])
            width = np.diff(np.append(groups, hi - lo))
            top = np.maximum.reduceat(value, groups)
            e = np.exp(value - np.repeat(top, width))
            total = np.add.reduceat(e, groups)
            alpha[nodes[a:b]] = top + np.log(total)
            share[lo:hi] = e / np.repeat(total, width)
        # running sums within each node; the last is made unreachable from above
        running = np.cumsum(share)
        running -= np.repeat(running[new] - share[new], np.diff(bounds)) if len(new) else 0
        if len(new):
            running[bounds[1:] - 1] = 2.0
        first_edge = np.empty(len(chars), np.int64)
        first_edge[nodes] = new
        return {"chars": chars, "starts": starts, "ends": ends, "begin": begin, "piece": piece, "running": running, "first": first_edge, "alpha": alpha, "share": share}

    def sample(self, lattice: dict, which: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling: (ids, number of ids per occurrence) for occurrences of units ``which`` with 64-bit streams."""
        cur = lattice["ends"][which] - 1
        low = lattice["starts"][which]
        occ = np.arange(len(which))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        count = np.zeros(len(which), np.int64)
        step = 0
        while len(occ):
            u = _uniform(stream[occ] + np.uint64(step * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
            e = lattice["first"][cur]
            behind = np.flatnonzero(lattice["running"][e] <= u)
            while len(behind):
                e[behind] += 1
                behind = behind[lattice["running"][e[behind]] <= u[behind]]
            begin = lattice["begin"][e]
            steps.append((occ, np.where(lattice["piece"][e] >= 0, lattice["piece"][e], -1 - lattice["chars"][begin])))
            count[occ] += 1
            step += 1
            go = begin > low[occ]
            occ, cur = occ[go], begin[go] - 1
        ids = np.empty(int(count.sum()), np.int64)
        tail = np.cumsum(count)
        for k, (o, p) in enumerate(steps):
            ids[tail[o] - 1 - k] = p
        if (ids < 0).any():
            ids, count = self._as_bytes(ids, count)
        return ids.astype(np.int32), count

    def _as_bytes(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece (negative entries) as their byte pieces."""
        owner = np.repeat(np.arange(len(count)), count)
        char = np.where(ids < 0, -1 - ids, 0)
        char[char == _NO_CHAR] = ord(SPACE)
        width = np.where(ids < 0, 1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF), 1)
        out = np.repeat(ids, width)
        spread = np.repeat(ids < 0, width)
        out[spread] = self.byte_ids[np.frombuffer("".join(map(chr, char[ids < 0])).encode(), np.uint8)]
        return out, np.bincount(np.repeat(owner, width), minlength=len(count))

    def encode(self, texts: list[str | None], keys: list[int | None], seed: int = 0) -> list[np.ndarray | None]:
        """Sampled ids of each text."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        pending: list[tuple[int, int, list[str]]] = []  # (row, number of its first unit, units)
        size = 0
        for row, text in enumerate(texts):
            if not text:
                continue
            units, at = _units(text), 0
            if size + len(text) <= CHUNK:  # the common case: the whole text fits
                pending.append((row, 0, units))
                size += len(text)
                continue
            while at < len(units):
                # a chunk never takes more characters than it may: long texts are spread over chunks
                till, room = at, CHUNK - size
                while till < len(units) and (room > 0 or not size and till == at):
                    room -= len(units[till])
                    till += 1
                if till == at or room <= 0:
                    if till > at:
                        pending.append((row, at, units[at:till]))
                    self._flush(pending, keys, seed, parts)
                    pending, size = [], 0
                else:
                    pending.append((row, at, units[at:till]))
                    size = CHUNK - room
                at = till
        self._flush(pending, keys, seed, parts)
        return [None if t is None else np.concatenate(p) if p else np.zeros(0, np.int32) for t, p in zip(texts, parts)]

    def _flush(self, pending: list, keys: list, seed: int, parts: list) -> None:
        if not pending:
            return
        every = [u for _, _, units in pending for u in units]
        distinct = list(dict.fromkeys(every))
        number = dict(zip(distinct, range(len(distinct))))
        which = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
        streams = [_mix(_key(keys[row], seed) + np.arange(at, at + len(units), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for row, at, units in pending]
        ids, count = self.sample(self.lattice(distinct), which, np.concatenate(streams))
        tail = np.concatenate(([0], np.cumsum(count)))
        place = 0
        for row, _, units in pending:
            parts[row].append(ids[tail[place] : tail[place + len(units)]])
            place += len(units)

    def decode(self, ids) -> str:
        """The text of a list of ids."""
        texts = self.texts
        return b"".join([texts[i] for i in ids]).decode()


def _units(text: str) -> list[str]:
    units = _UNIT.findall(text)
    if len(text) > MAX_UNIT and max(map(len, units)) > MAX_UNIT:
        units = [u[a : a + MAX_UNIT] for u in units for a in range(0, len(u), MAX_UNIT)]
    return units


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (_mix(x) >> np.uint64(11)).astype(np.float64) / 2.0**53


def _key(key: int | None, seed: int) -> np.uint64:
    base = np.array([0x5851F42D4C957F2D if key is None else int(key) & 0xFFFFFFFFFFFFFFFF, seed & 0xFFFFFFFFFFFFFFFF], np.uint64)
    mixed = _mix(base)
    return _mix(mixed[:1] ^ (mixed[1:] << np.uint64(1)) ^ np.uint64(1 if key is None else 0))[0]


_SAMPLERS: dict[int, Sampler] = {}


def _sampler(vocabulary) -> Sampler:
    """One sampler per worker and broadcast vocabulary."""
    if vocabulary.id not in _SAMPLERS:
        _SAMPLERS.clear()
        _SAMPLERS[vocabulary.id] = Sampler(vocabulary.value)
    return _SAMPLERS[vocabulary.id]


class _Shared:
    """A broadcast vocabulary that workers can tell apart."""

    def __init__(self, spark: SparkSession, path: str):
        self.broadcast = spark.sparkContext.broadcast(load_vocabulary(path))
        self.id = hash(self.broadcast._jbroadcast.id()) if self.broadcast._jbroadcast is not None else 0

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> dict:
        return self.broadcast.value


def _keys(batch: pd.DataFrame, column: str) -> list[int | None]:
    return [None if k is None or k != k else int(k) for k in batch[column]]


def encode_documents(docs: DataFrame, model: str = MODEL, seed: int = 0, key: str = "doc_id") -> DataFrame:
    """``docs`` plus piece_ids (array<int>), sampled per row key."""
    shared = _Shared(docs.sparkSession, model)
    ids = fresh(docs, "piece_ids")
    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches):
        import pyarrow as pa

        sampler = _sampler(shared)
        for batch in batches:
            rows = batch.select([key, "text"]).to_pydict()
            found = sampler.encode(rows["text"], [None if k is None else int(k) for k in rows[key]], seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, ids])

    return docs.mapInArrow(tidy(run), schema)


def decode_documents(encoded: DataFrame, model: str = MODEL, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """``encoded`` plus the text that its ids stand for."""
    shared = _Shared(encoded.sparkSession, model)

    @F.pandas_udf("string")
    def decode(column: pd.Series) -> pd.Series:
        sampler = _sampler(shared)
        return pd.Series([None if x is None else sampler.decode(x) for x in column], dtype=object)

    return encoded.withColumn(out, decode(F.col(ids)))


def encoding_report(docs: DataFrame, model: str = MODEL, seed: int = 0) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (little-endian 32-bit ids), text_sha256 of the decoded text, lossless."""
    import hashlib

    shared = _Shared(docs.sparkSession, model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = _sampler(shared)
        for batch in batches:
            texts = [None if t is None else t for t in batch["text"]]
            found = sampler.encode(texts, _keys(batch, "doc_id"), seed)
            back = [None if x is None else sampler.decode(x.tolist()) for x in found]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_pieces": pd.array([None if x is None else len(x) for x in found], dtype="Int64"),
                    "ids_sha256": [None if x is None else hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in found],
                    "text_sha256": [None if t is None else hashlib.sha256(t.encode()).hexdigest() for t in back],
                    "lossless": [a == b for a, b in zip(texts, back)],
                }
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(tidy(run), "doc_id long, n_pieces long, ids_sha256 string, text_sha256 string, lossless boolean")
