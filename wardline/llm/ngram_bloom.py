"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and word pairs of the training documents are quantised on a logarithmic
scale, level = 1 + floor(log_BASE(count)), and an n-gram of level q is put into a Bloom
filter q times, as (n-gram, 1) .. (n-gram, q). A count is read back by probing level after
level until one is missing, so rare n-grams cost one entry and no key is stored. Levels
are exact for counts of 1 to 3 and an error only ever overstates a count.

The model interpolates the pair count with the word count (Dirichlet smoothing):
P(w | u) = (c(uw) + mu * P(w)) / (c(u) + mu), P(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), with all
counts from the filter. ``mu`` is the value of ``GRID`` under which the training documents
are most likely when each token's own occurrence is left out; all training tokens vote.

How it runs: training documents are counted per chunk in numpy; the partial counts go, as
packed arrays, to buckets by n-gram hash; each bucket is merged once and becomes one
segment of the filter. Segments are as large as their entries need (``BITS`` each) and hold
every n-gram; buckets follow the size of the corpus. A filter of up to ``MAX_FILTER_BYTES``
is broadcast. A larger one stays where it is, as rows by bucket: each chunk's different
n-grams go to their buckets, are probed there, and the levels come back to the chunk.
Both ways read the same bits, so the scores are the same.

The base score needs exact word counts. Words are split by count: the ``FREQUENT`` most
frequent (a bounded table) are broadcast, so no frequent word is ever a join key; all
others are joined on the word's 64-bit hash.

Cases: a null text is an empty one: its only token is its end; words are cut at ASCII white
space and A-Z is lowered, nothing else; documents without id count by the empty id text;
without training documents all counts are 0; rows repeated are scored one by one (and
counted one by one); an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import cut, text_or_empty

BASE = 1.5
HASHES = 5
BITS = 10
MAX_FILTER_BYTES = 96 << 20  # of a broadcast filter
MOST_BITS = 1 << 31  # of a segment: positions are hashes of 32 bits
BUCKET_BYTES = 8 << 20  # text per bucket
FREQUENT = 1 << 20
CHUNK = 1_500_000  # tokens
KEPT, KEPT_LEVEL = 1 << 20, 8  # n-grams of this level on whose levels a worker keeps, once probed
GRID = tuple(float(10**k) for k in range(1, 9))
ADD = 0.1

_END, _START = 0x9AE16A3B2F90404F, 0x3C6EF372FE94F82A
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def words(text: str) -> list[bytes]:
    """Words of a text: A-Z lowered, cut at ASCII white space."""
    return text.encode().lower().split()


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


@dataclass
class Tokens:
    """A chunk of documents: each text's words and its end, one after the other, as indices of ``distinct``.

    ``distinct`` holds the hashes of the chunk's words, then those of the end and of the start.
    """

    distinct: np.ndarray
    at: np.ndarray  # each token
    before: np.ndarray  # the token in front of it, or the start
    doc: np.ndarray  # index of its document

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, second, which): the different pairs as indices, and each token's."""
        width = len(self.distinct)
        which, seen = pd.factorize(self.before * width + self.at)
        return seen // width, seen % width, which


def _chunks(texts: list[str]) -> Iterator[tuple[int, int, Tokens]]:
    """(first document, last + 1, tokens) in chunks of about ``CHUNK`` tokens."""
    import xxhash

    till = 0
    while till < len(texts):
        flat: list[bytes] = []
        sizes: list[int] = []
        first = till
        while till < len(texts) and len(flat) < CHUNK:
            ws = words(texts[till])
            flat += ws
            sizes.append(len(ws))
            till += 1
        known: defaultdict[bytes, int] = defaultdict(count().__next__)  # a new word gets the next number
        numbers = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
        distinct = np.empty(len(known) + 2, np.uint64)
        distinct[:-2] = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
        distinct[-2:] = _END, _START
        n = np.asarray(sizes, np.int64)
        at = np.full(len(flat) + len(n), len(known), np.int64)
        ends = np.cumsum(n + 1) - 1
        inner = np.ones(len(at), bool)
        inner[ends] = False
        at[inner] = numbers
        before = np.empty_like(at)
        before[1:] = at[:-1]
        before[0] = len(known) + 1
        before[ends[:-1] + 1] = len(known) + 1
        yield first, till, Tokens(distinct, at, before, np.repeat(np.arange(len(n)), n + 1))


def _counting(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, _, t in _chunks(batch["text"].tolist()):
                rows = []
                one, two, which = t.pairs()
                pairs = pair_keys(t.distinct[one], t.distinct[two]), np.bincount(which, minlength=len(one))
                here = np.bincount(t.at, minlength=len(t.distinct))
                for kind, (keys, counts) in ((1, (t.distinct[here > 0], here[here > 0])), (2, pairs)):
                    # sorted by hash, so each bucket is one slice of it
                    order = np.argsort(keys)
                    seen, counts = keys[order], counts[order]
                    bounds = np.searchsorted(seen, _bucket_edges(buckets))
                    for b in range(buckets):
                        lo, hi = bounds[b], bounds[b + 1] if b + 1 < buckets else len(seen)
                        if hi > lo:
                            rows.append((kind, b, seen[lo:hi].tobytes(), counts[lo:hi].astype(np.uint32).tobytes()))
                yield pd.DataFrame(rows, columns=["kind", "bucket", "keys", "counts"])

    return run


def _bucket_edges(buckets: int) -> np.ndarray:
    """Smallest hash of each bucket: the range of 64 bits in equal parts."""
    return np.array([b * 2**64 // buckets for b in range(buckets)], np.uint64)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(_bucket_edges(buckets), keys, side="right") - 1


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 + floor(log_BASE(count)), by comparison with exact bounds."""
    return np.searchsorted(_LEVEL_FROM, counts, side="right")


_LEVEL_FROM = np.array([BASE**q for q in range(100)])  # least count of level q + 1


def _level_values() -> np.ndarray:
    """The mean whole count of each level, 0 for none; levels without a whole count stand for their bound."""
    out = [0.0]
    for q in range(99):
        lo, hi = int(np.ceil(BASE**q)), int(np.ceil(BASE ** (q + 1))) - 1
        out.append((lo + hi) / 2 if hi >= lo else BASE**q)
    return np.array(out)


LEVEL_VALUE = _level_values()


def _probes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of (key, level) of 32 bits; the second is odd."""
    mixed = _mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return mixed >> np.uint64(32), (mixed & np.uint64(0xFFFFFFFF)) | np.uint64(1)


def _position(one: np.ndarray, two: np.ndarray, j: int, bits: np.ndarray | int) -> np.ndarray:
    """Bit of the j-th probe: (one + j * two) mod 2^32, scaled to the segment (under 2^32 bits)."""
    h = (one + np.uint64(j) * two) & np.uint64(0xFFFFFFFF)
    return ((h * np.asarray(bits, np.uint64)) >> np.uint64(32)).astype(np.int64)


def build_segment(keys: np.ndarray, counts: np.ndarray, most_bits: int = MOST_BITS) -> np.ndarray:
    """The packed bits of one segment: every key at all its levels, whatever its size."""
    level = levels(counts)
    bits = int(min(most_bits, max(64, level.sum() * BITS), MOST_BITS)) // 8 * 8  # whole bytes
    flags = np.zeros(bits, bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        one, two = _probes(keys[level >= q], q)
        for j in range(HASHES):
            flags[_position(one, two, j, bits)] = True
    return np.packbits(flags)


def _merge(parts: pd.DataFrame) -> pd.DataFrame:
    kind, bucket = int(parts["kind"].iloc[0]), int(parts["bucket"].iloc[0])
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in parts["keys"]])
    counts = np.concatenate([np.frombuffer(c, np.uint32) for c in parts["counts"]]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    keys, counts = keys[new], np.add.reduceat(counts, new)
    exact = (keys.tobytes(), counts.tobytes()) if kind == 1 else (None, None)
    return pd.DataFrame({"kind": [kind], "bucket": [bucket], "segment": [build_segment(keys, counts).tobytes()], "keys": [exact[0]], "counts": [exact[1]]})


def _word_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for k, c in zip(batch["keys"], batch["counts"]):
            yield pd.DataFrame({"key": np.frombuffer(k, np.int64), "c": np.frombuffer(c, np.int64)})


class Filter:
    """Segments of the filter by bucket, for one kind of n-gram."""

    def __init__(self, segments: dict[int, bytes], buckets: int):
        self.buckets = buckets
        sizes = np.array([len(segments.get(b, b"")) for b in range(buckets)], np.int64)
        self.offset = np.cumsum(sizes) - sizes
        self.bits = np.maximum(sizes * 8, 1)
        self.empty = sizes == 0
        self.data = np.frombuffer(b"".join(segments.get(b, b"") for b in range(buckets)), np.uint8)
        self.kept = np.zeros(0, np.uint64), np.zeros(0, np.uint8)  # hashes in order, their levels

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Estimated counts of distinct keys."""
        return LEVEL_VALUE[self.levels(keys)]

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of distinct keys, by probing level after level.

        Keys are probed in the order of their hash, one segment after the other, so that the
        part of the filter in use stays in the processor's cache. Frequent n-grams come with
        every chunk and take the most probes: up to ``KEPT`` of them are probed once.
        """
        order = np.argsort(keys)
        keys = keys[order]
        level = np.zeros(len(keys), np.int64)
        kept, kept_levels = self.kept
        new = np.ones(len(keys), bool)
        if len(kept):
            where = np.minimum(np.searchsorted(kept, keys), len(kept) - 1)
            new = kept[where] != keys
            level[~new] = kept_levels[where[~new]]
        level[new] = self._probed(keys[new])
        frequent = new & (level >= KEPT_LEVEL)
        if 0 < np.count_nonzero(frequent) <= KEPT - len(kept):
            at = np.searchsorted(kept, keys[frequent])
            self.kept = np.insert(kept, at, keys[frequent]), np.insert(kept_levels, at, level[frequent])
        out = np.empty(len(keys), np.int64)
        out[order] = level
        return out

    def _probed(self, keys: np.ndarray) -> np.ndarray:
        """Levels of distinct keys in the order of their hash."""
        level = np.zeros(len(keys), np.int64)
        bucket = _bucket_of(keys, self.buckets)
        at = np.flatnonzero(~self.empty[bucket])
        key, offset, bits = keys[at], self.offset[bucket[at]], self.bits[bucket[at]].astype(np.uint64)
        q = 1
        while len(at) and q < len(LEVEL_VALUE):
            one, two = _probes(key, q)
            for j in range(HASHES):
                position = _position(one, two, j, bits)
                byte = self.data[offset + (position >> 3)]
                hit = np.flatnonzero((byte >> (7 - (position & 7)).astype(np.uint8)) & 1)
                if len(hit) < len(at):
                    at, key, offset, bits, one, two = at[hit], key[hit], offset[hit], bits[hit], one[hit], two[hit]
            level[at] = q
            q += 1
        return level


@dataclass
class Model:
    """What workers need: the filter (none if it is not broadcast), the frequent words' exact counts, and totals."""

    words: Filter | None
    pairs: Filter | None
    buckets: int
    frequent: np.ndarray
    frequent_counts: np.ndarray
    tokens: int
    types: int
    texts: int

    def word_probability(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADD) / (self.tokens + ADD * (self.types + 1))

    def exact(self, keys: np.ndarray) -> np.ndarray:
        """Exact counts of frequent words, -1 for others."""
        if not len(self.frequent):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.frequent, keys), len(self.frequent) - 1)
        return np.where(self.frequent[at] == keys, self.frequent_counts[at], -1)

    def log_probabilities(self, t: Tokens, found: dict[int, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Per document and value of GRID: log10 P of the text; the same with each token's own count taken out.

        ``found`` has the levels of the words (1) and pairs (2), by hash, if the filter was probed elsewhere.
        """
        one, two, which = t.pairs()
        keys = pair_keys(t.distinct[one], t.distinct[two])
        if found is None:
            counts, cp = self.words.counts(t.distinct), self.pairs.counts(keys)
        else:
            counts, cp = (_by_key(k, found[kind]) for kind, k in ((1, t.distinct), (2, keys)))
        counts[-1] = self.texts  # as often as texts start
        cu, cw = counts[one], counts[two]
        cp = np.minimum(cp, cu)
        less = [np.maximum(c - 1, 0) for c in (cp, cu, cw)]
        n = int(t.doc[-1]) + 1
        out = []
        for pair, context, word in ((cp, cu, self.word_probability(cw)), (less[0], less[1], self.word_probability(less[2]))):
            logs = [np.log((pair + mu * word) / (context + mu)) for mu in GRID]
            out.append(np.stack([np.bincount(t.doc, x[which], n) for x in logs], 1) / np.log(10))
        return out[0], out[1]


def _by_key(keys: np.ndarray, levels_by_hash: np.ndarray) -> np.ndarray:
    """Counts of ``keys`` from the levels that their sorted hashes have."""
    out = np.empty(len(keys))
    out[np.argsort(keys)] = LEVEL_VALUE[levels_by_hash]
    return out


def _scored(m: Model, docs: pd.DataFrame, t: Tokens, found: dict[int, np.ndarray] | None = None) -> pd.DataFrame:
    """The rows of a chunk's documents (doc_id, uid, held_out)."""
    held, n = docs["held_out"].to_numpy(bool), len(docs)
    score, left_out = m.log_probabilities(t, found)
    left_out[held] = 0.0  # only training texts vote
    exact = m.exact(t.distinct)
    known = (exact >= 0)[t.at]
    logs = np.log10(np.maximum(exact, 0) + ADD)[t.at]
    # words that are not frequent: with their number in each document, to be joined with the exact counts
    rest, tf = np.unique(t.doc[~known] * len(t.distinct) + t.at[~known], return_counts=True)
    bounds = np.searchsorted(rest, np.arange(1, n) * len(t.distinct))
    keys = t.distinct[rest % len(t.distinct)].view(np.int64)
    return pd.DataFrame(
        {
            "doc_id": docs["doc_id"].astype("Int64").to_numpy(),
            "uid": docs["uid"].to_numpy(),
            "held_out": held,
            "n_tokens": np.bincount(t.doc, minlength=n),
            "n_known": np.bincount(t.doc, known, n).astype(np.int64),
            "logs": np.bincount(t.doc, np.where(known, logs, 0.0), n),
            "score": list(score),
            "left_out": list(left_out),
            "keys": np.split(keys, bounds),
            "tf": np.split(tf.astype(np.int32), bounds),
        }
    )


def _scoring(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b, t in _chunks(batch["text"].tolist()):
                yield _scored(model.value, batch.iloc[a:b], t)

    return run


_DOC = np.dtype([("doc_id", "<i8"), ("null", "?"), ("held_out", "?"), ("uid", "<i8"), ("n", "<i8")])
_ASKED = "chunk long, kind int, bucket int, keys binary, at binary, docs binary"


def _asking(buckets: int):
    """Each chunk as a row of kind 0 (its tokens and documents), and its different words (1) and pairs (2) by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edges = _bucket_edges(buckets)
        for batch in batches:
            for a, b, t in _chunks(batch["text"].tolist()):
                part = batch.iloc[a:b]
                docs = np.zeros(b - a, _DOC)
                docs["null"] = part["doc_id"].isna()
                docs["doc_id"] = part["doc_id"].astype("Int64").fillna(0)
                docs["held_out"], docs["uid"], docs["n"] = part["held_out"], part["uid"], np.bincount(t.doc, minlength=b - a)
                chunk = int(docs["uid"][0])
                rows = [(chunk, 0, 0, t.distinct.tobytes(), t.at.astype(np.int32).tobytes(), docs.tobytes())]
                one, two, _ = t.pairs()
                for kind, keys in ((1, t.distinct), (2, pair_keys(t.distinct[one], t.distinct[two]))):
                    keys = np.sort(keys)
                    bounds = np.append(np.searchsorted(keys, edges), len(keys))
                    rows += [(chunk, kind, k, keys[lo:hi].tobytes(), None, None) for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])) if hi > lo]
                yield pd.DataFrame(rows, columns=["chunk", "kind", "bucket", "keys", "at", "docs"])

    return run


def _answering(buckets: int):
    """The levels of all chunks' n-grams of one bucket, in the order in which they were asked for."""

    def run(asked: pd.DataFrame, segments: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame({"chunk": [], "kind": [], "bucket": [], "levels": []})
        bucket = int(asked["bucket"].iloc[0])
        keys, at = np.unique(np.concatenate([np.frombuffer(k, np.uint64) for k in asked["keys"]]), return_inverse=True)
        found = Filter({bucket: bytes(s) for s in segments["segment"]}, buckets).levels(keys).astype(np.uint8)[at]
        ends = np.cumsum([len(k) // 8 for k in asked["keys"]])[:-1]
        return asked[["chunk", "kind", "bucket"]].assign(levels=[x.tobytes() for x in np.split(found, ends)])

    return run


def _scoring_answered(model):
    def run(answers: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        docs = np.frombuffer(row["docs"], _DOC)
        distinct, at, n = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["at"], np.int32).astype(np.int64), docs["n"]
        before = np.empty_like(at)
        before[1:] = at[:-1]
        before[np.cumsum(n) - n] = len(distinct) - 1  # the start
        tokens = Tokens(distinct, at, before, np.repeat(np.arange(len(n)), n))
        # buckets are ranges of hashes: one after the other, they have the hashes in order
        answers = answers.sort_values(["kind", "bucket"])
        found = {kind: np.frombuffer(b"".join(answers.loc[answers["kind"] == kind, "levels"]), np.uint8) for kind in (1, 2)}
        ids = pd.Series(docs["doc_id"]).astype("Int64").mask(docs["null"])
        return _scored(model.value, pd.DataFrame({"doc_id": ids, "uid": docs["uid"], "held_out": docs["held_out"]}), tokens, found)

    return run


def train(texts: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """(model, exact counts (key, c) of all words, segments (kind, bucket, segment)) of the training texts (text, not null).

    The model holds the filter while that has ``MAX_FILTER_BYTES`` at most.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    partial = texts.select("text").mapInPandas(_counting(buckets), "kind int, bucket int, keys binary, counts binary")
    merged = partial.groupBy("kind", "bucket").applyInPandas(_merge, "kind int, bucket int, segment binary, keys binary, counts binary")
    merged = cut(merged)
    counts = merged.where("kind = 1").select("keys", "counts").mapInPandas(_word_rows, "key long, c long")
    histogram = counts.groupBy("c").count().toPandas()  # a row per different count
    types, tokens = int(histogram["count"].sum()), int((histogram["count"] * histogram["c"]).sum())
    histogram = histogram.sort_values("c", ascending=False)
    fits = histogram[histogram["count"].cumsum() <= FREQUENT]
    least = int(fits["c"].min()) if len(fits) else 1 << 62
    frequent = counts.where(F.col("c") >= least).toPandas()
    keys = frequent["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    segments = merged.select("kind", "bucket", "segment")
    filters: dict[int, Filter | None] = {1: None, 2: None}
    if (segments.agg(F.sum(F.octet_length("segment"))).first()[0] or 0) <= MAX_FILTER_BYTES:
        held: dict[int, dict[int, bytes]] = {1: {}, 2: {}}
        for row in segments.toLocalIterator():
            held[row["kind"]][row["bucket"]] = bytes(row["segment"])
        filters = {kind: Filter(held.pop(kind), buckets) for kind in (1, 2)}
    texts_seen = counts.where(F.col("key") == int(np.array([_END], np.uint64).view(np.int64)[0])).agg(F.max("c")).first()[0] or 0
    model = Model(filters[1], filters[2], buckets, keys[order], frequent["c"].to_numpy(np.int64)[order], tokens, types, int(texts_seen))
    return model, counts, segments


def _probed_by_bucket(rows: DataFrame, model, segments: DataFrame, kinds: str) -> DataFrame:
    """The chunks' documents scored with a filter that stays in its buckets."""
    buckets = model.value.buckets
    asked = cut(rows.mapInPandas(_asking(buckets), _ASKED))
    grams = asked.where("kind > 0").select("chunk", "kind", "bucket", "keys").groupBy("kind", "bucket")
    answers = grams.cogroup(segments.groupBy("kind", "bucket")).applyInPandas(_answering(buckets), "chunk long, kind int, bucket int, levels binary")
    chunks = asked.where("kind = 0").select("chunk", "keys", "at", "docs").groupBy("chunk")
    return answers.groupBy("chunk").cogroup(chunks).applyInPandas(_scoring_answered(model), kinds)


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mu."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"), (F.crc32(ident.cast("binary")) % 10 == 0).alias("held_out"))
    model, counts, segments = train(rows.where(~F.col("held_out")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = "doc_id long, uid long, held_out boolean, n_tokens long, n_known long, logs double, score array<double>, left_out array<double>, keys array<long>, tf array<int>"
    numbered = rows.withColumn("uid", F.monotonically_increasing_id())
    per = cut(_probed_by_bucket(numbered, shared, segments, kinds) if model.pairs is None else numbered.mapInPandas(_scoring(shared), kinds))
    rare = per.select("uid", F.explode(F.arrays_zip("keys", "tf")).alias("x")).select("uid", F.col("x.keys").alias("key"), F.col("x.tf").alias("tf"))
    # log10(0 + ADD) for words that training has not seen
    joined = rare.join(counts, "key", "left")
    rest = joined.groupBy("uid").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("rest"), F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("rest_known")
    )
    votes = per.agg(*[F.sum(F.col("left_out")[g]).alias(f"g{g}") for g in range(len(GRID))]).first()
    best = max(range(len(GRID)), key=lambda g: (votes[g] if votes[g] is not None else 0.0, -g))
    whole = float(np.log10(model.tokens + ADD * (model.types + 1)))
    return per.join(rest, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rest", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        F.col("score")[best].alias("score"),
        F.lit(GRID[best]).alias("mu"),
    )
