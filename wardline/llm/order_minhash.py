"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Words are runs of letters and digits in lower case. A document's k-mers are its runs of
five words, each labelled with its occurrence number. A sketch takes, under one hash
function, the ``PICKS`` smallest labelled k-mers and keeps them in text order, so two
documents agree in it with a probability that follows their edit similarity (order and
repeats count, unlike in a plain MinHash). A changed word spoils five k-mers, so edits that are
scattered over a text leave too few of them alike: ``pair_sketches`` further sketches take
``PAIR_PICKS`` runs of two words each, as many as the threshold needs. Documents that agree
in any sketch are candidates; of pairs exactly at the threshold, with all edits scattered,
``MISSED`` are not (closer pairs far more rarely).

Equal texts are one class from the start; only class representatives are compared.
Candidates are verified by alignment: the longest common word sequence, with matches only
inside the diagonal band that the threshold allows (a wider match could not reach it), as
a share of the longer text's words; ``SIMILARITY`` or more links. Groups are the connected
components of the links.

Before any text moves, pairs are tried on histograms: a text's words hashed to counters,
about two words to one. The sum of the smaller counters of two texts is never below the
words that they share, so a pair that falls short of the threshold there can't reach it.
For what is left, a text goes once to each block of ``BESIDE`` partners, not once per pair.

A bucket (documents that agree in one sketch) is never expanded into all its pairs:
1. every member is compared with the bucket's first member, over all buckets at once: by
   histograms all of them, by texts first with one of its first members, then with those of
   another component only. Links merge members into components;
2. in buckets that still hold several components, the members outside the first one's
   component are compared with one of them, another in each bucket, unless both are in one
   component already;
3. what is left are pairs of members from different components. Buckets with up to
   ``LARGE`` members are compared pair by pair; in larger ones (much text that unlike
   documents share) blocks of members are compared with each other, in tasks of two
   blocks: by histograms in blocks of ``WIDE`` first, which leave the members that may
   have a partner; their texts in blocks of ``BLOCK``, in tasks that return links only.
Pairs within one component are not needed: the group is the result. So the links of a group
follow its members, not the sketches that they share. No candidate is dropped at any size.

Cases: a null text is no text and is its own group; empty texts are equal texts; texts
without words only group with equal texts; ties are broken by the smallest document (doc_id, then text hash); rows
repeated with the same id and text are one document, of which one row is kept; an empty
table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import cut, fresh, tidy
from wardline.operators.graph import connected_components
from wardline.sinks.scratch import Scratch

K = 5
PICKS = 3
SKETCHES = 32
SIMILARITY = 0.8
PAIR_PICKS = 2
MISSED = 0.02
LARGE = 32
WIDE, BLOCK = 4096, 512
BESIDE = 256
PAIRS_PER_TASK = 500  # at least, of those that Python compares
COUNTERS = 64, 4096
BROADCAST_ROWS = 200_000

_WORD = re.compile(r"\w+")
_ODD = (np.random.default_rng(20).integers(1, 2**63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled_kmers(ids: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(k-mer hash, hash with its occurrence number) in text order; a short text is one k-mer."""
    if len(ids) < k:
        k = len(ids)
    n = len(ids) - k + 1
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = (h + ids[j : j + n]) * _ODD[40 + j % 8]
    h = _scramble(h)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    number = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = number.astype(np.uint64)
    return h, _scramble(h + occurrence * _MIX)


def pair_sketches(least: float = SIMILARITY) -> int:
    """Sketches of word pairs by which texts that align in ``least`` of their words agree in one, but for ``MISSED``.

    With changed words scattered, a pair of words is left with probability least^2.
    """
    left = least**2
    agree = (left / (2 - left)) ** PAIR_PICKS  # in one sketch
    return 1 if agree >= 1 else math.ceil(math.log(MISSED) / math.log(1 - agree))


def order_sketches(ids: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """Signed 64-bit values, one per sketch: its number and the chosen k-mers, in text order."""
    out = [_sketched(*labelled_kmers(ids, K), 0, SKETCHES, PICKS), _sketched(*labelled_kmers(ids, 2), SKETCHES, pair_sketches(least), PAIR_PICKS)]
    return np.concatenate(out).view(np.int64)


def _sketched(kmers: np.ndarray, labelled: np.ndarray, first: int, sketches: int, picks: int) -> np.ndarray:
    picks = min(picks, len(kmers))
    odd = _multipliers(first + sketches)[first:]
    out = np.empty(sketches, np.uint64)
    step = max(1, 2_000_000 // len(kmers))  # bounded memory for very long texts
    for a in range(0, sketches, step):
        values = labelled[None, :] * odd[a : a + step, None]
        at = np.sort(np.argpartition(values, picks - 1, axis=1)[:, :picks], axis=1)
        chosen = kmers[at]
        h = np.arange(first + a, first + a + len(chosen)).astype(np.uint64)
        for j in range(picks):
            h = _scramble(h * _MIX + chosen[:, j])
        out[a : a + step] = h
    return out


def _multipliers(n: int) -> np.ndarray:
    return (np.random.default_rng(7).integers(1, 2**63, n, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def aligned_words(a: list, b: list, band: int) -> int:
    """Longest common subsequence of two sequences, matching i with j only if |i - j| <= band.

    Bit-parallel over the shorter side; equal ends are taken off first.
    """
    if len(a) < len(b):
        a, b = b, a
    head = 0
    while head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not b:
        return head + tail
    where: dict = {}
    for j, w in enumerate(b):
        where[w] = where.get(w, 0) | (1 << j)
    full = (1 << len(b)) - 1
    window = (1 << (2 * band + 1)) - 1
    row = full
    for i, w in enumerate(a):
        m = where.get(w, 0)
        if m:
            m &= (window << (i - band)) if i >= band else (window >> (band - i))
            u = row & m
            row = ((row + u) | (row - u)) & full
    return head + tail + len(b) - row.bit_count()


def histogram(ids: np.ndarray) -> bytes:
    """Words counted by the low bits of their hashes: a power of two of counters, a byte each where that is enough."""
    least, most = COUNTERS
    size = min(max(least, 1 << max(0, len(ids) // 2 - 1).bit_length()), most)
    counts = np.bincount((ids & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else "<u4").tobytes()


def _counters(packed: bytes, n: int) -> np.ndarray:
    """A histogram's counters; their sum, the number of words, tells bytes from longer numbers."""
    counts = np.frombuffer(packed, np.uint8).astype(np.int64)
    return counts if counts.sum() == n and len(counts) <= COUNTERS[1] else np.frombuffer(packed, "<u4").astype(np.int64)


def shared_at_most(x: np.ndarray, y: np.ndarray) -> int:
    """No two texts with these counters share more words."""
    if len(x) < len(y):
        x, y = y, x
    return int(np.minimum(x.reshape(-1, len(y)).sum(axis=0), y).sum())


def similarity(a: str, b: str, least: float = SIMILARITY) -> float:
    """Aligned words as a share of the longer text's; 0 if the lengths alone rule ``least`` out."""
    x, y = words(a), words(b)
    longer, shorter = max(len(x), len(y)), min(len(x), len(y))
    if shorter < least * longer or not longer:
        return 0.0
    common: dict = {}
    for w in x:
        common[w] = common.get(w, 0) + 1
    shared = 0
    for w in y:
        if common.get(w, 0) > 0:
            common[w] -= 1
            shared += 1
    if shared < least * longer:  # no alignment can have more
        return 0.0
    return aligned_words(x, y, int((1 - least) * longer) + 1) / longer


def _sketch_batches(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        known: dict[str, int] = {}
        for batch in batches:
            done: dict[str, tuple] = {}
            made = []
            for key, text in zip(batch["key"], batch["text"]):
                if key not in done:
                    ws = words(text)
                    if len(known) > 200_000:
                        known.clear()
                    ids = np.fromiter((known[w] if w in known else known.setdefault(w, xxhash.xxh64_intdigest(w)) for w in ws), np.uint64, len(ws))
                    done[key] = (len(ws), order_sketches(ids, least) if ws else None, histogram(ids))
                made.append(done[key])
            n, sk, hist = zip(*made) if made else ((), (), ())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "key": batch["key"], "n": n, "sk": sk, "hist": hist})

    return run


def _likely_batches(least: float):
    """Pairs whose histograms leave the threshold possible."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            one: dict[int, np.ndarray] = {}
            ok = []
            for a, na, xa, nb, xb in zip(batch["a"], batch["na"], batch["xa"], batch["nb"], batch["xb"]):
                if a not in one:
                    one[a] = _counters(xa, na)
                ok.append(shared_at_most(one[a], _counters(xb, nb)) >= least * max(na, nb))
            yield batch.loc[ok, ["a", "b"]]

    return run


def _verify_batches(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [similarity(x, y, least) >= least for x, y in zip(batch["xa"], batch["xb"])]
            yield batch.loc[ok, ["a", "b"]]

    return run


def _light(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has ``BROADCAST_ROWS`` rows (of a few numbers) at most; joined by shuffle beyond."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _beside(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs (a, b) with the other columns of ``table`` (node, ...) for both ends, as <column>a and <column>b.

    What belongs to a goes once to each block of its partners. Few pairs are met in few tasks.
    """
    named = lambda end: table.select(F.col("node").alias(end), *[F.col(c).alias(c + end) for c in table.columns if c != "node"])
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(BESIDE)).alias("parts"))
    placed = cut(pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("block")))
    once = placed.select("a", "block").distinct().join(named("a"), "a")
    met = placed.join(named("b"), "b").join(once, ["a", "block"]).drop("block")
    return met.coalesce(max(1, -(-placed.count() // PAIRS_PER_TASK)))


class _Verifier:
    """Which pairs of classes are alike: by length, by histogram, then by their texts."""

    def __init__(self, docs: DataFrame, classes: DataFrame, scratch: Scratch, least: float):
        self.docs, self.classes, self.scratch, self.least = docs, classes, scratch, least

    def texts(self, nodes: DataFrame) -> DataFrame:
        """(node, x) of the given nodes: the one place where texts leave the documents."""
        wanted = _light(cut(self.classes.join(nodes.distinct(), "node").select("node", F.col("key").alias("k"), F.col("rep").alias("r"))))
        rows = self.docs.join(wanted, (self.docs["key"] == wanted["k"]) & self.docs["doc_id"].eqNullSafe(wanted["r"]))
        return rows.select("node", F.col("text").alias("x")).dropDuplicates(["node"])

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b), whose lengths fit, that their histograms do not rule out."""
        made = _beside(pairs, self.classes.select("node", "n", F.col("hist").alias("x")))
        return cut(made.mapInPandas(tidy(_likely_batches(self.least)), "a long, b long"))

    def aligned(self, likely: DataFrame) -> DataFrame:
        """The pairs (a, b) whose texts align."""
        texts = self.scratch.keep(self.texts(likely.select(F.explode(F.array("a", "b")).alias("node"))), "texts")
        found = _beside(likely, texts).select("a", "b", "xa", "xb").mapInPandas(tidy(_verify_batches(self.least)), "a long, b long")
        return cut(found)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b), whose lengths fit, that align."""
        return self.aligned(self.likely(pairs))


def _fits(x: str, y: str, least: float):
    return F.least(x, y) >= F.greatest(x, y) * F.lit(least)


def text_classes(docs: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """Equal texts as one row: (node, key, rep, n, sk, hist); key is the text's digest, node a number for it."""
    rows = docs.where(F.col("key").isNotNull()).select("doc_id", "key", "text")
    sketched = rows.mapInPandas(tidy(_sketch_batches(least)), "doc_id long, key string, n int, sk array<long>, hist binary")
    classes = sketched.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sk").alias("sk"), F.first("hist").alias("hist"))
    return scratch.keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes")


def find_links(docs: DataFrame, classes: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """Verified pairs (a, b) of text classes, enough to connect all classes alike."""
    drawn = classes.select("node", "n", F.posexplode("sk").alias("slot", "bucket"))
    shared = drawn.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("first"), F.max("node").alias("last"))
    shared = shared.where(F.col("first.node") < F.col("last")).select("bucket", F.col("first.node").alias("first"), F.col("first.n").alias("first_n"))
    members = scratch.keep(drawn.join(shared, "bucket"), "members")
    verifier = _Verifier(docs, classes, scratch, least)

    def parts(links: DataFrame) -> DataFrame:
        """(node, part) of the nodes that have a link."""
        ends = links.select(F.explode(F.array("a", "b")).alias("node"))
        return scratch.keep(connected_components(ends, links, "node", "a", "b").withColumnRenamed("component", "part"), "parts")

    def fitting(pairs: DataFrame) -> DataFrame:
        return pairs.where((F.col("a") != F.col("b")) & _fits("na", "nb", least)).select("a", "b").distinct()

    likely = verifier.likely(fitting(members.select(F.col("first").alias("a"), F.col("first_n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb"))))
    # one first member for each node, then the others that are not in its component by that
    links = verifier.aligned(likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    links = cut(links.unionByName(verifier.aligned(_apart(likely, parts(links)))))
    # members outside the component of their bucket's first member, against one of them: another in each bucket
    outside = _placed(members, parts(links), scratch).where("outer").select("bucket", "node", "n", "part")
    second = outside.groupBy("bucket").agg(F.min_by(F.struct("node", "n", "part"), F.xxhash64("node", "bucket")).alias("s"))
    met = outside.join(second, "bucket").where(F.col("part") != F.col("s.part"))
    met = met.select(F.least("s.node", "node").alias("a"), F.greatest("s.node", "node").alias("b"), F.col("s.n").alias("na"), F.col("n").alias("nb"))
    links = cut(links.unionByName(verifier.verified(fitting(met))))
    # what is left: pairs across components, one of them outside the first member's component
    placed = _placed(members, parts(links), scratch)
    counts = placed.groupBy("bucket").agg(F.count_if("outer").alias("n_outer"), F.count(F.lit(1)).alias("in_bucket"))
    left = scratch.keep(placed.join(counts.where("n_outer > 0").drop("n_outer"), "bucket"), "left")
    few = left.where(F.col("in_bucket") <= LARGE)
    mate = few.where("outer").select("bucket", F.col("node").alias("mate"), F.col("n").alias("mate_n"), F.col("part").alias("mate_part"))
    met = few.join(mate, "bucket").where(F.col("part") != F.col("mate_part"))
    met = met.select(F.least("node", "mate").alias("a"), F.greatest("node", "mate").alias("b"), F.col("n").alias("na"), F.col("mate_n").alias("nb"))
    links = cut(links.unionByName(verifier.verified(fitting(met))))
    return cut(links.unionByName(_compared_in_blocks(left.where(F.col("in_bucket") > LARGE), verifier)))


def _apart(pairs: DataFrame, part: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component."""
    of = lambda end: part.select(F.col("node").alias(end), F.col("part").alias("part_" + end))
    found = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return found.where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")


def _placed(members: DataFrame, part: DataFrame, scratch: Scratch) -> DataFrame:
    """Members with their component, and whether it is another than the bucket's first member's."""
    first = part.select(F.col("node").alias("first"), F.col("part").alias("first_part"))
    found = members.join(part, "node", "left").join(first, "first", "left")
    found = found.withColumns({"part": F.coalesce("part", "node"), "first_part": F.coalesce("first_part", "first")})
    return scratch.keep(found.select("bucket", "slot", "node", "n", "part", (F.col("part") != F.col("first_part")).alias("outer")), "placed")


_TASK = ["bucket", "x", "y", "inner"]


def _dealt(left: DataFrame, block: int) -> DataFrame:
    """Members of each bucket in blocks, as rows of the tasks that compare two blocks (or one with itself).

    Members outside the first one's component meet each other and those inside it.
    """
    sides = left.groupBy("bucket").agg(F.count_if("outer").alias("n_outer"), F.count_if(~F.col("outer")).alias("n_inner"))
    left = left.join(sides.where("n_outer > 0"), "bucket")
    outer_blocks, inner_blocks = (F.ceil(F.col(c) / block).cast("int") for c in ("n_outer", "n_inner"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("outer"), outer_blocks).otherwise(inner_blocks)).cast("int")
    task = lambda x, y, inner: F.struct(x.alias("x"), y.alias("y"), F.lit(inner).alias("inner"))
    ks = F.sequence(F.lit(0), outer_blocks - 1)
    among = F.transform(ks, lambda k: task(F.least(k, F.col("own")), F.greatest(k, F.col("own")), False))
    with_inner = F.when(F.col("n_inner") > 0, F.transform(F.sequence(F.lit(0), F.greatest(inner_blocks - 1, F.lit(0))), lambda k: task(F.col("own"), k, True)))
    of_outer = F.concat(among, F.coalesce(with_inner, F.array().cast("array<struct<x:int,y:int,inner:boolean>>")))
    tasks = F.when(F.col("outer"), of_outer).otherwise(F.transform(ks, lambda k: task(k, F.col("own"), True)))
    rows = left.withColumn("own", own).select("bucket", "slot", "node", "part", "outer", "own", F.explode(tasks).alias("t"))
    return rows.select("bucket", "slot", "node", "part", "outer", "own", "t.x", "t.y", "t.inner")


def _compared_in_blocks(left: DataFrame, verifier: _Verifier) -> DataFrame:
    """Links across components in large buckets: blocks of members against each other.

    By their histograms, tasks of two blocks of ``WIDE`` return the members that may have a
    partner; only these members' texts are dealt to tasks of two blocks of ``BLOCK``, which
    return links, one for each two components found to be alike. Nothing grows with the pairs
    but the comparisons themselves.
    """
    least = verifier.least
    members = left.select("bucket", "slot", "node", "part", "outer")
    known = _dealt(members, WIDE).join(verifier.classes.select("node", "n", "sk", "hist"), "node")
    may = cut(known.groupBy(*_TASK).applyInPandas(_may_have_partners(least), "bucket long, node long").distinct())
    texts = verifier.scratch.keep(verifier.texts(may.select("node")).withColumnRenamed("x", "text"), "texts")
    asked = _dealt(members.join(may, ["bucket", "node"]), BLOCK).join(verifier.classes.select("node", "n", "sk"), "node").join(texts, "node")
    return asked.groupBy(*_TASK).applyInPandas(_block_links(least), "a long, b long")


def _allowed(rows: pd.DataFrame, least: float) -> np.ndarray:
    """Pairs that a task has to compare: across components and sides, of fitting lengths, not met in an earlier sketch."""
    x, y, inner, slot = (rows[c].iloc[0] for c in ("x", "y", "inner", "slot"))
    n, part, outer, own = (rows[c].to_numpy() for c in ("n", "part", "outer", "own"))
    allowed = np.triu(np.ones((len(rows), len(rows)), bool), 1) & (part[:, None] != part[None, :])
    if inner:
        allowed &= outer[:, None] != outer[None, :]
    elif x != y:
        allowed &= own[:, None] != own[None, :]
    allowed &= np.minimum(n[:, None], n[None, :]) >= least * np.maximum(n[:, None], n[None, :])
    # a pair that agrees in an earlier sketch is compared in that bucket
    sk = np.stack([np.asarray(v, np.int64) for v in rows["sk"]])
    for j in range(int(slot)):
        allowed &= sk[:, None, j] != sk[None, :, j]
    return allowed


def _may_have_partners(least: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n", kind="stable", ignore_index=True)
        x, y, inner, slot = (rows[c].iloc[0] for c in ("x", "y", "inner", "slot"))
        n, part, outer, own = (rows[c].to_numpy() for c in ("n", "part", "outer", "own"))
        side = outer if inner else own if x != y else None
        held = [_counters(h, k).astype(np.int32) for h, k in zip(rows["hist"], n)]
        sizes = np.array([len(h) for h in held])  # in order: longer texts have as many counters or more
        earlier = np.stack([np.asarray(v, np.int64)[: int(slot)] for v in rows["sk"]])
        ends = np.searchsorted(n, n / least + 1e-9, "right")
        may = np.zeros(len(rows), bool)
        for size in np.unique(sizes):
            first, last = np.searchsorted(sizes, size), np.searchsorted(sizes, size, "right")
            folded = np.stack([h.reshape(-1, size).sum(axis=0, dtype=np.int32) for h in held[first : max(ends[last - 1], last)]])
            for i in range(first, last):
                at = np.arange(i + 1, ends[i])
                fits = part[at] != part[i]
                if side is not None:
                    fits &= side[at] != side[i]
                if may[i]:
                    fits &= ~may[at]
                at = at[fits]
                # a pair that agrees in an earlier sketch is compared in that bucket
                at = at[~(earlier[at] == earlier[i]).any(axis=1)]
                hit = at[np.minimum(folded[at - first], folded[i - first]).sum(axis=1) >= least * n[at]]
                if len(hit):
                    may[i] = True
                    may[hit] = True
        return rows.loc[may, ["bucket", "node"]]

    return run


def _block_links(least: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        n, part, node = (rows[c].to_numpy() for c in ("n", "part", "node"))
        allowed = _allowed(rows, least)
        if not allowed.any():
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        said = [words(t) for t in rows["text"]]
        likely = allowed & (_shared_words(said) >= least * np.maximum(n[:, None], n[None, :]))
        parent = {int(p): int(p) for p in part}

        def root(p: int) -> int:
            while parent[p] != p:
                p = parent[p]
            return p

        found = []
        for i, j in zip(*np.nonzero(likely)):
            a, b = root(int(part[i])), root(int(part[j]))
            if a != b and aligned_words(said[i], said[j], int((1 - least) * max(n[i], n[j])) + 1) >= least * max(n[i], n[j]):
                parent[max(a, b)] = min(a, b)
                found.append((min(node[i], node[j]), max(node[i], node[j])))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return run


def _shared_words(said: list[list[str]]) -> np.ndarray:
    """Words that each two texts have in common, with repeats: no alignment has more."""
    where: dict[str, dict[int, int]] = {}
    for i, ws in enumerate(said):
        for w in ws:
            in_texts = where.setdefault(w, {})
            in_texts[i] = in_texts.get(i, 0) + 1
    shared = np.zeros((len(said), len(said)), np.int32)
    for in_texts in where.values():
        if len(in_texts) > 1:
            at, counts = np.fromiter(in_texts, np.int64), np.fromiter(in_texts.values(), np.int32)
            shared[np.ix_(at, at)] += np.minimum(counts[:, None], counts[None, :])
    return shared


def near_duplicate_groups(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(key, text_class, class_id, keep_key): the group of each distinct text.

    ``text_class`` is the smallest doc_id with that text, ``class_id`` the smallest of the
    group; the kept document has doc_id ``class_id`` and text ``keep_key``.
    """
    keyed = docs.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("key"))
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    classes = text_classes(keyed, least, scratch)
    links = find_links(keyed, classes, least, scratch)
    linked = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    parts = cut(connected_components(linked, links, "node", "a", "b"))
    names = classes.select("node", "key", "rep")
    best = names.join(parts, "node").groupBy("component").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "key")).alias("best"))
    grouped = parts.join(best, "component").select("node", F.col("best.rep").alias("keep_id"), F.col("best.key").alias("keep_key"))
    found = names.join(grouped, "node", "left").select(
        "key",
        F.col("rep").alias("text_class"),
        F.when(F.col("keep_key").isNull(), F.col("rep")).otherwise(F.col("keep_id")).alias("class_id"),
        F.coalesce("keep_key", "key").alias("keep_key"),
    )
    found = cut(found)
    scratch.clear()  # nothing that is returned reads the tables in between
    return found


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, text_class, kept (for all rows of the kept document)."""
    groups = near_duplicate_groups(docs, least).withColumnRenamed("key", "k")
    rows = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("key"))
    joined = rows.join(groups, rows["key"] == groups["k"], "left")
    alone = F.col("key").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("text_class")).alias("text_class"),
        (alone | ((F.col("key") == F.col("keep_key")) & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group; same columns."""
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    groups = near_duplicate_groups(typed, least).withColumnRenamed("key", "k")
    key, gone_key, gone_id = (fresh(docs, c) for c in ("text_key", "gone_key", "gone_id"))
    digest = F.md5(F.col("text").cast("binary"))
    rows = typed.select("doc_id", digest.alias("key")).where(F.col("key").isNotNull()).groupBy("doc_id", "key").count()
    rows = cut(rows.join(groups, F.col("key") == F.col("k")).withColumn("kept", (F.col("key") == F.col("keep_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))))
    gone = _light(rows.where(~F.col("kept")).select(F.col("key").alias(gone_key), F.col("doc_id").alias(gone_id)))
    left = docs.withColumn(key, digest).join(gone, (F.col(key) == F.col(gone_key)) & F.col("doc_id").eqNullSafe(F.col(gone_id)), "left_anti")
    if rows.where(F.col("kept") & (F.col("count") > 1)).isEmpty():
        return left.select(*docs.columns)
    # some kept document has several rows: one of them stays
    with_text = left.where(F.col(key).isNotNull()).dropDuplicates(["doc_id", key])
    return with_text.unionByName(left.where(F.col(key).isNull())).select(*docs.columns)
