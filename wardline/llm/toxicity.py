"""Toxicity by a classifier chain.

The categories of the label table are predicted one after the other, each by a linear
(logistic) model over the text and the probabilities of the categories before it. When a
later model is trained, those probabilities are out-of-fold: each labelled row gets them
from a model that has not seen its fold, so they are as uncertain as they are on new
documents. Folds are a hash of the doc_id.

Features: the counts (log1p) of the ``TOKENS`` words and word beginnings (``STEMS`` letters,
which stand for all inflections) that are associated with a category most strongly, and
``STYLE`` of the text (capitals, signs, repetition, length). Word statistics are
counted by Spark over the labelled sample; fitting runs on the driver on at most ``SAMPLE``
labelled rows (the smallest hashes of doc_id), a documented bound; scoring covers every
document in whole.

Cases: null and empty texts have no words and are not toxic (probability 0); labels without
a document, and rows without a label in a category, are left out of training; several labels
of one doc_id count as the largest; without two classes among the labels a category has its
base rate everywhere; rows repeated, or alike, get equal scores; an empty table gives an
empty result; extra columns pass through ``drop_toxic``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import cut, give_back, text_or_empty, tidy

SAMPLE = 12_000
TOKENS = 600
STEMS = (3, 4, 5, 6)
FOLDS = 5
LEAST_DOCS = 3
RIDGE = 1.0
THRESHOLD = 0.5

_TOKEN = re.compile(r"[^\W\d_]+")
STYLE = ("capitals", "signs", "repeats", "longest_repeat", "log_words", "word_length")


def categories(labels: DataFrame) -> dict[str, Column]:
    """The chain over the label table: low quality first, then toxic."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def stems(word: str) -> list[str]:
    """The word, and its beginnings (marked with a hyphen)."""
    return [word, *[word[:k] + "-" for k in STEMS if len(word) > k]]


def style(text: str, words: list[str]) -> list[float]:
    """The numbers named in ``STYLE``."""
    if not words:
        return [0.0] * len(STYLE)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    letters = sum(map(len, words))
    signs = sum(text.count(c) for c in "!#$%&*|=@")
    return [
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / letters,
        signs / len(words),
        1 - len(counts) / len(words),
        max(counts.values()) / len(words),
        float(np.log1p(len(words))),
        letters / len(words),
    ]


def _features(batches: Iterator[pd.DataFrame], vocabulary: dict[str, int]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Each batch with its feature matrix (style first, then words)."""
    known: dict[str, tuple[int, ...]] = {}  # word -> its columns
    for batch in batches:
        for a in range(0, len(batch), 2048):
            part = batch.iloc[a : a + 2048]
            if len(known) > 200_000:
                known.clear()
            x = np.zeros((len(part), len(STYLE) + len(vocabulary)), np.float32)
            for row, text in enumerate(part["text"]):
                words = tokens(text)
                x[row, : len(STYLE)] = style(text, words)
                for w in words:
                    at = known.get(w)
                    if at is None:
                        at = known[w] = tuple(len(STYLE) + vocabulary[s] for s in stems(w) if s in vocabulary)
                    for column in at:
                        x[row, column] += 1
            np.log1p(x[:, len(STYLE) :], out=x[:, len(STYLE) :])
            yield part, x


@dataclass
class Linear:
    """A logistic model; a constant (no weights) if it was given one class only."""

    weights: np.ndarray
    intercept: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x[:, : len(self.weights)] @ self.weights + self.intercept


def fit(x: np.ndarray, y: np.ndarray, use: np.ndarray | None = None, steps: int = 12) -> Linear:
    """Ridge logistic regression by Newton's method on the rows that ``use`` marks."""
    use = np.ones(len(y), bool) if use is None else use
    y = np.where(use, y, 0.0)
    n, hits = use.sum(), y.sum()
    share = (hits + 0.5) / (n + 1.0)
    base = float(np.log(share / (1 - share)))
    if hits in (0, n):
        return Linear(np.zeros(0, np.float32), base)
    k = x.shape[1]
    w = np.zeros(k + 1)
    w[-1] = base
    ridge = np.full(k + 1, RIDGE)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w[:-1].astype(np.float32) + w[-1])
        miss = np.where(use, p - y, 0.0)
        weight = np.where(use, np.maximum(p * (1 - p), 1e-4), 0.0).astype(np.float32)
        gradient = np.append(x.T @ miss.astype(np.float32), miss.sum()) + ridge * w
        curvature = np.empty((k + 1, k + 1))
        curvature[:k, :k] = sum((x[a : a + 1000] * weight[a : a + 1000, None]).T @ x[a : a + 1000] for a in range(0, len(x), 1000))
        curvature[k, :k] = curvature[:k, k] = x.T @ weight
        curvature[k, k] = weight.sum()
        move = np.clip(np.linalg.solve(curvature + np.diag(ridge), gradient), -5, 5)
        w -= move
        if np.abs(move).max() < 1e-4:
            break
    return Linear(w[:-1].astype(np.float32), float(w[-1]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


@dataclass
class Chain:
    """Linear models in order; model c also sees the logits of the models before it."""

    names: list[str]
    vocabulary: dict[str, int]
    centre: np.ndarray
    scale: np.ndarray
    models: list[Linear]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        x = self.prepared(x)
        out = np.zeros((len(x), len(self.models)))
        for c, model in enumerate(self.models):
            out[:, c] = _sigmoid(model.logit(x))
            x = np.concatenate([x, _link(out[:, c])], axis=1)
        return out

    def prepared(self, x: np.ndarray) -> np.ndarray:
        x = x.copy()
        x[:, : len(STYLE)] = (x[:, : len(STYLE)] - self.centre) / self.scale
        return x


def _link(p: np.ndarray) -> np.ndarray:
    """An earlier probability as a column of a later model, on the scale of its logit."""
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p)).astype(np.float32)[:, None]


def _longer(k: int):
    return lambda w: F.length(w) > k


def _start(k: int):
    return lambda w: F.concat(F.substring(w, 1, k), F.lit("-"))


def train_chain(docs: DataFrame, labels: DataFrame, chain: dict[str, Column] | None = None) -> Chain:
    """Fit the chain on the labelled documents of ``docs``."""
    chain = chain or categories(labels)
    names = list(chain)
    per = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.max(y.cast("int")).alias(f"y_{c}") for c, y in chain.items()])
    per = per.where(F.greatest(*[F.col(f"y_{c}") for c in names], F.lit(-1)) >= 0)
    # the sample: SAMPLE rows at most, so it may be broadcast
    order = F.xxhash64(F.lit(3), "doc_id")
    drawn = cut(per.orderBy(order, "doc_id").limit(SAMPLE)).withColumnRenamed("doc_id", "label_id")
    texts = docs.select("doc_id", text_or_empty("text").alias("text"))
    sample = texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id")).drop("label_id")
    sample = cut(sample.dropDuplicates(["doc_id"]).withColumn("fold", F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(FOLDS)).cast("int")))
    # document frequencies of words by category, over the sample
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    starts = [F.transform(F.filter(words, _longer(k)), _start(k)) for k in STEMS]
    said = sample.select(F.explode(F.array_distinct(F.concat(words, *starts))).alias("token"), *[f"y_{c}" for c in names])
    rates = sample.agg(*[F.avg(f"y_{c}").alias(c) for c in names]).first()
    rate = {c: min(max(rates[c] or 0.0, 1e-6), 1 - 1e-6) for c in names}
    counted = said.groupBy("token").agg(F.count(F.lit(1)).alias("docs"), *[F.sum(f"y_{c}").alias(f"hits_{c}") for c in names]).where(F.col("docs") >= LEAST_DOCS)
    strongest: dict[str, None] = {}
    for c in names:
        z = F.abs(F.col(f"hits_{c}") - F.col("docs") * rate[c]) / F.sqrt(F.col("docs") * rate[c] * (1 - rate[c]))
        top = counted.orderBy(z.desc(), "token").limit(TOKENS // len(names)).select("token")
        strongest |= dict.fromkeys(r["token"] for r in top.collect())  # TOKENS rows at most
    vocabulary = {w: i for i, w in enumerate(strongest)}

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _features(batches, vocabulary):
            row, at = np.nonzero(x)  # few of the columns, so that little goes to the driver
            ends = np.searchsorted(row, np.arange(1, len(part)))
            yield part.drop(columns="text").assign(at=np.split(at.astype(np.int32), ends), x=np.split(x[row, at], ends))

    kinds = ", ".join(f"y_{c} int" for c in names)
    rows = sample.select("doc_id", "text", *[f"y_{c}" for c in names], "fold").mapInPandas(tidy(extract), f"doc_id long, {kinds}, fold int, at array<int>, x array<float>").toPandas().sort_values("doc_id")
    x = np.zeros((len(rows), len(STYLE) + len(vocabulary)), np.float32)
    for row, (at, values) in enumerate(zip(rows.pop("at"), rows.pop("x"))):
        x[row, at] = values
    centre = x[:, : len(STYLE)].mean(0) if len(x) else np.zeros(len(STYLE), np.float32)
    scale = np.maximum(x[:, : len(STYLE)].std(0), 1e-6) if len(x) else np.ones(len(STYLE), np.float32)
    out = Chain(names, vocabulary, centre, scale, [])
    x = out.prepared(x)
    fold = rows["fold"].to_numpy()
    for c in names:
        y = rows[f"y_{c}"].to_numpy(np.float64, na_value=np.nan) if len(rows) else np.zeros(0)
        has = ~np.isnan(y)
        y = np.where(has, y, 0.0)
        out.models.append(fit(x, y, has))
        held_out = np.zeros(len(x))
        for f in range(FOLDS):
            held_out[fold == f] = _sigmoid(fit(x, y, has & (fold != f)).logit(x[fold == f]))
        x = np.concatenate([x, _link(held_out)], axis=1)
    return out


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id and one probability per category."""
    model = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = model.value
        for part, x in _features(batches, known.vocabulary):
            p = known.probabilities(x)
            p[x[:, STYLE.index("log_words")] == 0] = 0.0
            yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), **{f"p_{c}": p[:, i] for i, c in enumerate(known.names)}})

    kinds = ", ".join(f"p_{c} double" for c in chain.names)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return texts.mapInPandas(tidy(run), f"doc_id long, {kinds}")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_low_quality, p_toxic, toxic."""
    return score(docs, train_chain(docs, labels)).withColumn("toxic", F.col("p_toxic") >= THRESHOLD)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without toxic documents; same columns."""
    chain = train_chain(docs, labels)
    give_back()  # what fitting took: the driver lives on through the stages that follow
    model = docs.sparkSession.sparkContext.broadcast(chain)

    def clean(batches):
        known = model.value
        at = known.names.index("toxic")
        for batch in batches:
            texts = pd.DataFrame({"text": ["" if t is None else t for t in batch.column("text").to_pylist()]})
            keep = [np.zeros(0, bool)]
            for _, x in _features(iter([texts]), known.vocabulary):
                wordless = x[:, STYLE.index("log_words")] == 0
                keep.append(wordless | (known.probabilities(x)[:, at] < THRESHOLD))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(tidy(clean), docs.schema)
