"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other. Each model is a logistic regression over the
words and word beginnings of a text, and over the probabilities of the categories before it. While
learning, those are out-of-fold: a document's come from a model that has not seen it, so that later
models meet them as they are for new documents. A category's threshold is the one with the best F1
over the out-of-fold probabilities.

Learning uses a bounded sample of the labelled documents (``max_sample``, by a hash of the id) and a
bounded number of features (``max_features``), chosen in Spark by counting them per category: those
whose shares inside and outside a category lie ``significance`` standard deviations apart.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import text_or_empty, written

#: Name and condition on the labels' columns, in the order of the chain.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))
_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (4, 5)
_CACHE = 200_000


def features(text: str | None) -> set[str]:
    """Words of a text in lower case, and the beginnings of longer ones (marked ``^``)."""
    words = set(_WORD.findall((text or "").lower()))
    found = set(words)
    for n in _BEGINNINGS:
        found.update("^" + w[:n] for w in words if len(w) > n)
    return found


def fit_logistic(rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray, n_features: int, *, rounds: int = 200, ridge: float = 1e-3) -> np.ndarray:
    """Weights of the binary features, then of the columns of ``extra``, then the bias. Full
    gradients with Adam; the classes weigh the same."""
    weights = np.zeros(n_features + extra.shape[1] + 1)
    if len(y) == 0 or y.min() == y.max():
        weights[-1] = 12.0 if len(y) and y[0] else -12.0
        return weights
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if lengths.sum() else np.zeros(0, dtype=np.int64)
    of = np.repeat(np.arange(len(rows)), lengths)
    weigh = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        z = np.bincount(of, weights[flat], minlength=len(rows)) + extra @ weights[n_features:-1] + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weigh
        grad = np.concatenate([np.bincount(flat, error[of], minlength=n_features), extra.T @ error, [error.sum()]])
        grad[:-1] += ridge * weights[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        weights -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return weights


def probability(weights: np.ndarray, rows: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
    n = len(weights) - extra.shape[1] - 1
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate(rows) if len(of) else np.zeros(0, dtype=np.int64)
    z = np.bincount(of, weights[flat], minlength=len(rows)) + extra @ weights[n:-1] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Between the scores where F1 is best; one half if there is nothing to tell apart."""
    if len(y) == 0 or y.min() == y.max():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(p[order][1:] < p[order][:-1], True)
    at = int(np.argmax(np.where(ends, f1, -1)))
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((p[order][at] + below) / 2)


@dataclass
class Chain:
    """Models of the categories in their order, over one numbering of the features."""

    names: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]
    thresholds: list[float]

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        """A column per category."""
        found = np.zeros((len(rows), 0))
        for weights in self.weights:
            found = np.column_stack([found, probability(weights, rows, found)])
        return found

    def numbered(self, texts, cache: dict[str, tuple[int, ...]]) -> list[np.ndarray]:
        """Known features of each text; ``cache`` holds those of single words."""
        rows = []
        for text in texts:
            own: set[int] = set()
            for word in set(_WORD.findall((text or "").lower())):
                known = cache.get(word)
                if known is None:
                    known = tuple(self.vocabulary[f] for f in features(word) if f in self.vocabulary)
                    if len(cache) >= _CACHE:
                        cache.clear()
                    cache[word] = known
                own.update(known)
            rows.append(np.fromiter(own, dtype=np.int64, count=len(own)))
        return rows


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, names: list[str], vocabulary: dict[str, int]) -> Chain:
    """``labels`` has a column per category; ``folds`` the number of each row's fold."""
    n = len(vocabulary)
    seen = np.zeros((len(rows), 0))
    weights, thresholds = [], []
    for column in range(len(names)):
        y = labels[:, column].astype(np.float64)
        weights.append(fit_logistic(rows, seen, y, n))
        outside = np.zeros(len(rows))
        for fold in np.unique(folds):
            inside = folds != fold
            own = fit_logistic([r for r, i in zip(rows, inside) if i], seen[inside], y[inside], n)
            rest = [r for r, i in zip(rows, inside) if not i]
            outside[~inside] = probability(own, rest, seen[~inside])
        thresholds.append(best_threshold(outside, y))
        seen = np.column_stack([seen, outside])
    return Chain(names, vocabulary, weights, thresholds)


def _exploded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), 500):
            part = frame.iloc[at : at + 500]
            found = [(f, *row) for text, row in zip(part["text"], part.drop(columns="text").itertuples(index=False)) for f in features(text)]
            yield pd.DataFrame(found, columns=["feature", *part.columns.drop("text")])


def learn(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, *, max_sample: int = 10_000, max_features: int = 8_000, folds: int = 4, least: int = 3, significance: float = 6.0) -> Chain:
    """A chain from the labelled documents. Labels that are null count as not in the category;
    repeated labels of an id count once, with the largest."""
    names = [name for name, _ in categories]
    flags = [F.max(F.coalesce(F.expr(c).cast("int"), F.lit(0))).alias(f"y{i}") for i, (_, c) in enumerate(categories)]
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(*flags)
    share = min(1.0, max_sample / max(1, known.count()))
    order = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 20))
    sample = known.filter(order < math.ceil(share * (1 << 20))).limit(2 * max_sample)
    columns = [f"y{i}" for i in range(len(names))]
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(sample), "doc_id")
    texts = written(texts.dropDuplicates(["doc_id"]), "toxicity-sample")

    schema = "feature string, " + ", ".join(f"{c} int" for c in columns)
    counts = texts.select("text", *columns).mapInPandas(_exploded, schema)
    counts = counts.groupBy("feature").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in columns]).filter(F.col("n") >= least)
    size = texts.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in columns]).first()
    chosen: set[str] = set()
    for c in columns:
        inside, outside = size[c] or 0, size["n"] - (size[c] or 0)
        a, b = (F.col(c) + 0.5) / (inside + 1.0), (F.col("n") - F.col(c) + 0.5) / (outside + 1.0)
        # How far apart the shares are, in standard deviations.
        apart = F.abs(a - b) / F.sqrt(a * (1 - a) / (inside + 1.0) + b * (1 - b) / (outside + 1.0))
        top = counts.filter(apart >= significance).orderBy(F.desc(apart), "feature").limit(max_features // len(columns))
        chosen |= {r["feature"] for r in top.select("feature").collect()}
    chain = Chain(names, {f: i for i, f in enumerate(sorted(chosen))}, [], [])

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[int, ...]] = {}
        for frame in frames:
            yield frame.drop(columns="text").assign(found=[r.astype(np.int32) for r in chain.numbered(frame["text"], cache)])

    numbered = texts.mapInPandas(number, "doc_id bigint, " + ", ".join(f"{c} int" for c in columns) + ", found array<int>")
    found = numbered.orderBy("doc_id").toPandas()
    rows = [np.asarray(r, dtype=np.int64) for r in found["found"]]
    ids = found["doc_id"].to_numpy(dtype=np.int64) if len(found) else np.zeros(0, dtype=np.int64)
    fold = (ids * 2654435761 >> 7) % folds
    return fit_chain(rows, found[columns].to_numpy().reshape(len(found), len(columns)), fold, names, chain.vocabulary)


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, and per category its probability (``p_<name>``) and verdict (``<name>``)."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[int, ...]] = {}
        model = shared.value
        for whole in frames:
            for at in range(0, len(whole), 1000):
                frame = whole.iloc[at : at + 1000]
                rows = model.numbered(frame["text"], cache)
                p, some = model.probabilities(rows), np.array([len(r) > 0 for r in rows], dtype=bool)
                out = frame[["doc_id"]].copy()
                for i, (name, threshold) in enumerate(zip(model.names, model.thresholds)):
                    out[f"p_{name}"], out[name] = p[:, i], (p[:, i] >= threshold) & some
                yield out.astype({"doc_id": "Int64"})

    schema = "doc_id bigint" + "".join(f", p_{n} double, {n} boolean" for n in chain.names)
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInPandas(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, toxic, score (the probability of ``toxic``), and the probabilities and
    verdicts of the other categories. Null text has no features, and without known features nothing
    speaks for a category, so the verdict is false; without labels nothing is toxic."""
    found = scored(docs, learn(docs, labels, **options))
    return found.withColumnRenamed("p_toxic", "score")
