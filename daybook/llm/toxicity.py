"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the presence of words and word beginnings is fitted from confirmed toxic documents
(P) and a sample of all documents, labelled or not (U). With class prior p and logistic loss, the risk is
``p R_P(+) + max(0, R_U(-) - p R_P(-))``: U's risk as negatives is corrected by the share of toxic
documents in U, and where the corrected part falls below zero the step is taken against it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import materialise, text_batches

WORDS = re.compile(r"\w+")
BEGINNINGS = (4, 5, 6)


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 5


def word_features(word: str) -> list[str]:
    """The word and its beginnings (marked, so that a short word isn't taken for a beginning)."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) >= n)]


def _features(text: str | None) -> set[str]:
    return {f for w in set(WORDS.findall(text.lower())) for f in word_features(w)} if text else set()


@dataclass
class Model:
    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -8.0
    #: feature numbers of the words met so far; bounded, rebuilt on every worker
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def present(self, text: str | None) -> list[int]:
        found: set[int] = set()
        for w in set(WORDS.findall(text.lower())) if text else ():
            ids = self.known.get(w)
            if ids is None:
                if len(self.known) >= 100_000:
                    self.known.clear()
                ids = self.known[w] = tuple(self.features[f] for f in word_features(w) if f in self.features)
            if ids:
                found.update(ids)
        return sorted(found)

    def score(self, text: str | None) -> float:
        z = self.bias + self.weights[self.present(text)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def train(rows: list[list[int]], positive: np.ndarray, n_features: int, prior: float, *, steps: int = 400,
          rate: float = 0.1, decay: float = 5e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative PU risk by full-batch Adam with a falling rate. ``rows``: feature numbers per
    document; ``positive``: which of them are confirmed toxic, the rest is unlabelled."""
    sizes = np.array([len(r) for r in rows])
    flat = np.array([f for r in rows for f in r], np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    n_p, n_u = positive.sum(), (~positive).sum()
    w, b = np.zeros(n_features), 0.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        z = np.bincount(owner, weights=w[flat], minlength=len(rows)) + b
        s = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        loss = np.logaddexp(0, z)  # as a negative, with slope s; as a positive the slope is s - 1
        negative_risk = loss[~positive].mean() - prior * loss[positive].mean()
        as_negative = np.where(positive, -prior / n_p, 1 / n_u) * s
        g = as_negative + np.where(positive, prior / n_p, 0) * (s - 1) if negative_risk >= 0 else -as_negative
        grad = np.append(np.bincount(flat, weights=g[owner], minlength=n_features) + decay * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        step = rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_positive: int = 4096, max_unlabelled: int = 16_384, max_features: int = 4096, min_z: float = 4.0,
        seed: int = 13) -> Model:
    """Fit on at most ``max_positive`` confirmed documents and about ``max_unlabelled`` others, drawn by
    seeded hashes of the id, none of them with ``fold`` 0. Neither labels of fold 0 nor any other column
    is used. The prior is the share of toxic among the labels read. Features are those at least
    ``min_z`` standard errors more frequent in P than in U, the clearest ``max_features`` of them.
    Without positives, unlabelled texts or features nothing is learned and every score is near 0.
    """
    text_batches(docs.sparkSession)
    given = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna()
             .where(fold(F.col("id")) != 0).groupBy("id").agg(F.max("y").alias("y")))
    prior = given.agg(F.avg("y")).first()[0]
    if not prior:
        return Model()
    drawn = F.xxhash64(F.lit(seed), "id")
    confirmed = given.where("y = 1").orderBy(drawn).limit(max_positive).select("id", F.lit(True).alias("p"))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(fold(F.col("id")) != 0)
    chance = min(1.0, max_unlabelled / max(1, src.count()))
    sampled = F.pmod(drawn, F.lit(1 << 53)) / F.lit(float(1 << 53)) < chance
    # P and U are drawn apart from each other: a confirmed document in U's sample counts in both
    sample = (src.join(F.broadcast(confirmed), "id", "left")  # max_positive ids
              .select("text", F.explode(F.array_compact(F.array(
                  F.when(F.col("p"), F.lit(True)), F.when(sampled, F.lit(False))))).alias("p")))
    sample = materialise(sample, "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def out() -> pa.RecordBatch:
            keys = list(found[True].keys() | found[False].keys())
            batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([found[True][k] for k in keys], pa.int64()),
                                                pa.array([found[False][k] for k in keys], pa.int64())], ["feature", "p", "u"])
            found[True].clear()
            found[False].clear()
            return batch

        for b in batches:
            for text, p in zip(b.column("text").to_pylist(), b.column("p").to_pylist(), strict=True):
                found[p].update(_features(text))
                if len(found[True]) + len(found[False]) > 200_000:
                    yield out()
        yield out()

    n = {r["p"]: r["count"] for r in sample.groupBy("p").count().collect()}
    if len(n) < 2:
        return Model()
    rate_p, rate_u = F.col("p") / n[True], F.col("u") / n[False]
    pooled = (F.col("p") + F.col("u")) / (n[True] + n[False])
    z = (rate_p - rate_u) / F.sqrt(pooled * (1 - pooled) * (1 / n[True] + 1 / n[False]))
    clear = (sample.mapInArrow(count, "feature string, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
             .where("p >= 3").withColumn("z", z).where(F.col("z") >= min_z).orderBy(F.desc("z"), "feature").limit(max_features))
    features = {r["feature"]: i for i, r in enumerate(clear.collect())}
    if not features:
        return Model()
    model = Model(features)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [model.present(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), b.column("p")], ["f", "p"])

    encoded = sorted(map(tuple, sample.mapInArrow(encode, "f array<int>, p boolean").collect()), key=str)  # partition order is chance
    w, b = train([list(f) for f, _ in encoded], np.array([p for _, p in encoded]), len(features), prior)
    return Model(features, w, b)


def score_column(text: Column, model: Model) -> Column:
    """Score of each whole text (0 to 1; null and empty texts: that of a text without features)."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return scored(text)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score double`` of every record."""
    return docs.select(F.col(id_col).alias("id"), score_column(F.col(text_col), model).alias("score"))


def keep_clean(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The records, with all their columns, that score below ``threshold``."""
    return docs.where(score_column(F.col(text_col), model) < threshold)
