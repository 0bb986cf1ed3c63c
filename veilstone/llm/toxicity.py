"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other texts, and these, are the unlabelled ones, a mixture with a known
share of positives, the class prior. The risk of a linear classifier over the features of a text is estimated as

    prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])

so no confirmed clean text is needed; when the part in the maximum falls below zero, the step goes back up. The loss is the
sigmoid one. Features are the distinct words of the whole text and their beginnings of four and five letters, of
which those count whose share among positives exceeds that among unlabelled texts by `LEAST_Z` standard errors, at most
`FEATURES` of them. The fit uses at most about `POSITIVES` confirmed and `UNLABELLED` other texts.

Defined results: NULL and empty texts score by the intercept alone; a document labelled twice is positive if either
label says so; NULL labels say nothing; without any positive the score is 0; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.llm.common import bounded_sample, is_fold, read_table, stored

POSITIVES = 4_000
UNLABELLED = 12_000
FEATURES = 5_000
LEAST_Z = 5.0
LEAST_TEXTS = 3
BEGINNINGS = (4, 5)
_WORD = re.compile(r"[^\W_]+")


def features_of(word: str) -> list[str]:
    return [word, *[word[:n] + "-" for n in BEGINNINGS if len(word) > n]]


def features(text: str | None) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in features_of(w)} if text else set()


@dataclass
class Sparse:
    """Feature numbers of each text, end to end."""

    ids: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: Sequence[np.ndarray]) -> Sparse:
        sizes = [len(t) for t in texts]
        return cls(np.concatenate([np.zeros(0, np.int64), *texts]).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))

    def rows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of these texts, and for each the place of its text in `which`."""
        sizes = self.bounds[which + 1] - self.bounds[which]
        owner = np.repeat(np.arange(len(which)), sizes)
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.ids[np.repeat(self.bounds[which], sizes) + inside], owner

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass(frozen=True)
class Classifier:
    names: dict[str, int]
    weights: np.ndarray
    intercept: float

    def margin(self, text: str | None) -> float:
        look = self.names.get
        ids = [i for i in map(look, features(text)) if i is not None]
        return float(self.intercept + self.weights[sorted(ids)].sum())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_nnpu(
    positive: Sparse, unlabelled: Sparse, size: int, prior: float, steps: int = 800, rate: float = 0.05, decay: float = 1e-5
) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam over all sampled texts at each step: of batches, the part that must not be negative
    would be little but noise."""
    theta = np.zeros(size + 1)
    theta[size] = np.log(prior / (1 - prior))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    p_ids, p_owner = positive.rows(np.arange(len(positive)))
    u_ids, u_owner = unlabelled.rows(np.arange(len(unlabelled)))
    for step in range(1, steps + 1):
        p_called = sigmoid(theta[size] + np.bincount(p_owner, theta[p_ids], len(positive)))
        u_called = sigmoid(theta[size] + np.bincount(u_owner, theta[u_ids], len(unlabelled)))
        # the loss of a text called negative is p_called, of one called positive 1 - p_called
        p_slope = prior * p_called * (1 - p_called) / len(positive)
        u_slope = u_called * (1 - u_called) / len(unlabelled)
        if u_called.mean() >= prior * p_called.mean():
            p_grad, u_grad = -2 * p_slope, u_slope
        else:
            p_grad, u_grad = p_slope, -u_slope
        grad = decay * theta
        grad[size] = p_grad.sum() + u_grad.sum()
        grad[:size] += np.bincount(p_ids, p_grad[p_owner], size) + np.bincount(u_ids, u_grad[u_owner], size)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:size], float(theta[size])


def telling(positive: DataFrame, unlabelled: DataFrame) -> list[str]:
    """Features commoner among positives, the most telling first: counted per batch, summed and chosen by Spark."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = pd.Series([f for t in frame["text"] for f in features(t)], dtype="object").value_counts()
            yield pd.DataFrame({"feature": counts.index, "n": counts.to_numpy()})

    def shares(texts: DataFrame, name: str) -> DataFrame:
        counted = texts.select("text").mapInPandas(count, "feature string, n long")
        return counted.groupBy("feature").agg(F.sum("n").alias(name))

    n, m = positive.count(), unlabelled.count()
    both = shares(positive, "p").where(F.col("p") >= LEAST_TEXTS).join(shares(unlabelled, "u"), "feature", "left").na.fill(0, ["u"])
    pooled = F.greatest((F.col("p") + F.col("u")) / (n + m), F.lit(1e-12))
    z = (F.col("p") / n - F.col("u") / m) / F.sqrt(pooled * F.greatest(1 - pooled, F.lit(1e-12)) * (1 / n + 1 / m))
    top = both.withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(FEATURES)
    return [r["feature"] for r in top.collect()]


def encoded(texts: DataFrame, names: dict[str, int]) -> Sparse:
    """The feature numbers of a bounded sample of texts, on the driver."""
    shared = texts.sparkSession.sparkContext.broadcast(names)  # at most FEATURES names

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look = shared.value.get
        for frame in frames:
            ids = [np.array(sorted(i for i in map(look, features(t)) if i is not None), np.int32).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": ids})

    rows = texts.select("doc_id", "text").mapInPandas(encode, "doc_id long, ids binary").orderBy("doc_id").toPandas()
    return Sparse.of([np.frombuffer(x, np.int32) for x in rows["ids"]])


def fit(docs: DataFrame, toxic_ids: DataFrame, prior: float) -> Classifier:
    """`docs`: doc_id and text, whatever their label. `toxic_ids`: doc_id of confirmed toxic ones among them."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    chosen = bounded_sample(toxic_ids.select("doc_id").distinct(), "doc_id", POSITIVES)
    positive = stored(docs.join(F.broadcast(chosen), "doc_id", "left_semi"), "toxic")  # about POSITIVES ids
    unlabelled = stored(bounded_sample(docs, "doc_id", UNLABELLED, seed=11), "unlabelled")
    if positive.isEmpty() or unlabelled.isEmpty() or not 0 < prior < 1:
        return Classifier({}, np.zeros(0), -500.0)
    names = {f: i for i, f in enumerate(telling(positive, unlabelled))}
    weights, intercept = fit_nnpu(encoded(positive, names), encoded(unlabelled, names), len(names), prior)
    return Classifier(names, weights, intercept)


def score(docs: DataFrame, model: Classifier, *keep: str) -> DataFrame:
    """`score` of each text with columns `keep`."""
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.weights, model.intercept))  # FEATURES names

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        classifier = Classifier(*shared.value)
        for texts in batches:
            yield pd.Series(sigmoid(np.array([classifier.margin(t) for t in texts], float)))

    return docs.select(*keep, toxic("text").alias("score"))


def op2_pu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; labels are learned outside the held-out fold, from which the prior comes too."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", "toxic").where("toxic IS NOT NULL")
    labels = labels.where(~is_fold("doc_id", 5, 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = labels.agg(F.avg("toxic")).first()[0] or 0.0
    model = fit(docs.where(~is_fold("doc_id", 5, 0)), labels.where("toxic = 1"), float(prior))
    scored = score(docs.withColumn("held_out", is_fold("doc_id", 5, 0)), model, "doc_id", "held_out")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
