"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words, all of which are encoded; only documents have labels. A learned layer
encodes each passage, gated attention weighs the passages of a document, and the weighted passage representation is
scored. Passage features come from its words: shares of letters, capitals, digits and marks, lengths, words that repeat
the one before, and signed hashes of word endings and shapes. The network is trained by numpy on at most about
`FIT_DOCUMENTS` labelled documents.

Defined results: NULL text and text without words is one passage without words; NULL labels are not learned from; of
several labels the largest counts; without labels of both kinds the score is the share of label 1, or 0.5; repeated rows
are scored alike; only named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.llm.common import bounded_sample, is_fold, read_table, stored

PASSAGE = 100
FIT_DOCUMENTS = 8_000
HASHED = 56
WIDTH = HASHED + 8
#: Distinct words whose features a task keeps; beyond that it starts anew.
CACHE = 200_000
ENCODED, ATTENTION = 24, 16


def signs(feature: str) -> np.ndarray:
    """One signed hash in `HASHED` places."""
    out = np.zeros(WIDTH, np.float32)
    h = zlib.crc32(feature.encode("utf-8", "surrogatepass"))
    out[8 + h % HASHED] = 1.0 if h >> 31 else -1.0
    return out


def shape_of(word: str) -> tuple[str, int, int, int]:
    """Kinds of letters with repeats joined, and numbers of letters, capitals and digits."""
    n = len(word)
    if word.isalpha():
        if word.islower():
            return "a", n, 0, 0
        if word.isupper():
            return "A", n, n, 0
        if word[0].isupper() and word[1:].islower():
            return "Aa", n, 1, 0
    letters, upper, digits = (sum(map(f, word)) for f in (str.isalpha, str.isupper, str.isdigit))
    shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return (shape[:1] + "".join(b for a, b in zip(shape, shape[1:]) if a != b))[:12], letters, upper, digits


class Hashes:
    """Signed hashes by feature, each made once; the rows of many features at a time."""

    def __init__(self, kind: str):
        self.kind, self.known, self.rows = kind, {}, np.zeros((256, WIDTH), np.float32)

    def of(self, features: list[str]) -> np.ndarray:
        for f in (f for f in set(features) if f not in self.known):
            i = self.known[f] = len(self.known)
            if i == len(self.rows):
                self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
            self.rows[i] = signs(self.kind + f)
        return self.rows[[self.known[f] for f in features]]


class Encoder:
    """Passages of whole texts as vectors; the features of a distinct word are computed once per task."""

    def __init__(self) -> None:
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((4096, WIDTH), np.float32)
        self.endings, self.shapes = Hashes("e"), Hashes("s")

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE:
            self._reset()
            new = list(words)
        if not new:
            return
        shapes, *counts = zip(*map(shape_of, new), strict=True)
        n = np.fromiter(map(len, new), np.float32, len(new))
        letters, upper, digits = (np.array(c, np.float32) for c in counts)
        rows = self.endings.of([w[-3:] for w in new]) + self.shapes.of(list(shapes))
        rows[:, :6] = np.stack([letters / n, upper / n, digits / n, (n - letters - digits) / n, np.minimum(n, 30) / 10, n == 1], 1)
        base = len(self.known)
        while len(self.table) < base + len(new):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
        self.table[base : base + len(new)] = rows
        self.known.update(zip(new, range(base, base + len(new)), strict=True))

    def bags(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The passages of each text."""
        split = [t.split() if t else [] for t in texts]
        self._learn(set().union(*split))
        return [self._passages(words) for words in split]

    def _passages(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((1, WIDTH), np.float32)
        ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        starts = np.arange(0, len(ids), PASSAGE)
        sizes = np.minimum(PASSAGE, len(ids) - starts).astype(np.float32)
        out = np.add.reduceat(self.table[ids], starts, axis=0) / sizes[:, None]
        same = np.concatenate([[False], ids[1:] == ids[:-1]]).astype(np.float32)
        out[:, 6] = np.add.reduceat(same, starts) / sizes
        out[:, 7] = sizes / PASSAGE
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Bags:
    """Passages of documents end to end."""

    rows: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, documents: Sequence[np.ndarray]) -> Bags:
        sizes = np.array([len(d) for d in documents], np.int64)
        return cls(np.concatenate(documents).astype(np.float64), np.cumsum(sizes) - sizes)

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.starts, len(self.rows)))


class Network:
    """e = tanh(W x + w); a = softmax(k . (tanh(V e) * sigmoid(U e))) over a document; logit = c . sum(a e) + d."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @classmethod
    def fresh(cls, mean: np.ndarray, spread: np.ndarray, seed: int = 5) -> Network:
        draw = np.random.default_rng(seed).standard_normal
        return cls(
            {
                "mean": mean, "spread": spread,
                "W": draw((len(mean), ENCODED)) / np.sqrt(len(mean)), "w": np.zeros(ENCODED),
                "V": draw((ENCODED, ATTENTION)) / np.sqrt(ENCODED), "U": draw((ENCODED, ATTENTION)) / np.sqrt(ENCODED),
                "k": draw(ATTENTION) / np.sqrt(ATTENTION), "c": draw(ENCODED) / np.sqrt(ENCODED), "d": np.zeros(1),
            }
        )

    def run(self, bags: Bags) -> dict[str, np.ndarray]:
        p = self.p
        x = (bags.rows - p["mean"]) / p["spread"]
        e = np.tanh(x @ p["W"] + p["w"])
        t, g = np.tanh(e @ p["V"]), sigmoid(e @ p["U"])
        s = (t * g) @ p["k"]
        weight = np.exp(s - np.repeat(np.maximum.reduceat(s, bags.starts), bags.sizes))
        a = weight / np.repeat(np.add.reduceat(weight, bags.starts), bags.sizes)
        z = np.add.reduceat(a[:, None] * e, bags.starts, axis=0)
        return {"x": x, "e": e, "t": t, "g": g, "a": a, "z": z, "logit": z @ p["c"] + p["d"]}

    def gradients(self, bags: Bags, labels: np.ndarray) -> dict[str, np.ndarray]:
        p, r = self.p, self.run(bags)
        error = (sigmoid(r["logit"]) - labels) / len(labels)
        at = np.repeat(error, bags.sizes)
        dz = at[:, None] * p["c"]
        da = (dz * r["e"]).sum(1)
        ds = r["a"] * (da - np.repeat(np.add.reduceat(r["a"] * da, bags.starts), bags.sizes))
        dt = ds[:, None] * p["k"] * r["g"] * (1 - r["t"] ** 2)
        dg = ds[:, None] * p["k"] * r["t"] * r["g"] * (1 - r["g"])
        de = (r["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - r["e"] ** 2)
        return {
            "W": r["x"].T @ de, "w": de.sum(0), "V": r["e"].T @ dt, "U": r["e"].T @ dg,
            "k": (r["t"] * r["g"] * ds[:, None]).sum(0), "c": error @ r["z"], "d": np.array([error.sum()]),
        }

    def scores(self, bags: Bags) -> np.ndarray:
        return sigmoid(self.run(bags)["logit"])


def train(documents: Sequence[np.ndarray], labels: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 5e-3, decay: float = 1e-4) -> Network:
    """Adam over batches of documents, in an order drawn from a fixed seed."""
    rows = np.concatenate(documents).astype(np.float64)
    net = Network.fresh(rows.mean(0), rows.std(0) + 1e-3)
    net.p["d"][:] = np.log(labels.mean() / (1 - labels.mean()))
    names = [n for n in net.p if n not in ("mean", "spread")]
    first, second = ({n: np.zeros_like(net.p[n]) for n in names} for _ in range(2))
    draw, step = np.random.default_rng(9), 0
    for epoch in range(epochs):
        order = draw.permutation(len(documents))
        for at in range(0, len(order), batch):
            step += 1
            part = order[at : at + batch]
            grads = net.gradients(Bags.of([documents[i] for i in part]), labels[part])
            for n in names:
                grad = grads[n] + decay * net.p[n]
                first[n] = 0.9 * first[n] + 0.1 * grad
                second[n] = 0.999 * second[n] + 0.001 * grad**2
                slower = rate * (1 - epoch / epochs)
                net.p[n] = net.p[n] - slower * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, bound: int = FIT_DOCUMENTS) -> Network | float:
    """The network, or the share of label 1 where the sample has one kind of label only. `labels`: doc_id and label."""
    named = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = bounded_sample(named, "doc_id", bound)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder()
        for frame in frames:
            bags = [bag.astype(np.float32).tobytes() for bag in encoder.bags(frame["text"])]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "bag": bags})

    known = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")  # about `bound` rows
    rows = known.mapInPandas(encode, "doc_id long, label int, bag binary").orderBy("doc_id").toPandas()
    target = (rows["label"].to_numpy() == 1).astype(float)
    if not len(rows) or target.min() == target.max():
        return float(target.mean()) if len(rows) else 0.5
    return train([np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in rows["bag"]], target)


def score(docs: DataFrame, model: Network | float, *keep: str) -> DataFrame:
    """`score` of each text with columns `keep`."""
    shared = docs.sparkSession.sparkContext.broadcast(model.p if isinstance(model, Network) else model)  # fixed size

    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder()
        net = Network(shared.value) if isinstance(shared.value, dict) else None
        for texts in batches:
            if net is None:
                yield pd.Series(np.full(len(texts), shared.value))
                continue
            out = np.zeros(len(texts))
            for at in range(0, len(texts), 200):
                out[at : at + 200] = net.scores(Bags.of(encoder.bags(texts.iloc[at : at + 200])))
            yield pd.Series(out)

    return docs.select(*keep, quality("text").alias("score"))


def op6_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; labels are learned outside the held-out fold."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    model = fit(docs, labels.where(~is_fold("doc_id", 4, 2)))
    scored = score(docs.withColumn("held_out", is_fold("doc_id", 4, 2)), model, "doc_id", "held_out")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))
