"""Language ID by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The likelihood of a word is the sum over
all its segmentations into pieces, computed by a forward pass; pieces do not cross white space, so a text's likelihood
is the product over its words. Piece probabilities are fitted by expectation maximisation over the segmentations, from a
bounded sample of labelled documents. Words are scored many at a time: one table look-up per start and piece length.

Words are lower-cased and begin with the vocabulary's word mark. Letters that no piece covers cost `UNKNOWN`. Long words are
summed `WIDTH` letters at a time, with the sums of the last places carried on: a score counts all segmentations, whatever the
length. Only the counting of uses, when probabilities are fitted, cuts words longer than that into parts.

Defined results: NULL text and text without a letter give `und` with score 0; NULL labels are not learned from; an empty
table, or one without labels, gives `und` throughout; repeated rows are scored alike; only named columns are read. Of equally
likely languages the first by name counts. `identified` keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.llm.common import bounded_sample, is_fold, read_table, small_batches, stored

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Labelled documents the piece probabilities are fitted on, at most about.
FIT_DOCUMENTS = 8_000
ROUNDS = 3
MARK = "▁"
#: Letters of a long word that are summed at a time.
WIDTH = 32
UNKNOWN = 1e-7
SMOOTHING = 0.1
UNDETERMINED = "und"
#: The column a prediction is in before it is used.
PRIVATE = "_langid_prediction"
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words whose scores a task keeps; beyond that it starts anew.
CACHE = 400_000


def pieces(path: str = VOCABULARY) -> list[str]:
    """Lower-case pieces of a sentencepiece vocabulary, all of them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
    return sorted({p for p in (x.lower() for x in found) if p})


class Lattice:
    """All pieces that start at each place of each word, for many words at once."""

    def __init__(self, vocabulary: Sequence[str]):
        keys = np.array([self._hash(p) for p in vocabulary], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order.astype(np.int32)
        self.size = len(vocabulary)
        self.longest = max(map(len, vocabulary), default=1)
        # a first look by 20 bits of the hash tells nearly all misses
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(keys >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = ((h ^ ord(c)) * int(_STEP)) & ((1 << 64) - 1)
            h ^= h >> 29
        return h

    def pieces_at(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each piece length: rows, starts and piece ids, by start. `codes`: words by letters, 0 beyond their end."""
        n, width = codes.shape
        h = np.zeros((n, width), np.uint64)
        for length in range(1, min(self.longest, width) + 1):
            span = width - length + 1
            h = (h[:, :span] ^ codes[:, length - 1 :].astype(np.uint64)) * _STEP
            h ^= h >> np.uint64(29)
            hit = self.seen[(h >> np.uint64(44)).astype(np.int64)] & (codes[:, length - 1 :] != 0)
            starts, rows = np.nonzero(hit.T)
            wanted = h[rows, starts]
            at = np.minimum(np.searchsorted(self.keys, wanted), self.size - 1)
            right = self.keys[at] == wanted
            yield length, rows[right], starts[right], self.ids[at[right]]


def coded(words: Sequence[str]) -> np.ndarray:
    """Letters of the words as a matrix, 0 beyond their end."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(lengths.max(initial=1))), np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    rows = np.repeat(np.arange(len(words)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


@dataclass
class Forward:
    """Forward sums alpha[word, place, language] over all segmentations, and the arcs they used."""

    alpha: np.ndarray
    arcs: list[Arcs]
    lengths: np.ndarray
    bare: np.ndarray

    @property
    def total(self) -> np.ndarray:
        return self.alpha[np.arange(len(self.lengths)), self.lengths]


class Arcs:
    """Arcs of one piece length, found by their start; at one start each word has one arc at most."""

    def __init__(self, length: int, rows: np.ndarray, starts: np.ndarray, ids: np.ndarray, width: int):
        self.length, self.rows, self.starts, self.ids = length, rows, starts, ids
        self.bounds = np.searchsorted(starts, np.arange(width + 1))

    def at(self, start: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.bounds[start], self.bounds[start + 1])
        return self.rows[part], self.ids[part]


def forward(lattice: Lattice, codes: np.ndarray, weights: np.ndarray, head: np.ndarray | None = None) -> Forward:
    """`weights`: piece by language. Letters without a piece of their own pass at `UNKNOWN`. With `head`, the sums of the
    first places are known from before: word by place by language."""
    n, width = codes.shape
    arcs = [Arcs(*found, width) for found in lattice.pieces_at(codes)]
    bare = codes != 0
    lengths = bare.sum(1)
    if arcs:
        bare[arcs[0].rows, arcs[0].starts] = False
    alpha = np.zeros((n, width + 1, weights.shape[1]))
    known = 1 if head is None else head.shape[1]
    alpha[:, :known] = 1.0 if head is None else head
    for end in range(known, width + 1):
        alpha[:, end] = alpha[:, end - 1] * (bare[:, end - 1, None] * UNKNOWN)
        for a in arcs:
            if a.length <= end:
                rows, ids = a.at(end - a.length)
                alpha[rows, end] += alpha[rows, end - a.length] * weights[ids]
    return Forward(alpha, arcs, lengths, bare)


def log_forward(lattice: Lattice, words: Sequence[str], weights: np.ndarray) -> np.ndarray:
    """Logarithms of the sums over all segmentations, word by language. A long word goes by stretches; the sums of as many
    places as the longest piece has letters are carried into the next stretch, rescaled, so that no piece is cut."""
    reach, step = lattice.longest, max(WIDTH, lattice.longest)
    logs = np.zeros((len(words), weights.shape[1]))
    open_, head, at = np.arange(len(words)), None, 0
    while len(open_):
        back = 0 if head is None else reach
        run = forward(lattice, coded([words[i][at - back : at + step] for i in open_]), weights, head)
        ends = np.array([len(words[i]) <= at + step for i in open_])
        logs[open_[ends]] += np.log(np.maximum(run.total[ends], 1e-300))
        open_ = open_[~ends]
        if len(open_):
            head = run.alpha[~ends][:, back + step - reach : back + step + 1]
            scale = np.maximum(head.max(1), 1e-300)
            logs[open_] += np.log(scale)
            head, at = head / scale[:, None], at + step
    return logs


def expected(lattice: Lattice, codes: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of words that occur `counts` times, for one language."""
    run = forward(lattice, codes, weights[:, None])
    alpha, (n, width) = run.alpha[:, :, 0], codes.shape
    beta = np.zeros((n, width + 1))
    beta[np.arange(n), run.lengths] = 1.0
    for start in range(width - 1, -1, -1):
        beta[:, start] += beta[:, start + 1] * run.bare[:, start] * UNKNOWN
        for a in run.arcs:
            if start + a.length <= width:
                rows, ids = a.at(start)
                beta[rows, start] += weights[ids] * beta[rows, start + a.length]
    scale = counts / np.maximum(alpha[np.arange(n), run.lengths], 1e-300)
    out = np.zeros(len(weights))
    for a in run.arcs:
        mass = alpha[a.rows, a.starts] * weights[a.ids] * beta[a.rows, a.starts + a.length] * scale[a.rows]
        out += np.bincount(a.ids, mass, len(weights))
    return out


def words_of(text: str) -> list[str]:
    return text.lower().split()


def stretches(word: str) -> list[str]:
    """The word in parts of `WIDTH` letters, for counting uses; scores are summed over whole words."""
    marked = MARK + word
    return [marked[i : i + WIDTH] for i in range(0, len(marked), WIDTH)]


def blocks(words: list[str], size: int = 20_000) -> Iterator[list[int]]:
    """Numbers of words of alike length, so that little of a matrix is empty."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    yield from (order[i : i + size] for i in range(0, len(order), size))


class Scorer:
    """Log-likelihood of words in all languages, each distinct word computed once per task."""

    def __init__(self, vocabulary: Sequence[str], weights: np.ndarray):
        self.lattice, self.weights = Lattice(vocabulary), weights
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, self.weights.shape[1]))

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE:
            self._reset()
            new = list(words)
        marked = [MARK + word for word in new]
        sums = np.zeros((len(new), self.weights.shape[1]))
        for block in blocks(marked):
            sums[block] = log_forward(self.lattice, [marked[i] for i in block], self.weights)
        base = len(self.known)
        while len(self.rows) < base + len(new):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        self.rows[base : base + len(new)] = sums
        self.known.update(zip(new, range(base, base + len(new)), strict=True))

    def score(self, texts: Sequence[str]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        self.learn(set().union(*split))
        look = self.known.__getitem__
        out = np.zeros((len(split), self.weights.shape[1]))
        for i, words in enumerate(split):
            if words:
                out[i] = self.rows[np.fromiter(map(look, words), np.int64, len(words))].sum(0)
        return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    vocabulary: list[str]
    weights: np.ndarray


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word occurs in the texts of each language: counted per batch, then summed."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, group in frame.groupby("lang"):
                words = pd.Series([w for t in group["text"] for w in words_of(t)], dtype="object").value_counts()
                yield pd.DataFrame({"lang": lang, "word": words.index, "n": words.to_numpy()})

    batches = docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    return batches.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, vocabulary_path: str = VOCABULARY, bound: int = FIT_DOCUMENTS, rounds: int = ROUNDS) -> Model:
    """Piece probabilities per language from a bounded sample of documents with text and lang. Each round spreads the
    words over the tasks and gathers one number per piece and language."""
    small_batches(docs.sparkSession)
    labelled = docs.select("doc_id", "text", "lang").where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    counts = stored(word_counts(bounded_sample(labelled, "doc_id", bound)), "lang-words")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    vocabulary = pieces(vocabulary_path)
    # shorter pieces are likelier to begin with
    start = np.array([10.0 ** -len(p) for p in vocabulary])
    weights = np.repeat((start / start.sum())[:, None], len(languages), 1)
    if not languages:
        return Model(languages, vocabulary, weights)
    for _ in range(rounds):
        uses = np.zeros_like(weights)
        for row in _expected_uses(counts, languages, vocabulary, weights).collect():
            uses[:, languages.index(row["lang"])] = np.frombuffer(row["uses"])
        weights = (uses + SMOOTHING) / (uses + SMOOTHING).sum(0)
    return Model(languages, vocabulary, weights)


def _expected_uses(counts: DataFrame, languages: list[str], vocabulary: list[str], weights: np.ndarray) -> DataFrame:
    shared = counts.sparkSession.sparkContext.broadcast((languages, vocabulary, weights))  # vocabulary x languages

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, pieces_, w = shared.value
        lattice, sums = Lattice(pieces_), {}
        for frame in frames:
            for lang, group in frame.groupby("lang"):
                k = names.index(lang)
                parts = [(s, n) for word, n in zip(group["word"], group["n"], strict=True) for s in stretches(word)]
                for block in blocks([s for s, _ in parts]):
                    codes = coded([parts[i][0] for i in block])
                    found = expected(lattice, codes, w[:, k], np.array([parts[i][1] for i in block], float))
                    sums[lang] = sums.get(lang, 0) + found
        yield pd.DataFrame([(lang, s.tobytes()) for lang, s in sums.items()], columns=["lang", "uses"])

    def total(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], sum(np.frombuffer(u) for u in frame["uses"]).tobytes())], columns=["lang", "uses"])

    partial = counts.mapInPandas(spread, "lang string, uses binary")
    return partial.groupBy("lang").applyInPandas(total, "lang string, uses binary")


def prediction(docs: DataFrame, model: Model, into: str) -> DataFrame:
    """Adds a struct of `lang_pred` and `score`, the posterior of the language under equal priors."""
    small_batches(docs.sparkSession)
    # plain values, as they are pickled without the package; vocabulary x languages
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.vocabulary, model.weights))
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    @F.pandas_udf("lang_pred string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, vocabulary, weights = shared.value
        scorer = Scorer(vocabulary, weights) if languages else None
        for texts in batches:
            names, scores = [], []
            for at in range(0, len(texts), 256):
                part = texts.iloc[at : at + 256]
                real = [t for t in part if t is not None]
                logs = iter(scorer.score(real)) if scorer and real else iter(())
                for t in part:
                    log = next(logs, None) if t is not None else None
                    if log is None:
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                    else:
                        best = int(log.argmax())
                        names.append(languages[best])
                        scores.append(float(1 / np.exp(log - log[best]).sum()))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn(into, language(F.when(has_letter, F.col("text"))))


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """`lang_pred` and `score` of each text, with columns `keep`."""
    return prediction(docs, model, PRIVATE).select(*keep, f"{PRIVATE}.lang_pred", f"{PRIVATE}.score")


def learned(docs: DataFrame) -> Model:
    """The model of the query: from documents outside the held-out fold."""
    return fit(docs.where(~is_fold("doc_id", 4, 2)))


def op1_marginal_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = learned(docs)
    return predict(docs.withColumn("held_out", is_fold("doc_id", 4, 2)), model, "doc_id", "held_out")


def identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language could be told: not `und`, and likelier than not."""
    model = learned(docs)
    # the prediction stays in one column of its own until it is used, as the documents may have columns of any name
    told = prediction(docs, model, PRIVATE)
    sure = (F.col(f"{PRIVATE}.lang_pred") != UNDETERMINED) & (F.col(f"{PRIVATE}.score") >= least)
    return told.where(sure).drop(PRIVATE)
