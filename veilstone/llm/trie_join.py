"""Near-duplicate groups by an exact similarity join of word n-gram sets with prefix trees.

Sets are ordered by one global order: n-grams that few documents hold first, ties by hash. Two sets that link share some
of their first n-grams, so documents meet only where their beginnings do; who meets is verified by tries. A trie
stores the ordered sets of the candidates of one document; the document's own set is traversed with it, sets that
begin alike share their partial overlap, and a subtree is left as soon as what remains cannot reach the overlap a link needs.

The steps, each a Spark job over narrow rows (ids and hashes, not texts):

1. Every text becomes a set of 58-bit n-gram hashes. Equal sets are one class. How many documents hold an n-gram is
   counted over all documents in a table of fixed size, by hash bucket; buckets above the common load tell its level.
   The levels only order n-grams, so an inexact count costs time and never a link.
2. Each class puts out its first n - ceil(0.8 n) + r(n) n-grams. Classes that link share at least the smaller r of them.
3. In every group that shares an n-gram, each class is paired with one head. Pairs whose signatures show that too little
   is shared go at once; of what is left, each class is compared with its best head first, and with the other heads only
   across components. Groups of copies thereby become one component without all their pairs.
4. Classes of different components that share enough n-grams are compared directly, all of them: no link is lost, as
   a pair is left out only if its classes are connected already, or cannot link.

A signature has a bit for about each n-gram of its set, set by the low bits of its hashes. A bit that is set in one and not in
the other stands for an n-gram at least that is not shared: that bounds the overlap from above, exactly.

Defined results: NULL and empty texts have no n-grams and link with nothing; texts of fewer words than `n` are one n-gram;
repeated rows are copies; a NULL id is a document whose component is named by the smallest non-NULL id in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.functions.frames import skew_safe_lookup
from veilstone.llm.common import read_table, scratch, small_batches, stored, work_path

N = 5
#: Link: 100 * overlap >= PERCENT * union.
PERCENT = 80
#: Hash buckets of the holder counts: a fixed table, one byte each where it is broadcast.
BUCKET_BITS = 22
PIECES = 32
#: Slots of the filter of asked texts that is broadcast: a fixed table, whatever the input. A full one costs time, not results.
BROADCAST_IDS = 1 << 24
#: Candidates of one document that are verified in one trie.
TRIE_SETS = 256
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


#: The same by a join of all n-grams and a closure of all links, which only small tables allow.
ORACLE = r"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), grams AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
        FROM split
    ), sized AS (
        SELECT doc_id, len(g)::BIGINT AS n FROM grams
    ), each AS (
        SELECT doc_id, unnest(g) AS gram FROM grams
    ), shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM each a JOIN each b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
    ), linked AS (
        SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
        WHERE 100 * common >= 80 * (x.n + y.n - common)
    ), sides AS (
        SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
    ), reach AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION
        SELECT r.doc_id, s.b FROM reach r JOIN sides s ON s.a = r.other
    )
    SELECT doc_id, n AS n_shingles, min(other) AS component_id FROM reach JOIN sized USING (doc_id) GROUP BY doc_id, n
"""


class Shingler:
    """Sets of n-gram hashes. Letters A-Z are lower-cased; words are what stands between the six ASCII blanks.

    A word's hash is a polynomial in its bytes, taken from running sums over the text, so that no word is handled alone.
    """

    SEGMENT = 1 << 18

    def __init__(self, n: int = N):
        self.n = n
        draw = np.random.default_rng(41)
        letters = draw.integers(1, 1 << 63, 256, dtype=np.uint64)
        letters[ord("A") : ord("Z") + 1] = letters[ord("a") : ord("z") + 1]
        self.letters = letters
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, size: int) -> None:
        """Powers of the base, and of its inverse modulo 2**64, up to `size`."""
        if len(self.powers) <= size:
            base = 0xD6E8FEB86659FD93
            steps = np.full(max(size + 1, 2 * len(self.powers)), base, np.uint64)
            back = np.full(len(steps), pow(base, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(steps), np.cumprod(back)

    def _words(self, raw: np.ndarray, blank: np.ndarray) -> np.ndarray:
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
        starts, ends = edge[::2], edge[1::2]
        self._reach(len(raw))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.letters[raw] * self.powers[: len(raw)])])
        h = (sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(29))

    def words_of(self, text: str | None) -> np.ndarray:
        """A hash for each word; long texts go by segments that end at a blank."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        blank = self.blank[raw]
        if len(raw) <= self.SEGMENT:
            return self._words(raw, blank)
        gaps = np.flatnonzero(blank)
        at = np.searchsorted(gaps, np.arange(self.SEGMENT, len(raw), self.SEGMENT))
        cuts = np.unique(gaps[at[at < len(gaps)]])
        return np.concatenate([self._words(r, b) for r, b in zip(np.split(raw, cuts), np.split(blank, cuts), strict=True)])

    def set_of(self, text: str | None) -> np.ndarray:
        """Distinct hashes of 58 bits, ascending."""
        h = self.words_of(text)
        if not len(h):
            return h
        width = min(self.n, len(h))
        out = np.full(len(h) - width + 1, width, np.uint64)
        for k in range(width):
            out = (out ^ h[k : len(h) - width + 1 + k]) * _MIX
            out ^= out >> np.uint64(31)
        out = np.sort(out >> np.uint64(6))
        return out[np.concatenate([[True], out[1:] != out[:-1]])]


def class_of(grams: np.ndarray) -> int:
    """The id of a set: 63 bits of a hash over all its n-grams and their number."""
    return xxhash.xxh3_64_intdigest(grams.tobytes(), seed=len(grams)) >> 1


def bucket_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(58 - BUCKET_BITS)).astype(np.int64)


def ordered(grams: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Tokens in the global order: level above hash."""
    return np.sort((levels[bucket_of(grams)].astype(np.uint64) << np.uint64(58)) | grams)


def need(a: int | np.ndarray, b: int | np.ndarray) -> int | np.ndarray:
    """Least overlap of a link between sets of sizes a and b."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def shared_prefix(n: int | np.ndarray) -> int | np.ndarray:
    """r(n): n-grams that the beginnings of linked sets share at least."""
    return 1 + n // 40


def prefix_length(n: int) -> int:
    return min(n, n - -(-PERCENT * n // 100) + shared_prefix(n))


def signature(grams: np.ndarray) -> bytes:
    """A bit mask as wide as the set is large, to the next power of two from 64 on."""
    width = max(64, 1 << max(0, len(grams) - 1).bit_length())
    mask = np.zeros(width, bool)
    mask[(grams & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(mask, bitorder="little").tobytes()


def most_shared(a: bytes, n: int, b: bytes, m: int) -> int:
    """An upper bound on the overlap of two sets of sizes `n` and `m` by their signatures."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    width, other = 8 * len(a), 8 * len(b)
    while width > other:  # a wide mask folds onto a narrow one, as both go by low bits
        width //= 2
        x = (x >> width) | (x & ((1 << width) - 1))
    while other > width:
        other //= 2
        y = (y >> other) | (y & ((1 << other) - 1))
    return min(n - (x & ~y).bit_count(), m - (y & ~x).bit_count())


# 1. classes and holder counts


def measured(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text_key`, `n`, `cid` and signature of every document, and with `piece` not NULL the counts of a stretch
    of hash buckets from one task. Copies of a set count once in a task."""

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, counts, seen = Shingler(), np.zeros(1 << BUCKET_BITS, np.uint32), set()

        def count(held: list[np.ndarray]) -> None:
            at = bucket_of(np.concatenate(held))
            if len(at) > len(counts) // 64:
                np.add(counts, np.bincount(at, minlength=len(counts)).astype(np.uint32), out=counts)
            else:
                np.add.at(counts, at, 1)

        for frame in frames:
            sizes, cids, masks, held = [], [], [], [np.zeros(0, np.uint64)]
            for text in frame["text"]:
                grams = shingler.set_of(text)
                cid = class_of(grams)
                sizes.append(len(grams))
                cids.append(cid)
                masks.append(signature(grams))
                if cid not in seen:
                    seen.add(cid)
                    held.append(grams)
                if len(held) > 500:
                    count(held)
                    held = held[:1]
            count(held)
            yield frame[["doc_id", "no_id", "text_key"]].assign(n=sizes, cid=cids, mask=masks, piece=None, counts=None)
        if seen:
            for i, part in enumerate(np.split(counts, PIECES)):
                yield pd.DataFrame({"doc_id": [0], "no_id": False, "text_key": 0, "n": 0, "cid": 0, "mask": b"", "piece": i, "counts": [zlib.compress(part.tobytes(), 1)]})

    kinds = "doc_id long, no_id boolean, text_key long, n long, cid long, mask binary, piece int, counts binary"
    told = with_flag(docs).withColumn("text_key", F.xxhash64("text")).mapInPandas(measure, kinds)
    return told.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def with_flag(docs: DataFrame) -> DataFrame:
    """Ids without NULL, as pandas would turn a column with NULLs into floating numbers, and a flag for them."""
    return docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text")


def levels_of(table: DataFrame) -> np.ndarray:
    """The level of each bucket: 0 up to the common load, then the logarithm of what is above it."""

    def total(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((1 << BUCKET_BITS) // PIECES, np.int64)
        for part in frame["counts"]:
            out += np.frombuffer(zlib.decompress(part), np.uint32)
        return pd.DataFrame({"piece": [key[0]], "counts": [np.minimum(out, 2**32 - 1).astype(np.uint32).tobytes()]})

    parts = table.where("piece IS NOT NULL").select("piece", "counts").groupBy("piece").applyInPandas(total, "piece int, counts binary")
    pieces = {row["piece"]: np.frombuffer(row["counts"], np.uint32) for row in parts.collect()}  # a table of fixed size
    load = sum(int(p.sum(dtype=np.int64)) for p in pieces.values()) / (1 << BUCKET_BITS)
    levels = np.zeros((PIECES, (1 << BUCKET_BITS) // PIECES), np.uint8)
    for piece, counts in pieces.items():
        above = np.maximum(0, counts - load - 4 * np.sqrt(load) - 2)
        levels[piece] = np.minimum(31, np.ceil(np.log2(above + 1)))
    return levels.ravel()


# 2. beginnings


def beginnings(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """`token`, `cid`, `n` and the token's place `pos` for the first n-grams of every class, once per task. `shared`: the
    levels, a table of fixed size."""

    def begin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(), set()
        for frame in frames:
            for at in range(0, len(frame), 500):
                tokens, cids, sizes, places = [], [], [], []
                for text in frame["text"].iloc[at : at + 500]:
                    grams = shingler.set_of(text)
                    cid = class_of(grams)
                    if len(grams) and cid not in seen:
                        seen.add(cid)
                        first = ordered(grams, shared.value)[: prefix_length(len(grams))]
                        tokens.append(first)
                        cids.append(np.full(len(first), cid))
                        sizes.append(np.full(len(first), len(grams)))
                        places.append(np.arange(len(first)))
                if tokens:
                    token = np.concatenate(tokens).view(np.int64)
                    yield pd.DataFrame({"token": token, "cid": np.concatenate(cids), "n": np.concatenate(sizes), "pos": np.concatenate(places)})

    return docs.select("text").mapInPandas(begin, "token long, cid long, n int, pos int")


def runs(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Whole groups of rows sorted by `key`, several at a time; a group that goes on in the next batch waits for it."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        column = frame[key].to_numpy()
        cut = int(np.searchsorted(column, column[-1]))  # where the last group begins
        if rest and (cut or rest[0][key].iloc[0] != column[0]):
            yield pd.concat([*rest, frame.iloc[:cut]]).reset_index(drop=True)
            rest = []
        elif cut:
            yield frame.iloc[:cut].reset_index(drop=True)
        rest.append(frame.iloc[cut:])
    if rest:
        yield pd.concat(rest).reset_index(drop=True)


def bounds_of(keys: np.ndarray) -> np.ndarray:
    """Starts of the groups of a sorted column, and its end."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def met(first: DataFrame) -> DataFrame:
    """Rows of tokens that two classes or more begin with, each with its group's head: the class with the fewest rarer
    n-grams before the token, which of a family of copies is the one the others were made from."""

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in runs(frames, "token"):
            frame = frame.drop_duplicates(["token", "cid"])
            token = frame["token"].to_numpy()
            bounds = bounds_of(token)
            sizes = np.diff(bounds)
            head = np.repeat(bounds[:-1], sizes)
            out = frame.assign(**{f"head{c}": frame[k].to_numpy()[head] for c, k in (("", "cid"), ("_n", "n"))})
            yield out[np.repeat(sizes, sizes) > 1]

    dealt = first.repartition("token").sortWithinPartitions("token", "pos", "cid")
    return dealt.mapInPandas(keep, "token long, cid long, n int, pos int, head long, head_n int")


def reaches(n: np.ndarray, pos: np.ndarray, other_n: np.ndarray, other_pos: np.ndarray) -> np.ndarray:
    """Whether sets that share a token at these places can link: by their sizes, and as the token may be one of the first
    r(n) shared ones, after which enough n-grams must be left on either side. Of a pair that links, the first r(n)
    shared tokens all pass."""
    low, high = np.minimum(n, other_n), np.maximum(n, other_n)
    left = np.minimum(n - pos, other_n - other_pos) - 1
    return (100 * low >= PERCENT * high) & (shared_prefix(low) + left >= need(n, other_n))


# 3. and 4. verification


@dataclass
class Trie:
    """A stretch of tokens, the sets that end with it, and the branches after it."""

    tokens: np.ndarray
    depth: int
    ends: list[int] = field(default_factory=list)
    branches: list[Trie] = field(default_factory=list)
    shortest: int = 0
    longest: int = 0


def build(sets: list[np.ndarray]) -> Trie:
    """The trie of ordered sets; stretches without a branch are one node."""
    order = sorted(range(len(sets)), key=lambda i: sets[i].byteswap().tobytes())
    root = Trie(np.zeros(0, np.uint64), 0)
    work = [(root, order)]
    while work:
        parent, members = work.pop()
        sizes = [len(sets[i]) for i in members]
        parent.shortest, parent.longest = min(sizes), max(sizes)
        at = 0
        while at < len(members):
            first = sets[members[at]]
            if len(first) == parent.depth:
                parent.ends.append(members[at])
                at += 1
                continue
            end = at + 1
            while end < len(members) and sets[members[end]][parent.depth] == first[parent.depth]:
                end += 1
            last = sets[members[end - 1]]
            m = min(len(first), len(last))
            differ = np.flatnonzero(first[parent.depth : m] != last[parent.depth : m])
            depth = parent.depth + int(differ[0]) if len(differ) else m
            node = Trie(first[parent.depth : depth], depth)
            parent.branches.append(node)
            work.append((node, members[at:end]))
            at = end
    return root


def linked(query: np.ndarray, trie: Trie) -> list[int]:
    """Sets of the trie that link with the query."""
    found, work = [], [(trie, 0)]
    while work:
        node, overlap = work.pop()
        spot = 0
        if len(node.tokens):
            at = np.searchsorted(query, node.tokens)
            overlap += int((query[np.minimum(at, len(query) - 1)] == node.tokens).sum())
            spot = int(np.searchsorted(query, node.tokens[-1], "right"))
        remaining = min(len(query) - spot, node.longest - node.depth)
        if overlap + remaining < need(len(query), node.shortest):
            continue
        found += [i for i in node.ends if overlap >= need(len(query), node.depth)]
        work += [(branch, overlap) for branch in node.branches]
    return found


def slots() -> int:
    """Slots of the filter, in whole bytes and pieces."""
    return -(-BROADCAST_IDS // (8 * PIECES)) * 8 * PIECES


def filter_of(keys: DataFrame) -> np.ndarray:
    """A table of `slots()` bits, set where a key falls; `keys` has one long column, `key`."""
    size = slots()

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(size, bool)
        for frame in frames:
            bits[frame["key"].to_numpy() % size] = True
        for i, part in enumerate(np.split(np.packbits(bits), PIECES)):
            if part.any():
                yield pd.DataFrame({"piece": [i], "bits": [zlib.compress(part.tobytes(), 1)]})

    def joined(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(size // 8 // PIECES, np.uint8)
        for part in frame["bits"]:
            out |= np.frombuffer(zlib.decompress(part), np.uint8)
        return pd.DataFrame({"piece": [key[0]], "bits": [out.tobytes()]})

    kinds = "piece int, bits binary"
    out = np.zeros((PIECES, size // 8 // PIECES), np.uint8)
    for row in keys.mapInPandas(mark, kinds).groupBy("piece").applyInPandas(joined, kinds).collect():  # a table of fixed size
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the keys' slots are set in a filter of packed bits."""
    slot = keys % (8 * len(bits))
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def with_sets(docs: DataFrame, wanted: DataFrame, shared: Broadcast) -> DataFrame:
    """`cid` and its ordered set for the classes `wanted` by `cid` and the `key` of one of their texts. A filter of fixed
    size tells most other texts, the join the rest."""
    bits = docs.sparkSession.sparkContext.broadcast(filter_of(wanted.select("key")))  # a table of fixed size

    def collect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(), set()
        for frame in frames:
            frame = frame[passes(bits.value, frame["text_key"].to_numpy())]
            for at in range(0, len(frame), 200):
                rows = []
                for text in frame["text"].iloc[at : at + 200]:
                    grams = shingler.set_of(text)
                    cid = class_of(grams)
                    if len(grams) and cid not in seen:
                        seen.add(cid)
                        rows.append((cid, ordered(grams, shared.value).tobytes()))
                yield pd.DataFrame(rows, columns=["cid", "grams"])

    found = docs.select("text", F.xxhash64("text").alias("text_key")).mapInPandas(collect, "cid long, grams binary")
    return found.join(wanted.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs `a`, `b` whose signatures allow a link. A class may be in very many pairs as `a`, and only in as many as it
    has first n-grams as `b`."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("mask").alias(f"mask_{c}"))
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    told = skew_safe_lookup(pairs.join(side("b"), "b"), side("a"), counts, "a", "b")
    names = pairs.columns

    def sift(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            columns = (frame[c].to_numpy() for c in ("mask_a", "n_a", "mask_b", "n_b"))
            kept = [most_shared(a, n, b, m) >= need(n, m) for a, n, b, m in zip(*columns, strict=True)]
            yield frame[names][np.array(kept, bool)]

    return stored(told.mapInPandas(sift, pairs.schema), "likely")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, levels: Broadcast) -> DataFrame:
    """The pairs `a`, `b` of classes that link. The candidates of one class are verified in tries of at most about
    `TRIE_SETS` sets, so that a class with very many is shared by several tasks. `pairs` is a stored table."""
    pairs = pairs.select("a", "b")
    asked = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    sets = stored(with_sets(docs, stored(classes.join(asked, "cid", "left_semi").select("cid", "key"), "asked"), levels), "sets")
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / TRIE_SETS).cast("int").alias("shares"))
    every = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    # a query is a row that names itself; no pair does
    queries = shares.join(sets, F.col("a") == F.col("cid")).select("a", every, F.col("a").alias("b"), "grams")
    members = pairs.join(shares, "a").join(sets, F.col("b") == F.col("cid"))
    members = members.select("a", F.pmod(F.xxhash64("b"), "shares").cast("int").alias("share"), "b", "grams")
    lot = F.xxhash64("a", "share").alias("lot")
    dealt = queries.unionByName(members).select("*", lot, (F.col("a") != F.col("b")).alias("member"))
    dealt = dealt.repartition("lot").sortWithinPartitions("lot", "a", "share", "member")

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in runs(frames, "lot"):
            a, b, grams = (frame[c].to_numpy() for c in ("a", "b", "grams"))
            starts = np.flatnonzero(a == b)
            out_a, out_b = [], []
            for start, end in zip(starts, [*starts[1:], len(frame)], strict=True):
                if end > start + 1:
                    trie = build([np.frombuffer(g, np.uint64) for g in grams[start + 1 : end]])
                    for i in linked(np.frombuffer(grams[start], np.uint64), trie):
                        out_a.append(a[start])
                        out_b.append(b[start + 1 + i])
            yield pd.DataFrame({"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})

    return stored(dealt.select("lot", "a", "b", "grams").mapInPandas(verify, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """`cid` and `comp`, the smallest class of its component, for all classes with links. Each round points every class
    at the smallest one it reaches, and along what that points at; it ends when nothing changes."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("cid")).agg(F.min(F.least("a", "b")).alias("comp")), "labels")
    while True:
        heard = both.join(labels, F.col("b") == F.col("cid")).groupBy("a").agg(F.min("comp").alias("near"))
        near = labels.join(heard, F.col("cid") == F.col("a"), "left").select("cid", "comp", F.least("comp", "near").alias("next"))
        up = labels.select(F.col("cid").alias("_at"), F.col("comp").alias("_up"))
        moved = near.join(up, F.col("next") == F.col("_at"), "left").select("cid", "comp", F.least("next", "_up").alias("next"))
        moved = stored(moved, "labels")
        changed = not moved.where("next <> comp").isEmpty()
        labels = moved.select("cid", F.col("next").alias("comp"))
        if not changed:
            return labels


def crossing(bounds: np.ndarray, comp: np.ndarray, small: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group in different components, many at a time. Groups of one component give none. In small
    groups all pairs at a distance are looked at together; in large ones each row outside the group's largest component
    is held against the group, so that a group of copies with a few strangers costs its size times the strangers."""
    starts, sizes = bounds[:-1], np.diff(bounds)
    if not len(comp):
        return
    mixed = np.logical_or.reduceat(comp != np.repeat(comp[starts], sizes), starts)
    few = mixed & (sizes <= small)
    rows = np.flatnonzero(np.repeat(few, sizes))
    ends = np.repeat(bounds[1:], sizes)[rows]
    for step in range(1, small):
        inside = rows + step < ends
        rows, ends = rows[inside], ends[inside]
        if not len(rows):
            break
        apart_ = comp[rows] != comp[rows + step]
        if apart_.any():
            yield rows[apart_], rows[apart_] + step
    for start, size in zip(starts[mixed & (sizes > small)], sizes[mixed & (sizes > small)], strict=True):
        group = comp[start : start + size]
        names, counts = np.unique(group, return_counts=True)
        main = group == names[counts.argmax()]
        for at in np.flatnonzero(~main):
            others = np.flatnonzero((group != group[at]) & (main | (np.arange(size) > at)))
            yield np.full(len(others), start + at), start + others


def apart(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs of classes in different components that share enough first n-grams."""
    # a class has no more rows than first n-grams, so no key is hot
    rows = rows.join(comps, "cid", "left").select("token", "cid", "n", "pos", F.coalesce("comp", "cid").alias("comp"))

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in runs(frames, "token"):
            token, cid, n, pos, comp = (frame[c].to_numpy() for c in ("token", "cid", "n", "pos", "comp"))
            for left, right in crossing(bounds_of(token), comp):
                fits = reaches(n[left], pos[left], n[right], pos[right])
                if fits.any():
                    left, right = left[fits], right[fits]
                    yield pd.DataFrame({"a": cid[left], "b": cid[right], "least": shared_prefix(np.minimum(n[left], n[right]))})

    dealt = rows.repartition("token").sortWithinPartitions("token", "cid")
    seen = dealt.mapInPandas(pair, "a long, b long, least int")
    seen = seen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "least")
    return seen.groupBy("a", "b", "least").count().where("count >= least").select("a", "b")


def across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose classes are in different components so far."""
    side = lambda c: comps.select(F.col("cid").alias(c), F.col("comp").alias(f"comp_{c}"))
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    told = skew_safe_lookup(pairs.join(side("b"), "b", "left"), side("a"), counts, "a", "b")
    return told.where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select(*pairs.columns)


def linked_classes(docs: DataFrame, classes: DataFrame, levels: np.ndarray) -> DataFrame:
    """`cid` and `comp` of all classes with links."""
    levels = docs.sparkSession.sparkContext.broadcast(levels)  # a table of fixed size
    groups = stored(met(beginnings(docs, levels)), "met")
    sizes = (100 * F.least("n", "head_n") >= PERCENT * F.greatest("n", "head_n"))
    stars = groups.where((F.col("cid") != F.col("head")) & sizes).groupBy("head", "cid", "n", "head_n").count()
    enough = F.col("count") >= shared_prefix_column(F.least("n", "head_n"))
    stars = likely(stars.where(enough).select(F.col("head").alias("a"), F.col("cid").alias("b"), "count"), classes)
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a")).select("a", "b")
    links = verified(stored(best, "best"), docs, classes, levels)
    comps = components(links)
    for more in (lambda: across(stars.select("a", "b"), comps), lambda: likely(apart(groups, comps), classes)):
        pairs = stored(more(), "pairs")
        if not pairs.isEmpty():
            links = stored(links.unionByName(verified(pairs, docs, classes, levels)), "links")
            comps = components(links)
    return comps


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of every document with doc_id and text: `doc_id`, `text_key`, `n`, `comp` (a name of its component), `component_id`
    and `first_key`, the text key of the component's first row, which is the one with the smallest id and then the
    smallest key. Those without n-grams come apart, as they are in no component."""
    spark = docs.sparkSession
    small_batches(spark)
    table = stored(measured(docs), "measured")
    levels = levels_of(table)
    held = table.where("piece IS NULL").select("doc_id", "text_key", "n", "cid", "mask")
    spot = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))
    per_class = held.groupBy("cid").agg(
        F.min(spot).alias("first"), F.max("n").alias("n"), F.count("*").alias("rows"), F.min("text_key").alias("key"), F.first("mask").alias("mask")
    )
    classes = stored(per_class.select("cid", "first", "n", "rows", "key", "mask"), "classes")
    with scratch(spark):
        comps = linked_classes(docs, classes, levels)
        named = classes.join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        first = named.groupBy("comp").agg(F.min("first").alias("_first"))
        told = F.col("_first.doc_id").alias("component_id"), F.col("_first.text_key").alias("first_key")
        rows = named.join(first, "comp").select("cid", "comp", *told)
        path = work_path(spark, "lookup")
        rows.write.parquet(path)
    lookup = spark.read.schema(rows.schema).parquet(path)
    held = held.drop("mask")
    full = held.where("n > 0")
    out = skew_safe_lookup(full, lookup, classes.select("cid", F.col("rows").alias("rows")), "cid", "doc_id", n="rows")
    return out.drop("cid"), held.where("n = 0").drop("cid")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_shingles` and `component_id` of every document with doc_id and text."""
    full, empty = grouped(docs)
    alone = empty.select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n", "component_id").unionByName(alone).withColumnRenamed("n", "n_shingles")


def shared_prefix_column(n: Column) -> Column:
    return 1 + F.floor(n / 40)


def op9_trie_components(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_duplicates(read_table(spark, folder, "documents"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Of the rows with an id in each component one stays: the one with the smallest id, then the smallest text key, then
    the first by the other columns. Rows without an id stay, as do rows whose text has no n-grams."""
    full, _ = grouped(docs)
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("text_key") == F.col("first_key"))
    per_key = full.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), first.alias("_first"))
    # texts that go, and first rows that are there more than once; single first rows are not touched
    copies = stored(per_key.agg(F.count("*").alias("_n")).where("NOT _first OR _n > 1"), "copies")
    same = lambda keys: (docs["doc_id"] == keys["_id"]) & (F.xxhash64(docs["text"]) == keys["_key"])
    single = docs.join(copies, same(copies), "left_anti")
    again = copies.where("_first")
    if again.isEmpty():
        return single
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    key = F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key")
    one = docs.join(again, same(again), "left_semi").groupBy(*key).agg(F.min_by(F.struct(*docs.columns), order).alias("_row"))
    return single.unionByName(one.select("_row.*"))


def survivors(docs: DataFrame) -> DataFrame:
    """Of the rows of each component exactly one: the one with the smallest id, a NULL id last, then the smallest text key, then
    the first by the other columns. Rows whose text has no n-grams stay. Rows are told apart by id and text, so ids may be
    missing or repeated."""
    full, _ = grouped(docs)
    keys = stored(full.groupBy("comp", "doc_id", "text_key").agg(F.count("*").alias("_n")), "keys")
    spot = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    first = keys.groupBy("comp").agg(F.min(spot).alias("_spot"))
    counts = keys.groupBy("comp").agg(F.count("*").alias("n"))
    told = skew_safe_lookup(keys, first, counts, "comp", "text_key").withColumn("_first", spot == F.col("_spot"))
    gone = told.where("NOT _first OR _n > 1").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_first")
    copies = stored(gone, "copies")
    same = lambda keys: docs["doc_id"].eqNullSafe(keys["_id"]) & (F.xxhash64(docs["text"]) == keys["_key"])
    # a filter of fixed size tells most texts that have no copy, which then need not be moved
    bits = docs.sparkSession.sparkContext.broadcast(filter_of(copies.select(F.col("_key").alias("key"))))

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(passes(bits.value, keys.to_numpy()))

    alone, asked = docs.where(~maybe(F.xxhash64("text"))), docs.where(maybe(F.xxhash64("text")))
    single = alone.unionByName(asked.join(copies, same(copies), "left_anti"))
    again = copies.where("_first")  # the one that stays is there more than once
    if again.isEmpty():
        return single
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    key = F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key")
    one = docs.join(again, same(again), "left_semi").groupBy(*key).agg(F.min_by(F.struct(*docs.columns), order).alias("_row"))
    return single.unionByName(one.select("_row.*"))
