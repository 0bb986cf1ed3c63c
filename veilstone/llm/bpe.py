"""Byte-level BPE encoding and decoding by a lazily determinised finite-state transducer.

A sequence of tokens is what the merges make of a text exactly if every token comes out of its own bytes and no two
neighbours would have merged across their border. So each prefix of a piece has one last token: the one that ends it and
bears the token before it. The transducer reads bytes and walks the prefixes of tokens from every border that is still
open. It is not deterministic, as a token that ends here may also go on; sets of open walks, each with the tokens
it has not given yet, are the states of its deterministic form. They are built when a text first needs them and kept up
to `STATES`. Tokens that all open walks share are given at once; the rest waits for at most the lookahead that the
longest token allows. The cost is linear in the bytes, also in a run of a million letters.

Decoding is a state machine over bytes (UTF-8 of RFC 3629), with at most three bytes held back, composed with the
vocabulary: one step takes a whole token. It can be fed in any portions.

Defined results: a NULL or empty text gives no tokens, NULL tokens a NULL text; a piece that is itself in the vocabulary
is that one token; text that reads like a special token is ordinary text; bytes that are not UTF-8 decode to one U+FFFD for each
longest beginning of a character; an id outside the vocabulary is an error. Rows are told apart by nothing: repeated
rows, NULL ids and extra columns pass, and a column that has the name of the new one is replaced. An empty table gives an
empty one. Very long texts are read piece by piece, so a task holds one text, its tokens and one piece.
"""

from __future__ import annotations

import base64
import gc
import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone.llm.common import read_table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Bounds of what a worker remembers; whatever is forgotten is made anew.
STATES = 60_000
PIECES = 400_000
PIECE_LETTERS = 64
#: Rows that are given at once.
ROWS = 500
#: Stands for the last token where there is none.
FIRST = (1 << 31) - 1
#: What stands for the rank of no further merge.
ENDS = float("inf")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class State:
    """A set of open walks: the last token, the place in the tree of tokens, and the tokens not given yet. The last walk
    stands at the border that ends here."""

    __slots__ = ("walks", "moves")

    def __init__(self, walks: tuple[tuple[int, int, tuple[int, ...]], ...]):
        self.walks = walks
        self.moves: dict[int, tuple[tuple[int, ...], State] | None] = {}


class Transducer:
    """Tokens of pieces of text under the merges that `ranks` stand for."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, states: int = STATES):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.ranks, self.limit = ranks, states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        # the tree of tokens: by place and byte the next place, the token that ends there, and whether any goes on
        places, ends, goes_on = {}, [None], {0}
        for token, rank in ranks.items():
            at = 0
            for byte in token:
                goes_on.add(at)
                step = at << 8 | byte
                at = places.get(step, 0)
                if not at:
                    at = places[step] = len(ends)
                    ends.append(None)
            ends[at] = rank
        self.children: dict[int, tuple[int, int | None, bool]] = {step: (at, ends[at], at in goes_on) for step, at in places.items()}
        self.split = regex.compile(pattern)
        self.known = Pieces(self.pack)
        self.spines: dict[bytes, tuple | None] = {}
        self.states: dict[tuple, State] = {}
        self.borders: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        for state in self.states.values():
            state.moves.clear()  # states refer to each other in circles
        self.states.clear()
        if len(self.borders) > 4 * self.limit:
            self.borders.clear()
        self.start = self.state(((FIRST, 0, ()),))

    def state(self, walks: tuple) -> State:
        found = self.states.get(walks)
        if found is None:
            found = self.states[walks] = State(walks)
        return found

    def merged(self, piece: bytes, whole: bool = True) -> list[bytes]:
        """The merges themselves, lowest rank first and leftmost among equals; used on two tokens at most. With `whole`
        false, the two parts that the last merge put together."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1 + (not whole):
            ranked = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best = min((r for r in ranked if r[0] is not None), default=None)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def edges(self, token: bytes) -> tuple[list[tuple[bytes, float]], list[tuple[bytes, float]]] | None:
        """The parts at the left and at the right edge while a token is merged, smallest first, each with the rank of the
        merge that takes it up; None unless every part has a lower rank than what is made of it."""
        found = self.spines.get(token, 0)
        if found == 0:
            found = None
            if len(token) == 1:
                found = ([(token, ENDS)], [(token, ENDS)])
            elif len(parts := self.merged(token, False)) == 2:
                rank, (left, right) = self.ranks[token], (self.edges(part) for part in parts)
                if left and right and rank > max(self.ranks[part] for part in parts):
                    top = [(token, ENDS)]
                    found = ([*left[0][:-1], (parts[0], rank), *top], [*right[1][:-1], (parts[1], rank), *top])
            self.spines[token] = found
        return found

    def holds(self, last: int, rank: int) -> bool:
        """Whether the border between two tokens stays one; with nothing to the left, whether the token comes out at all.

        Parts at a border merge if that rank is lower than those of the merges that would take them up on either side."""
        right = self.bytes_of[rank]
        after = self.edges(right)
        if last == FIRST:
            kept = after is not None or self.merged(right) == [right]
        else:
            left = self.bytes_of[last]
            before = self.edges(left)
            kept = self.apart(before[1], after[0]) if before and after else self.merged(left + right) == [left, right]
        self.borders[last << 32 | rank] = kept
        return kept

    def apart(self, before: list[tuple[bytes, float]], after: list[tuple[bytes, float]]) -> bool:
        i = j = 0
        while True:
            (a, a_taken), (b, b_taken) = before[i], after[j]
            rank = self.ranks.get(a + b)
            if rank is not None and rank < a_taken and rank <= b_taken:
                return False
            if a_taken == b_taken == ENDS:
                return True
            if a_taken <= b_taken:
                i += 1
            else:
                j += 1

    def read(self, walks: tuple | list, byte: int) -> list:
        """The walks that are open after a byte, with nothing given; the border that ends here comes last."""
        after, border = [], None
        children, borders = self.children.get, self.borders.get
        for last, at, pending in walks:
            found = children(at << 8 | byte)
            if found is not None:
                at, rank, goes_on = found
                if rank is not None and border is None:  # a prefix has one last token, so one border holds here
                    kept = borders(last << 32 | rank)
                    if kept or (kept is None and self.holds(last, rank)):
                        border = (rank, 0, (*pending, rank))
                if goes_on:
                    after.append((last, at, pending))
        after.append(border)
        return after

    def step(self, open_: tuple, byte: int) -> tuple[tuple[int, ...], list]:
        """The tokens that are settled by a byte, and the walks that are open after it."""
        walks = self.read(open_, byte)
        border = walks.pop()
        given = border[2]
        for _, _, pending in walks:
            if pending[: len(given)] != given:
                same = 0
                for ours, theirs in zip(given, pending, strict=False):
                    if ours != theirs:
                        break
                    same += 1
                given = given[:same]
            if not given:
                break
        walks.append(border)
        if given:
            n = len(given)
            walks = [(last, at, pending[n:]) for last, at, pending in walks]
        return given, walks

    def move(self, state: State, byte: int) -> tuple[tuple[int, ...], State]:
        """The transition of the deterministic form."""
        given, walks = self.step(state.walks, byte)
        found = state.moves[byte] = (given, self.state(tuple(walks)))
        return found

    def tokens(self, piece: bytes) -> list[int]:
        """Tokens of one piece. A transition is made into a state when it is taken for the second time, or in a long piece;
        the first time, and from there to the end of the piece, the walks are followed as they are."""
        whole = self.ranks.get(piece)
        if whole is not None or not piece:
            return [whole] if piece else []
        if len(self.states) > self.limit:
            self.reset()
        state, given, long = self.start, [], len(piece) > PIECE_LETTERS
        for n, byte in enumerate(piece[:-1]):
            taken = state.moves.get(byte)
            if taken is None:
                if not long and byte not in state.moves:
                    state.moves[byte] = None
                    return self.followed(state.walks, piece[n:], given)
                taken = self.move(state, byte)
            if taken[0]:
                given += taken[0]
            state = taken[1]
        return self.followed(state.walks, piece[-1:], given)

    def followed(self, walks: tuple | list, rest: bytes, given: list[int]) -> list[int]:
        """The tokens given so far and those of the rest of a piece, from open walks to its end."""
        for byte in rest[:-1]:
            walks = self.read(walks, byte)
        byte = rest[-1]  # the last byte needs no walks after it
        for last, at, pending in walks:
            found = self.children.get(at << 8 | byte)
            if found is not None and (rank := found[1]) is not None:
                kept = self.borders.get(last << 32 | rank)
                if kept or (kept is None and self.holds(last, rank)):
                    return [*given, *pending, rank]
        raise AssertionError("every prefix has a last token")

    def pack(self, piece: str) -> bytes:
        ids = self.tokens(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Tokens of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, map(regex.Match.group, self.split.finditer(text))))


class Pieces(dict):
    """Tokens of the short pieces met of late: those met since the last change of generation, and those of the one before
    that are met again."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, piece: str) -> bytes:
        made = self.older.get(piece)
        if made is None:
            made = self.make(piece)
        if len(piece) <= PIECE_LETTERS:
            if len(self) >= PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = made
        return made


def _spread(*ranges: tuple[int, int, int]) -> dict[int, int]:
    return {byte: then for first, last, then in ranges for byte in range(first, last + 1)}


#: Next state by state and byte, from the table of well-formed sequences in RFC 3629; 0 is between characters.
#: 1 to 3: so many bytes to come; 4 to 7: after E0, ED, F0, F4, whose second bytes are fewer.
UTF8 = (
    _spread(
        (0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2),
        (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7),
    ),
    _spread((0x80, 0xBF, 0)), _spread((0x80, 0xBF, 1)), _spread((0x80, 0xBF, 2)),
    _spread((0xA0, 0xBF, 1)), _spread((0x80, 0x9F, 1)), _spread((0x90, 0xBF, 2)), _spread((0x80, 0x8F, 2)),
)
BROKEN = "�"


class Decoder:
    """Text of tokens that arrive in portions."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {}
        self.held = b""
        # tokens that are whole characters, which is nearly all of them: their steps begin and end between characters
        self.whole = {i: read[0] for i, token in tokens.items() if not (read := self.read(b"", token))[1] and BROKEN not in read[0]}

    @staticmethod
    def read(held: bytes, more: bytes) -> tuple[str, bytes]:
        """The machine over bytes: whole characters of `held + more`, and the bytes of one that has only begun."""
        text, state, begun, at = [], 0, 0, 0
        data = held + more
        while at < len(data):
            then = UTF8[state].get(data[at])
            if then is None:
                text.append(BROKEN)
                at += begun == at  # the byte itself is wrong, or begins the next character
                state, begun = 0, at
                continue
            at, state = at + 1, then
            if state == 0:
                text.append(data[begun:at].decode())
                begun = at
        return "".join(text), data[begun:]

    def feed(self, ids: list[int]) -> str:
        """Characters that are whole once these tokens are in."""
        if not self.held:
            try:
                return "".join(map(self.whole.__getitem__, ids))
            except KeyError:  # a token that begins or ends within a character, or is none
                pass
        text, held = [], self.held
        moves = self.steps.setdefault(held, {})
        for i in ids:
            step = moves.get(i)
            if step is None:
                if i not in self.tokens:
                    raise ValueError(f"no token with the id {i}")
                step = moves[i] = self.read(held, self.tokens[i])
            text.append(step[0])
            if step[1] != held:
                held = step[1]
                moves = self.steps.setdefault(held, {})
        self.held = held
        return "".join(text)

    def close(self) -> str:
        """What is left when no token follows; the decoder can then be used again."""
        left, self.held = self.held, b""
        if len(self.steps) > STATES:
            self.steps.clear()
        return BROKEN if left else ""


@contextmanager
def no_collection() -> Iterator[None]:
    """Without the search for circles of garbage, which would walk through all states again and again; `reset` cuts theirs."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Transducer:
    """One for each worker process."""
    return Transducer(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def _decoder(path: str) -> Decoder:
    return Decoder({rank: token for token, rank in read_ranks(path).items()})


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _with_column(df: DataFrame, into: str, kind: str, fill: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """The rows with one more column, made batch by batch."""
    kept = df.drop(into)
    schema = kept.withColumn(into, F.lit(None).cast(kind)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            made = fill(batch)
            rest = [name for name in batch.schema.names if name != into]
            columns = [batch.column(batch.schema.names.index(name)) for name in rest]
            yield pa.RecordBatch.from_arrays([*columns, made], [*rest, into])

    return df.mapInArrow(run, schema)


def encoded(df: DataFrame, text: str, into: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds the tokens of a text column as binary: little-endian unsigned 32-bit ids, the form that token files have."""
    path, pattern = path or default_ranks(), pattern or default_pattern()

    def fill(batch: pa.RecordBatch) -> pa.Array:
        machine = _encoder(path, pattern)
        texts = batch.column(batch.schema.names.index(text))
        with no_collection():
            return pa.array([machine.encode(t.as_py() or "") for t in texts], pa.binary())

    return _with_column(df, into, "binary", fill)


def decoded(df: DataFrame, ids: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """Adds the text of a column of tokens as `encoded` makes it."""
    path = path or default_ranks()

    def text_of(machine: Decoder, packed: bytes | None) -> str | None:
        return None if packed is None else machine.feed(np.frombuffer(packed, "<u4").tolist()) + machine.close()

    def fill(batch: pa.RecordBatch) -> pa.Array:
        machine = _decoder(path)
        packed = batch.column(batch.schema.names.index(ids))
        return pa.array((text_of(machine, p.as_py()) for p in packed), pa.string())

    return _with_column(df, into, "string", fill)


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Number and digest of every document's tokens, and the digest of the text they decode to."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    tokens = encoded(docs, "text").drop("text")
    return decoded(tokens).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
