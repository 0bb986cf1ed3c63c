"""Encoding and decoding against tiktoken, the codec of Python and the merges themselves."""

from __future__ import annotations

import hashlib
import random
import struct
import time

import pytest
import tiktoken
from llm_rows import AWKWARD, doc

from veilstone.llm import bpe

RANKS = bpe.read_ranks(bpe.default_ranks())
ALPHABETS = ("ab", " aA1'", "äßñ字漢🙂é", "abcdefghijklmnopqrstuvwxyz", "\n\t  x", "é‍🙂", "0123456789 .,")


@pytest.fixture(scope="module")
def machine():
    return bpe.Transducer(RANKS, bpe.default_pattern(), states=2_000)


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=RANKS, special_tokens={})


def ids(packed):
    return [i for (i,) in struct.iter_unpack("<I", packed)]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_encodes_like_tiktoken(machine, known, alphabet):
    rng = random.Random(3)
    for n in (0, 1, 2, 5, 17, 90, 700):
        for _ in range(25):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert ids(machine.encode(text)) == known.encode_ordinary(text)


def test_random_ranks_with_irregular_tokens():
    """Vocabularies in which a token may rank below its parts, or never come out of its own bytes."""
    rng = random.Random(5)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        tokens = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(3, 25))}
        ranks |= {token: 256 + i for i, token in enumerate(rng.sample(sorted(tokens), len(tokens)))}
        machine = bpe.Transducer(ranks, r"[a-z]+")
        for _ in range(60):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            want = [ranks[piece]] if piece in ranks else [ranks[part] for part in machine.merged(piece)]
            assert machine.tokens(piece) == want


def test_one_long_piece_takes_time_in_proportion(machine):
    def spent(n):
        begun = time.perf_counter()
        assert machine.tokens(b"ab" * n)
        return time.perf_counter() - begun

    spent(1_000)
    assert spent(200_000) < 40 * max(spent(20_000), 0.005)


def test_decodes_any_bytes_in_any_portions():
    rng = random.Random(7)
    decoder = bpe.Decoder({rank: token for token, rank in RANKS.items()})
    hard = [0x41, 0xC3, 0xA9, 0xE0, 0xA0, 0x80, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xC0, 0xFF, 0xBF, 0xE2]
    for _ in range(3_000):
        data = bytes(rng.choice(hard) for _ in range(rng.randint(0, 14)))
        at = rng.randint(0, len(data))
        tokens = [RANKS[bytes([b])] for b in data]
        assert decoder.feed(tokens[:at]) + decoder.feed(tokens[at:]) + decoder.close() == data.decode("utf-8", "replace")
    with pytest.raises(ValueError):
        decoder.feed([10**6])


def test_query_against_tiktoken(run, known):
    rows = [*AWKWARD, doc(7, "<|endoftext|> it's  1234 字\n\n"), doc(8, "x" * 50_000)]
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run("op11_byte_bpe", documents=rows)}
    want = set()
    for row in rows:
        text = row[1] or ""
        tokens = known.encode_ordinary(text)
        packed = struct.pack(f"<{len(tokens)}I", *tokens)
        want.add((row[0], len(tokens), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == want
    assert len(run("op11_byte_bpe", documents=rows)) == len(rows)
    assert run("op11_byte_bpe") == []


def test_columns_pass_and_clash(spark):
    rows = spark.createDataFrame([(1, "a b", "old"), (None, None, None)], "id int, text string, ids string")
    made = bpe.decoded(bpe.encoded(rows, "text"), into="text")
    assert made.columns == ["id", "ids", "text"]
    assert {(r.id, len(r.ids) // 4, r.text) for r in made.collect()} == {(1, 2, "a b"), (None, 0, "")}
    none = spark.createDataFrame([(None,)], "ids binary")
    assert bpe.decoded(none).first().decoded is None
