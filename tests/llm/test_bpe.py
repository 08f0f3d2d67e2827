import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from txgraph.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tools():
    ranks = bpe.parse_ranks(open(PATH, "rb").read())
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return bpe.Encoder(ranks, public_tokenizers.PATTERN), bpe.Decoder(ranks), plain


def test_ids_equal_the_plain_library(tools):
    encoder, decoder, plain = tools
    rng = random.Random(1)
    signs = "aeiouthsné ünß漢字한국어русский𝔘🙂\n\t 0123.,-'s\x1c\x85 "
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 60)))
        ids = encoder.encode(text)
        assert ids.tolist() == plain.encode_ordinary(text)
        assert "".join(decoder.stream(ids, block=3)) == text


def test_long_pieces_and_a_table_that_is_emptied(tools):
    encoder, _, plain = tools
    text = "a" * 3000 + "ab" * 2000 + "é" * 3000 + "aab" * 1000 + "<|endoftext|>"
    assert encoder.encode(text).tolist() == plain.encode_ordinary(text)
    small = bpe.Transducer(encoder.machine.ranks, max_states=20)
    for piece in ("unbelievableness" * 700, "abcabcabd"):
        assert list(small.encode(piece.encode())) == plain.encode_ordinary(piece)


def test_tokens_leave_after_bounded_lookahead(tools):
    machine = tools[0].machine
    longest = max(map(len, machine.token_bytes.values()))
    state = machine.first
    for byte in b"thequickbrownfoxjumpsoverthelazydog" * 20:
        state, _ = state.get(byte) or machine._advance(state, byte)
        assert all(len(pending) <= longest for pending, _ in state.key[1])


@pytest.mark.parametrize("data", [b"\xff\xc3", b"\xf0\x9f\x99", b"\xed\xa0\x80x", b"\xe2\x82\xac\xc3\xa9", b"\xc0\x80\xf5"])
def test_streaming_utf8_in_any_cuts(data):
    data = b"a" + data + "é🙂".encode() + data
    for cut in range(len(data) + 1):
        machine = bpe.Utf8Machine()
        got = machine.push(data[:cut]) + machine.push(data[cut:]) + machine.close()
        assert got == data.decode("utf-8", "replace")
    machine = bpe.Utf8Machine()
    got = "".join(machine.push(bytes([b])) for b in data) + machine.close()
    assert got == data.decode("utf-8", "replace")


def test_frames(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    ids = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    back = bpe.decode(ids, PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((r[0] or 0, r[1] or "") for r in odd_rows)
    told = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    lengths = {r.doc_id: len(r.ids) for r in ids.collect()}
    assert len(told) == len(odd_rows) and all(r.n_tokens == lengths[r.doc_id] for r in told)
    assert bpe.round_trip(docs.where("false"), PATH, public_tokenizers.PATTERN).count() == 0


def test_unknown_byte_raises():
    with pytest.raises(ValueError):
        bpe.Transducer({b"a": 0}).encode(b"b")
    assert np.array(bpe.Transducer({b"a": 0, b"aa": 1}).encode(b"aaa")).tolist() == [1, 0]
