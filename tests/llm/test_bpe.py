from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from helpers import awkward, clashing, empty

from martloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return bpe.read_ranks(file.read())


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def public(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_public_library(ranks, encoder, public):
    pick = random.Random(3)
    letters = "aaaabbcdeéßñ  \n\t'.,!中文字🙂0123the ing"
    parts = [t.decode("utf8", "ignore") for t in ranks]
    for _ in range(4000):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 40)))
        assert encoder.encode(text) == public.encode_ordinary(text)
        text = "".join(pick.choice(parts) for _ in range(pick.randint(1, 6)))
        assert encoder.encode(text) == public.encode_ordinary(text)


@pytest.mark.parametrize("piece", ["a" * 9001, " " * 5000, "é" * 4097, "ha" * 3000, "\n" * 8192])
def test_long_pieces_are_emitted_on_the_way(encoder, public, piece):
    assert encoder.encode(piece) == public.encode_ordinary(piece)


def test_tables_that_start_anew_change_nothing(ranks, public, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    small = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    text = "seldom bright mornings follow the river, and the river answers " * 20
    assert small.encode(text) == public.encode_ordinary(text)


def test_stream_decoding_at_every_cut(ranks):
    data = "aé中🙂z".encode()
    for cut in range(len(data) + 1):
        stream = bpe.Utf8Stream()
        assert stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.close() == "aé中🙂z"
    for bad in (b"\xff", b"\xc3", b"\xe4\xb8x", b"\xed\xa0\x80", b"\xf5a", b"a\x80b", b"\xf0\x9f\x99"):
        stream = bpe.Utf8Stream()
        assert stream.feed(bad) + stream.close() == bad.decode("utf8", "replace")


def test_round_trip_of_awkward_rows(spark, public):
    out = bpe.round_trip(awkward(spark), PATH, public_tokenizers.PATTERN).collect()
    want = []
    for row in awkward(spark).collect():
        ids = public.encode_ordinary(row.text or "")
        want.append((row.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((row.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_encode_then_decode(spark):
    docs = awkward(spark)
    texts = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert sorted(r.text for r in texts.collect()) == sorted(r.text or "" for r in docs.collect())


def test_round_trip_decodes_through_the_stream(spark, monkeypatch):
    """What the stream gives is what is hashed: a stream that loses text is seen."""
    docs = spark.createDataFrame([(1, "é" * 5000 + " 🙂 plain"), (2, "a"), (3, None)], "doc_id long, text string")
    good = {r.doc_id: r.decoded_sha256 for r in bpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()}
    assert good[1] == hashlib.sha256(("é" * 5000 + " 🙂 plain").encode()).hexdigest()

    class Lossy(bpe.Utf8Stream):
        def feed(self, chunk):
            return super().feed(chunk)[1:]

    monkeypatch.setattr(bpe, "Utf8Stream", Lossy)
    bad = {r.doc_id: r.decoded_sha256 for r in bpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()}
    assert bad[1] != good[1] and bad[2] != good[2] and bad[3] == good[3]


def test_round_trip_with_clashing_columns(spark):
    docs = clashing(awkward(spark), "ids", "n_tokens", "ids_sha256", "raw")
    out = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.select("text").collect())
    assert sorted(r.decoded_sha256 for r in out.collect()) == texts
