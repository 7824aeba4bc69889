import random

import pytest

from paperlane.llm import bpe

from .util import docs, prose

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    own = bpe.Codec(bpe.model_bytes(ranks), P.PATTERN, None)
    return own, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_public_library(reference):
    own, theirs = reference
    r = random.Random(3)
    pools = [(0x20, 0x7F), (0, 0x250), (0x370, 0x600), (0x2000, 0x2100), (0x4E00, 0x4F00), (0x1F300, 0x1F700)]
    texts = ["", " ", "\n\n", "don't we'll I'M  x", "a" * 3000, " " * 500 + "b", "<|endoftext|>", prose(2, 2000)]
    for _ in range(800):
        pool = r.sample(pools, 2)
        texts.append("".join(r.choice([" ", "'", "\t", "\x85", "\x1c", chr(r.randrange(*r.choice(pool)))])
                             for _ in range(r.randrange(60))))
    assert own.encode(texts) == [theirs.encode_ordinary(t) for t in texts]


def test_decoding_returns_the_bytes(reference):
    own, _ = reference
    texts = ["é ß 漢字 \U0001f600", prose(5, 300), "\x00\x01▁ x"]
    assert [own.decode(i) for i in own.encode(texts)] == [t.encode() for t in texts]


def test_every_token_encodes_to_itself(reference):
    own, _ = reference
    chars = bpe.byte_characters()
    tokens = list(own.whole)
    ids = own.sp.encode(["".join(chars[b] for b in t) for t in tokens], num_threads=1)
    assert ids == [[own.whole[t]] for t in tokens]


def test_round_trip_as_dataframes(spark, reference):
    rows = [(1, prose(7, 50)), (2, "né\n"), (3, None), (None, "x")]
    path = P.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(docs(spark, rows), path, P.PATTERN)
    back = {r.doc_id: bytes(r.data).decode() for r in bpe.decode(ids, path).collect()}
    assert back == {i: t or "" for i, t in rows}


def test_ranks_with_gaps():
    ranks = {bytes([b]): 2 * b for b in range(256)} | {b"ab": 600, b"abc": 700}
    own = bpe.Codec(bpe.model_bytes(ranks), r"\S+|\s+", sorted(ranks.values()))
    assert own.encode(["abcab c"]) == [[700, 600, 64, 198]] and own.decode([700, 600, 64, 198]) == b"abcab c"
