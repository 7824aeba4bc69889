"""Byte-level BPE encoding and decoding on a sentencepiece BPE model.

The model is serialised here, straight from the vocabulary's ranks: every
token's bytes are mapped to 256 printable characters, one for each byte, the
piece's score is its negative rank, normalisation is the identity. A text is
cut into pre-tokens by the tokenizer's pattern; each is mapped to those
characters and encoded by itself, so the merge of the lowest rank comes first
as in the tokenizer's own library. Decoding maps ids back to pieces, pieces to
bytes.

Everything is local to one document: no shuffle. A task holds the model (a
size fixed by the vocabulary) and a table of pre-tokens seen, which is emptied
beyond :data:`KNOWN` entries.

Defined cases: a null text is empty; an empty text has no ids (the hash of the
empty string); repeated rows give repeated results; null ids stay null; an
empty table gives an empty result; extra columns of the input are ignored.
"""
from __future__ import annotations

import base64
import struct
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, id_type, map_texts, sha_hex

KNOWN = 500_000
#: Pre-tokens of more bytes than this aren't put into the table of seen ones.
KNOWN_BYTES = 64

#: A printable character for each byte: the byte's own where that is a visible
#: Latin-1 character, else one from U+0100 on, in order.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_characters() -> list[str]:
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(_VISIBLE) else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece ModelProto of a rank vocabulary. Pieces lie in rank
    order (a piece's id is its place), the unknown piece is last."""
    chars = byte_characters()
    out = bytearray()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = "".join(chars[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _field(2, float(-rank)))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))  # type 2: unknown
    out += _field(2, _field(3, 2) + _field(4, len(ranks) + 1))  # trainer: model type 2 is BPE
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


def latin_form(pattern: str) -> str | None:
    """``pattern`` for Python's quicker ``re``, equal to it on texts that stay
    below U+0250: the Unicode classes are written out. None where the pattern
    holds other Unicode classes."""
    import regex

    def members(c):
        return "".join(regex.escape(x) for x in map(chr, range(0x250)) if regex.match(c, x))

    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    for old, new in ((r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]"), (r"\p{L}", f"[{letters}]"),
                     (r"\p{N}", f"[{numbers}]"), (r"\S", f"[^{spaces}]"), (r"\s", f"[{spaces}]")):
        pattern = pattern.replace(old, new)
    return None if r"\p" in pattern or r"\P" in pattern else pattern


class Codec:
    """Encodes and decodes lists of texts in one process."""

    def __init__(self, model: bytes, pattern: str, ranks: list[int] | None):
        import re

        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        latin = latin_form(pattern)
        self.latin = latin and re.compile(latin).findall
        self.simple = re.compile("[\x00-\u024f]*").fullmatch
        chars = byte_characters()
        self.to_chars = dict(enumerate(chars))
        back = {c: b for b, c in enumerate(chars)}
        n = self.sp.get_piece_size() - 1
        pieces = [bytes(back[c] for c in self.sp.id_to_piece(i)) for i in range(n)]
        self.ranks = ranks
        order = ranks or range(n)
        self.bytes_of = dict(zip(order, pieces, strict=True))
        self.text_of = {i: str(i) for i in order}
        self.whole = dict(zip(pieces, order, strict=True))
        self.known: dict[str, tuple[int, ...]] = {}

    def pre_tokens(self, text: str) -> list[str]:
        return (self.latin if self.latin and self.simple(text) else self.find)(text)

    def _ids(self, pre: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of pre-tokens. One that is a token as a whole is that token."""
        raw = [p.encode() for p in pre]
        mapped = [b.decode("latin-1").translate(self.to_chars) for b in raw]
        made = {}
        for p, b, ids in zip(pre, raw, self.sp.encode(mapped, num_threads=1), strict=True):
            w = self.whole.get(b)
            made[p] = (w,) if w is not None else tuple(ids if self.ranks is None else map(self.ranks.__getitem__, ids))
        return made

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.pre_tokens(t) for t in texts]
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        new = set(chain.from_iterable(cut)).difference(known)
        made = self._ids(list(new))
        known.update(made)
        out = [list(chain.from_iterable(map(known.__getitem__, pre))) for pre in cut]
        for p in new:
            if len(p) > KNOWN_BYTES:
                del known[p]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def ids_text(self, ids) -> str:
        return " ".join(map(self.text_of.__getitem__, ids))


def _shipped(spark: SparkSession, ranks: dict[bytes, int]):
    order = sorted(ranks.values())
    dense = order == list(range(len(order)))
    return spark.sparkContext.broadcast((model_bytes(ranks), None if dense else order))  # bounded by the vocabulary


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the token ids of every whole text. ``vocabulary`` is
    the path of a rank file, read by the driver."""
    shared = _shipped(docs.sparkSession, read_ranks(vocabulary))
    fields = [("doc_id", id_type(docs, id_col)), ("ids", "array<int>")]

    def make():
        codec = Codec(shared.value[0], pattern, shared.value[1])
        return lambda texts: (codec.encode(texts),)

    return map_texts(id_and_text(docs, id_col, text_col, binary=False), make, fields)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, data)``: the bytes that lists of token ids stand for (null
    ids: none)."""
    shared = _shipped(encoded.sparkSession, read_ranks(vocabulary))
    fields = [("doc_id", id_type(encoded, id_col)), ("data", "binary")]

    def make():
        codec = Codec(shared.value[0], "", shared.value[1])
        return lambda lists: ([codec.decode(ids) for ids in lists],)

    ids = F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>"))
    return map_texts(encoded.select(F.col(id_col).alias("doc_id"), ids.alias("ids")), make, fields)


def digests(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Round trip of every whole text in one pass: token count and hashes of
    the ids and of the bytes decoded from those ids."""
    shared = _shipped(docs.sparkSession, read_ranks(vocabulary))
    fields = [("doc_id", id_type(docs, id_col)), ("n_tokens", "long"), ("ids_sha256", "string"),
              ("decoded_sha256", "string")]

    def make():
        codec = Codec(shared.value[0], pattern, shared.value[1])

        def many(texts):
            lists = codec.encode(texts)
            return ([len(x) for x in lists], [sha_hex(codec.ids_text(x).encode()) for x in lists],
                    [sha_hex(codec.decode(x)) for x in lists])

        return many

    return map_texts(id_and_text(docs, id_col, text_col, binary=False), make, fields)
