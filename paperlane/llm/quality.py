"""Quality rules by repetition coverage.

Rolling polynomial hashes of several n-gram lengths (numpy, 64 bits over
64-bit word hashes) find the n-grams that a text holds twice or more; the
measure of each length is the number of characters in words that lie inside
such an n-gram, first occurrence included. Lines are measured alike: the
characters of words in lines that equal an earlier line. A text fails when a
measure exceeds its per cent of all word characters.

Everything is local to one document: no shuffle, memory follows the longest
single text.

Defined cases: a null text has no words (as an empty one); repeated rows give
repeated results; null ids stay null; an empty table gives an empty result;
a text without words fails the base rule (fewer than 10 words); extra columns
of the input are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, map_rows, rolling

#: Per cent of word characters that may lie in n-grams (by length) found twice.
#: They fall with the length and lie below what the base rule has cut already
#: (20 % of the words in repeated 5-grams), so that they decide.
NGRAM_LIMITS = {5: 15, 6: 14, 8: 12, 10: 10}
#: Per cent of word characters that may lie in lines equal to an earlier line.
LINE_LIMIT = 30
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
BASE_WINDOW = 5
BASE_LIMIT = 20


def coverage_marks(hashes, n: int):
    """Marks of the words inside n-grams that occur twice or more."""
    import numpy as np

    m = len(hashes) - n + 1
    if m < 2:
        return np.zeros(len(hashes), bool)
    grams = rolling(hashes, n)
    order = np.argsort(grams)
    s = grams[order]
    same = s[1:] == s[:-1]
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[starts] += 1
    edges[starts + n] -= 1
    return np.cumsum(edges)[:-1] > 0


def repetition_coverage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        ngram_limits: dict[int, int] | None = None, line_limit: int = LINE_LIMIT) -> DataFrame:
    """Per row of ``docs``: the base counts, the characters covered by
    repeated n-grams of each length (``dup_chars_<n>``) and by repeated lines
    (``dup_line_chars``), ``base_failed`` and ``kept``."""
    limits = dict(NGRAM_LIMITS if ngram_limits is None else ngram_limits)
    fields = [("doc_id", id_type(docs, id_col)), ("n_words", "long"),
              ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
              ("dup_line_chars", "long")] + [(f"dup_chars_{n}", "long") for n in limits]

    def make():
        import numpy as np
        import xxhash

        first = np.array([c & 0xC0 != 0x80 for c in range(256)])  # bytes that begin a code point
        symbol = np.array([c in SYMBOLS for c in range(256)])
        h64, known = xxhash.xxh64_intdigest, {}

        def chars(data: bytes) -> int:
            return int(first[np.frombuffer(data, np.uint8)].sum())

        def measure(text: bytes):
            words = text.split()  # of bytes: at \x20 and \x09-\x0D only
            if len(known) > 300_000:
                known.clear()
            for w in set(words):
                if w not in known:
                    known[w] = (h64(w), chars(w))
            hashes = np.array([known[w][0] for w in words], np.uint64)
            sizes = np.array([known[w][1] for w in words], np.int64)
            seen, n_dup, dup_chars = set(), 0, 0
            for line in text.split(b"\n"):
                if line in seen:
                    n_dup += 1
                    dup_chars += sum(known[w][1] for w in line.split())
                elif line and not line.isspace():
                    seen.add(line)
            repeat = int(coverage_marks(hashes, BASE_WINDOW).sum())
            return (len(words), int(sizes.sum()), int(symbol[np.frombuffer(text, np.uint8)].sum()), n_dup, repeat,
                    dup_chars, *(int(sizes[coverage_marks(hashes, n)].sum()) for n in limits))

        return measure

    measured = map_rows(id_and_text(docs, id_col, text_col), make, fields)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_LIMIT * F.col("n_words"))
    passed = 100 * F.col("dup_line_chars") <= line_limit * F.col("word_chars")
    for n, most in limits.items():
        passed = passed & (100 * F.col(f"dup_chars_{n}") <= most * F.col("word_chars"))
    return measured.withColumn("base_failed", base).withColumn("kept", ~base & passed)
