"""H14-H16 against plain-Python statements of the same rules on random text."""
import re

from hypothesis import given, settings, strategies as st

from paperlane import vocab
from paperlane.functions import text as tx

ALPHABET = "ab 1234567890,. \n😀１２é_"
NUM = re.compile(vocab.NUMBER_PATTERN)


def py_chunks(t, size):
    return [t[i:i + size] for i in range(0, len(t), size)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30), st.integers(1, 7))
def test_chunks_match_python_slicing(spark, texts, size):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(tx.chunk_text("t", size)).collect()]
    assert got == [py_chunks(t, size) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=1, max_size=30))
def test_numbers_match_python_re(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(tx.extract_numbers("t").alias("n"), tx.normalize_numbers(tx.extract_numbers("t")).alias("d")).collect()
    for t, r in zip(texts, rows):
        found = NUM.findall(t)
        assert r.n == found, t
        assert sorted(r.d) == sorted({re.sub(r"[ ,]", "", x) for x in found}), t
