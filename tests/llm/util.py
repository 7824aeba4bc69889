"""Small inputs of the operator tests."""
import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def docs(spark, rows):
    """Rows of (doc_id, text), or longer ones of ``documents``."""
    full = [(*r, *(None, None, None)[len(r) - 2:]) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 8))) for _ in range(n))


def clashing(df):
    """The same rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    for c in ("score", "fp", "n_words", "n_lines", "row_id", "blob", "hash", "key", "h1", "batch", "lang_pred", "at"):
        df = df.withColumn(c, F.lit("x"))
    return df


EDGE_ROWS = [(1, None), (2, ""), (3, " \n\t \n"), (None, "some words without an id"), (None, None),
             (4, "twice the same row"), (4, "twice the same row"), (5, prose(1, 30000)),
             (6, "é ß 漢字 \U0001f600 ١٢ ñ"), (7, "x" * 5000), (8, "a\nb\n\nc")]


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
