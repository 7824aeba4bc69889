"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
               "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
               "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}

#: ASCII rules of the query contracts, as byte tables: A-Z to a-z, and any
#: other ASCII that is no letter or digit to a space (bytes from 0x80 stay).
ALNUM_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
                    for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", binary: bool = True) -> DataFrame:
    """``(doc_id, text)`` of ``docs``; null texts become empty. With ``binary``
    the text is its UTF-8 bytes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (text.cast("binary") if binary else text).alias("text"))


def arrow_schema(fields: list[tuple[str, str]]) -> pa.Schema:
    return pa.schema([(n, ARROW_TYPES[t]) for n, t in fields])


def ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields)


def slices(sizes: list[int], most: int = 2_000_000):
    """(start, stop) of consecutive runs of rows of about ``most`` in size."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def map_texts(df: DataFrame, make: Callable[[], Callable], fields: list[tuple[str, str]]) -> DataFrame:
    """One output row per input row ``(id, text, ...)``. ``make()`` runs once
    per task and returns a function from the lists of the columns after the id
    (runs of rows of about two million characters, or one longer text) to one
    list of values for each of the ``fields`` after the id."""
    schema = arrow_schema(fields)

    def run(batches):
        fn = make()
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[1:]]
            for i, j in slices([len(t) for t in cols[0]]):
                made = fn(*(c[i:j] for c in cols))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).cast(schema.types[0])]
                    + [pa.array(v, t) for v, t in zip(made, schema.types[1:], strict=True)], schema=schema)

    return df.mapInArrow(run, ddl(fields))


def map_rows(df: DataFrame, make: Callable[[], Callable], fields: list[tuple[str, str]]) -> DataFrame:
    """As :func:`map_texts`, but ``make()`` returns a function from one row's
    values after the id to the tuple of its new values."""

    def make_many():
        fn = make()
        return lambda *cols: zip(*map(fn, *cols), strict=True)

    return map_texts(df, make_many, fields)


def id_type(df: DataFrame, col: str) -> str:
    return dict(df.dtypes)[col].replace("bigint", "long")


def flat_rows(df: DataFrame, make: Callable[[], Callable], fields: list[tuple[str, str]],
              flush: int = 200_000) -> DataFrame:
    """Zero or more output rows per input row: ``make()`` runs once per task
    and returns a function from a row's values to a tuple of equally long
    columns (lists or numpy arrays). Output leaves in batches of about
    ``flush`` rows, so memory doesn't follow the partition."""
    import numpy as np

    schema = arrow_schema(fields)

    def run(batches):
        fn = make()
        held, n = [], 0

        def out():
            cols = [np.concatenate(p) if isinstance(p[0], np.ndarray) else [x for q in p for x in q]
                    for p in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)],
                                              schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = fn(*row)
                if len(made[0]):
                    held.append(made)
                    n += len(made[0])
                    if n >= flush:
                        yield out()
                        held, n = [], 0
        if held:
            yield out()

    return df.mapInArrow(run, ddl(fields))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of
    the session. Only where neither it nor a checkpoint folder is set (local
    tests) a private one is made."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="paperlane-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, tag: str) -> str:
    return os.path.join(shared_dir(spark), f"{tag}-{uuid.uuid4().hex}")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends there
    and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sha_hex(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()


def word_hashes(words: list[bytes], known: dict, most: int = 300_000):
    """64-bit hashes of words as numpy; ``known`` is the task's table of those
    seen, emptied beyond ``most``."""
    import numpy as np
    import xxhash

    if len(known) > most:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def rolling(hashes, n: int):
    """Hash of each run of ``n`` consecutive entries (none if there are fewer)."""
    import numpy as np

    m = len(hashes) - n + 1
    if m < 1:
        return np.zeros(0, np.uint64)
    out = hashes[:m].copy()
    for j in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out += hashes[j:j + m]
    return out
