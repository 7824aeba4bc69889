"""Token ids as ORC files in ascending document order.

Texts are ordered by id (range partitions, sorted inside), encoded there and
written as ORC: one file for each partition, ids as an integer list column
(ORC's run-length encoding), a row index and a Bloom filter on the document id.
Each row carries its file's number and the tokens before it in that file; the
manifest, written last, has one row for each file with the tokens before the
file, so a document's place in the whole corpus is a sum of two numbers and no
task counts over the corpus. A folder without a manifest is an unfinished
write: readers refuse it, a new write replaces it.

Readers: :func:`read_tokens` reads every file, in parallel by stripes (Spark
cuts files at stripe borders); :func:`lookup` opens only files whose id range
holds a wanted id and pushes the ids into the ORC scan (stripe statistics, row
index, Bloom filter); :func:`read_span` reads a range of token places.

Encoding: the tokenizers library's own model encodes each distinct pre-token
once; pre-tokens come from the tokenizer's pattern. A worker keeps a bounded
table of those seen lately, from task to task. Strings of special tokens in a
text are ordinary text.

Scale: one shuffle, of the texts; the sort within a partition spills. Range
borders are those of (id, text hash), so many rows of one id, or without an
id, spread over partitions. The manifest's rows are files, not documents; it is
what the driver sees and what is broadcast.

Defined cases: a null or empty text has the end id alone; rows without an id
come first; rows of the same id are ordered by their text's hash, then by the
text, and equal rows stand side by side; invalid UTF-8 is read as U+FFFD; an
empty table gives a manifest without rows and no documents; extra columns of
the input are ignored.
"""
from __future__ import annotations

import zlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_characters, latin_form
from .common import arrow_schema, ddl, id_and_text, id_type, slices

#: Entries of a worker's table of pre-tokens, about 180 bytes each; it holds twice as many at most.
KNOWN = 700_000
#: Pre-tokens of more bytes than this aren't put into the table of seen ones.
KNOWN_BYTES = 64

#: What the ORC writer is told: stripes are what a reader splits a file into,
#: the row index has an entry for each ``stride`` rows.
LAYOUT = {"orc.stripe.size": str(32 << 20), "orc.create.index": "true", "orc.row.index.stride": "1000",
          "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd"}


class Encoder(dict):
    """Little-endian 32-bit ids of texts with a tokenizers byte-level BPE; as a
    dict, the ids of pre-tokens seen. What has not been used for
    :data:`KNOWN` new entries is dropped."""

    def __init__(self, definition: str, pattern: str):
        import re

        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenize = Tokenizer.from_str(definition).model.tokenize
        self.find = regex.compile(pattern).findall
        latin = latin_form(pattern)
        self.latin = latin and re.compile(latin).findall
        self.simple = re.compile("[\x00-ɏ]*").fullmatch
        self.to_chars = dict(enumerate(byte_characters()))
        self.older: dict[str, bytes] = {}

    def __missing__(self, pre: str) -> bytes:
        ids = self.older.get(pre)
        if ids is None:
            made = self.tokenize(pre.encode().decode("latin-1").translate(self.to_chars))
            ids = b"".join([t.id.to_bytes(4, "little") for t in made])
        if len(pre) <= KNOWN_BYTES:
            self[pre] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if len(self) > KNOWN:
            self.older = dict(self)
            self.clear()
        pre = (self.latin if self.latin and self.simple(text) else self.find)(text)
        return b"".join(map(self.__getitem__, pre))


def _encoded(ordered: DataFrame, definition: str, pattern: str, end_id: int | None) -> DataFrame:
    """Rows of the files from ``(doc_id, text)`` in order within partitions."""
    fields = [("part", "int"), ("at", "long"), ("doc_id", id_type(ordered, "doc_id")), ("n_tokens", "long"),
              ("ids", "array<int>")]
    schema = arrow_schema(fields)
    # bounded by the vocabulary; a worker keeps its copy, and so the encoder put into it, from task to task
    shared = ordered.sparkSession.sparkContext.broadcast({"definition": definition})
    end = b"" if end_id is None else end_id.to_bytes(4, "little")

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        part, at, kept = TaskContext.get().partitionId(), 0, shared.value
        if "encoder" not in kept:
            kept["encoder"] = Encoder(kept["definition"], pattern)
        encode = kept["encoder"].encode
        for batch in batches:
            texts = batch.column("text")
            for i, j in slices(pc.binary_length(texts).to_pylist()):
                made = [encode(t.decode(errors="replace")) + end for t in texts.slice(i, j - i).to_pylist()]
                ends = np.cumsum([0, *map(len, made)]) // 4
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(made))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (j - i), pa.int32()), pa.array(at + ends[:-1]),
                     batch.column("doc_id").slice(i, j - i).cast(schema.field("doc_id").type), pa.array(np.diff(ends)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
                     .cast(schema.field("ids").type)], schema=schema)
                at += int(ends[-1])

    return ordered.mapInArrow(run, ddl(fields))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text", layout: dict | None = None) -> None:
    """Write the token ids of every whole text under ``path``. ``tokenizer`` is
    a tokenizers definition file of a byte-level BPE, read by the driver,
    ``pattern`` the pattern of its pre-tokens; ``end_id`` ends each document."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    made = _encoded(ordered.select("doc_id", "text"), definition, pattern, end_id)
    made.write.options(**{**LAYOUT, **(layout or {})}).mode("overwrite").orc(f"{path}/data")
    files = (spark.read.schema(made.schema).orc(f"{path}/data")
             .groupBy("part", F.col("_metadata.file_name").alias("file"))
             .agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"),
                  F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
                  F.coalesce(F.bool_or(F.col("doc_id").isNull()), F.lit(False)).alias("without_id")))
    rows, base = [], 0
    for r in sorted(files.collect(), key=lambda r: r.part):  # one row for each file
        rows.append((*r, base))
        base += r.tokens
    kind = dict(made.dtypes)["doc_id"]
    spark.createDataFrame(rows, f"part int, file string, docs long, tokens long, first_id {kind}, last_id {kind}, "
                                "without_id boolean, base long").coalesce(1).write.mode("overwrite").orc(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file; fails where a write has not come to its end."""
    return spark.read.orc(f"{path}/manifest")


def _read(spark: SparkSession, path: str, files: DataFrame, names: list[str] | None = None) -> DataFrame:
    kind = dict(files.dtypes)["first_id"]
    schema = f"part int, at long, doc_id {kind}, n_tokens long, ids array<int>"
    reader = spark.read.schema(schema)
    if names is not None and not names:
        return spark.createDataFrame([], schema).withColumn("start", F.col("at"))
    data = reader.orc(f"{path}/data" if names is None else [f"{path}/data/{n}" for n in names])
    bases = F.broadcast(files.select("part", "base"))  # one row for each file
    return data.join(bases, "part").withColumn("start", F.col("base") + F.col("at")).drop("base")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document."""
    return _read(spark, path, manifest(spark, path)).select("doc_id", "start", "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, wanted: list) -> DataFrame:
    """As :func:`read_tokens`, of the documents with the ``wanted`` ids."""
    files, wanted = manifest(spark, path), sorted(set(wanted))
    hit = F.exists(F.array(*map(F.lit, wanted)), lambda w: (F.col("first_id") <= w) & (w <= F.col("last_id"))) if wanted else F.lit(False)
    names = [r.file for r in files.filter(hit).select("file").collect()]
    return (_read(spark, path, files, names).filter(F.col("doc_id").isin(wanted))
            .select("doc_id", "start", "n_tokens", "ids"))


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of the pieces of documents that make
    up the tokens ``start`` to ``stop`` (end exclusive) of the corpus."""
    files = manifest(spark, path)
    names = [r.file for r in files.filter((F.col("base") < stop) & (F.col("base") + F.col("tokens") > start))
             .select("file").collect()]
    found = _read(spark, path, files, names).filter((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    first = F.greatest(F.col("start"), F.lit(start))
    n = F.least(F.col("start") + F.col("n_tokens"), F.lit(stop)) - first
    return found.select("doc_id", first.alias("start"), n.alias("n_tokens"),
                        F.slice("ids", (first - F.col("start") + 1).cast("int"), n.cast("int")).alias("ids"))


def checksums(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of rows of :func:`read_tokens`:
    the crc32 of the ids as little-endian 32-bit integers."""
    fields = [("doc_id", id_type(tokens, "doc_id")), ("start", "long"), ("n_tokens", "long"), ("ids_crc32", "long")]
    schema = arrow_schema(fields)

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            columns = [batch.column(n).cast(schema.field(n).type) for n in ("doc_id", "start")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(ends[1:] - ends[:-1], pa.int64()), pa.array(crcs, pa.int64())], schema=schema)

    return tokens.select("doc_id", "start", "ids").mapInArrow(run, ddl(fields))
