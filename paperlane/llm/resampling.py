"""Target-distribution importance resampling over hashed word runs.

An untrained Split pre-tokeniser of the tokenizers library cuts the lowered
text into words with offsets; a feature is the text between the start of one
word and the end of the same or one of the next two, its bucket the crc32 of
its bytes modulo ``buckets``. Corpus and target each give a histogram of
buckets; the smoothed log ratio of the two, floored to thousandths, is a
bucket's gain, a document's weight the sum of its features' gains. Gumbel noise
from a hash of the id turns the highest scores into a draw without replacement
in proportion to the weights.

Separators become single spaces before the split, so the offset pair of a run
spans exactly its words joined by one space.

Scale: texts are cut once; the buckets, two bytes a feature, are written to the
shared folder and read for the histogram and for the weights. A task adds up
its own histogram, so at most ``buckets`` rows a task are shuffled; the driver
sees ``buckets`` numbers. Ranks: rows under an approximate percentile (checked
by a count; all rows if it fails) cannot be drawn; the rest are range
partitioned by score, numbered in order within their partition, and the
partitions' sizes (one row each) give the offsets. No task sorts or counts the
corpus.

Defined cases: a null or empty text has no feature, weight 0 and is never
drawn; a null id counts as empty in the noise and comes last in ties; rows of
equal score and id come in order of their number of features; repeated rows are
documents of their own; invalid UTF-8 is read as U+FFFD; an empty corpus gives
an empty result, an empty target gains from smoothing alone; extra columns of
the input are ignored.
"""
from __future__ import annotations

import math
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_LOWER, arrow_schema, ddl, id_and_text, id_type, map_texts, new_folder, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Features:
    """Buckets of a text's word runs."""

    def __init__(self, longest: int = 3, buckets: int = 10_000):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True).pre_tokenize_str
        self.longest, self.buckets = longest, buckets
        self.kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def of(self, raw: bytes) -> tuple[int, bytes]:
        """Number of words; buckets of all runs as little-endian integers."""
        import numpy as np

        data = b" ".join(raw.translate(ALNUM_LOWER).split())
        text = data.decode(errors="replace")
        if not data:
            return 0, b""
        pieces = self.split(text)
        starts, ends = zip(*[offsets for _, offsets in pieces], strict=True)
        if not text.isascii():
            data = text.encode()
            place = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            place = np.append(place, len(data))
            starts, ends = place[list(starts)].tolist(), place[list(ends)].tolist()
        crc = zlib.crc32
        runs = [crc(data[a:b]) for n in range(self.longest) for a, b in zip(starts, ends[n:], strict=False)]
        return len(pieces), (np.array(runs, np.uint32) % np.uint32(self.buckets)).astype(self.kind).tobytes()


def featured(docs: DataFrame, id_col: str, text_col: str, longest: int, buckets: int) -> DataFrame:
    """``(doc_id, n_words, found)``, written to the shared folder."""
    fields = [("doc_id", id_type(docs, id_col)), ("n_words", "long"), ("found", "binary")]

    def make():
        of = Features(longest, buckets).of
        return lambda texts: tuple(zip(*map(of, texts), strict=True))

    made = map_texts(id_and_text(docs, id_col, text_col), make, fields)
    path = new_folder(docs.sparkSession, "resampling-features")
    made.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def histogram(features: DataFrame, buckets: int) -> list[int]:
    """Features in each bucket."""
    schema = arrow_schema([("bucket", "int"), ("n", "long")])
    kind = Features(1, buckets).kind

    def run(batches):
        import numpy as np

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch.column(0):
                total += np.bincount(np.frombuffer(found.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], schema=schema)

    sums = features.select("found").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for r in sums.collect():  # one row for each bucket
        out[r.bucket] = r.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Thousandths of the smoothed log ratio of target to corpus, by bucket."""
    n, big_s, big_t = len(corpus), sum(corpus), sum(target)
    return [math.floor(1000 * math.log((t + 1) * (big_s + n) / ((s + 1) * (big_t + n))))
            for s, t in zip(corpus, target, strict=True)]


def noise(seed: int) -> Column:
    """Thousandths of a Gumbel variate drawn from the hash of ``seed:doc_id``."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _weighted(features: DataFrame, gain: list[int]) -> DataFrame:
    import numpy as np

    fields = [("doc_id", id_type(features, "doc_id")), ("n_words", "long"), ("n_features", "long"), ("weight", "long")]
    schema, kind = arrow_schema(fields), Features(1, len(gain)).kind
    shared = features.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))  # one number for each bucket

    def run(batches):
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), kind) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(schema.types[0]), batch.column(1), pa.array([len(x) for x in found], pa.int64()),
                 pa.array([int(shared.value[x].sum()) for x in found], pa.int64())], schema=schema)

    return features.mapInArrow(run, ddl(fields))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ...) in a total order, without sorting
    them in one task."""
    fields = [(n, t.replace("bigint", "long")) for n, t in rows.dtypes] + [("part", "int"), ("i", "long")]
    schema = arrow_schema(fields)

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        part, i = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [c.cast(t) for c, t in zip(batch.columns, schema.types, strict=False)]
                + [pa.array([part] * n, pa.int32()), pa.array(np.arange(i + 1, i + n + 1))], schema=schema)
            i += n

    numbered = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, ddl(fields)),
                       "resampling-ranked")
    base, before = [], 0
    for r in sorted(numbered.groupBy("part").count().collect()):  # one row for each partition
        base.append((r["part"], before))
        before += r["count"]
    bases = rows.sparkSession.createDataFrame(base, "part int, base long")
    return numbered.join(F.broadcast(bases), "part").withColumn("rank", F.col("base") + F.col("i")).drop("part", "i", "base")


def resample(docs: DataFrame, target: DataFrame, per_cent: int = 5, least_words: int = 20, seed: int = 42,
             longest: int = 3, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text") -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; rank
    is null where it is not among the drawn ``per_cent`` of those with at
    least ``least_words`` words."""
    corpus = featured(docs, id_col, text_col, longest, buckets)
    # the target's histogram needs no ids
    wanted = featured(target.select(F.lit(0).alias("doc_id"), F.col(target_text_col).alias("text")), "doc_id", "text",
                      longest, buckets)
    gain = gains(histogram(corpus, buckets), histogram(wanted, buckets))
    scored = written(_weighted(corpus, gain).withColumn("score", F.col("weight") + noise(seed)), "resampling-scores")
    able = F.col("n_words") >= least_words
    share = max(0.0, 1 - per_cent / 100 - 0.002)
    n, cut = scored.filter(able).agg(F.count(F.lit(1)), F.percentile_approx("score", share, 10_000)).first()
    draws = per_cent * n // 100
    if cut is None or scored.filter(able & (F.col("score") >= cut)).count() < draws:
        near = able  # the percentile is an estimate; without it every row is ranked
    else:
        near = able & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    slim = ["doc_id", "n_features", "weight", "score"]
    first = ranked(scored.filter(near).select(*slim), order)
    rank = F.when(F.col("rank") <= draws, F.col("rank"))
    rest = scored.filter(~near).select(*slim, F.lit(None).cast("long").alias("rank"))
    return first.select(*slim, rank.alias("rank")).unionByName(rest)
