"""Line dedup with levelled sorted runs of line hashes.

Documents come in batches of ascending ids. A batch's keys (128-bit hashes of
trimmed, lower-cased lines) are reduced to one row for each key, anti-joined
with the runs so far and written as a new run of level 0, sorted by key: the
id that first held a key keeps it. When a level holds ``fanout`` runs these are
merged into one sorted run of the next level. At last the runs say for each
key who keeps it; every other document loses the lines with that key.

The runs are a store: each change is committed by a small file that names the
present runs, so that a store opened again (by another process, for the next
delivery of documents) goes on after its last commit, and what an addition that
was cut off has left counts for nothing. One writer at a time.

Scale: a key and an id travel, not the line; a hot key is one row for each map
task before the shuffle (partial aggregate). The join that tells documents
their lost keys has one row for each key on the runs' side, so Spark may split
a hot key's other side (AQE). What a row has lost is gathered by its id and a
hash of its text, so a group is bounded by the lines of one text, however many
rows have no id, or the same. Stage table and runs are Parquet in the shared
folder; a lost executor re-reads them. (Each anti-join deals and sorts both
sides anew: a plain Parquet folder tells Spark nothing of its order.)

Defined cases: a null or empty text is one empty line; a line under
``min_chars`` code points stays; ids are of any type with an order; repeated
rows and rows with the same id are one document and keep the same lines; rows
with a null id come last, lose what a document with an id holds and nothing to
each other; invalid UTF-8 is read as U+FFFD where a text loses a line; an empty
table gives an empty result; an input column named like an added one
(``n_lines``, ``n_dropped``) gives way, other extra columns stay.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlane.sources.files import Folder

from .common import flat_rows, id_and_text, id_type, new_folder

BLANK = b" \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, None where it is too short to be compared."""
    key = line.strip(BLANK).lower()  # of bytes: A-Z only
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode(errors="replace")) < min_chars:
        return None
    return key


def hash_pair(key: bytes) -> tuple[int, int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(key)
    return (h >> 64) - (1 << 63), (h & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


class Runs:
    """Sorted runs of ``(h1, h2, keeper)`` by level; no key is in two runs."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 3):
        self.spark, self.folder, self.fanout, self.files = spark, folder.rstrip("/"), fanout, Folder(spark, folder)
        self.levels: list[list[str]] = [[]]
        for name in reversed(self.files.names("commits")):
            try:
                self.levels = json.loads(self.files.read(f"commits/{name}"))["levels"]
                break
            except (ValueError, KeyError):
                continue  # cut off while it was written

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"run-{uuid.uuid4().hex}"
        rows.sortWithinPartitions(*KEY).write.parquet(f"{self.folder}/runs/{name}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _paths(self, names: list[str]) -> list[str]:
        return [f"{self.folder}/runs/{n}" for n in names]

    def read(self) -> DataFrame | None:
        names = [n for level in self.levels for n in level]
        return self.spark.read.parquet(*self._paths(names)) if names else None

    def add(self, batch: DataFrame) -> None:
        """``batch``: ``(h1, h2, doc_id)``, ids above those of earlier ones."""
        fresh = batch.groupBy(*KEY).agg(F.min("doc_id").alias("keeper"))
        seen = self.read()
        self._write(fresh if seen is None else fresh.join(seen, KEY, "left_anti"), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self.spark.read.parquet(*self._paths(self.levels[level])).repartition(*KEY)
            self.levels[level] = []
            self._write(merged, level + 1)
            level += 1
        number = 1 + max((int(n.removesuffix(".json")) for n in self.files.names("commits")), default=-1)
        self.files.create(f"commits/{number:08d}.json", json.dumps({"levels": self.levels}))


def batch_borders(ids: DataFrame, batches: int, sample: int = 1000) -> list:
    """Ids, in order, that part the rows into about equal batches: quantiles of
    the ``sample`` ids with the smallest hashes. Where they lie moves no result."""
    rows = (ids.filter("doc_id is not null").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample).collect())
    found = sorted(r["doc_id"] for r in rows)
    return sorted({found[len(found) * i // batches] for i in range(1, batches)}) if found else []


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(doc_id, t, h1, h2)``: each row's distinct line keys; ``t`` a hash of
    its text."""
    import numpy as np

    kind = id_type(docs, id_col)

    def make():
        def keys(doc, text: bytes, t: int):
            found = {k for line in text.split(b"\n") if (k := line_key(line, min_chars)) is not None}
            pairs = np.array([hash_pair(k) for k in found], np.int64).reshape(-1, 2)
            return [doc] * len(pairs), [t] * len(pairs), pairs[:, 0], pairs[:, 1]

        return keys

    rows = id_and_text(docs, id_col, text_col).withColumn("t", F.xxhash64("text"))
    return flat_rows(rows, make, [("doc_id", kind), ("t", "long"), ("h1", "long"), ("h2", "long")])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                batches: int = 4, fanout: int = 3, store: str | None = None) -> DataFrame:
    """``docs`` with ``text_col`` less the lines that another document keeps,
    ``n_lines`` (before) and ``n_dropped``. ``store``: the folder of runs that
    are kept from call to call; lines of earlier deliveries stay with them."""
    spark = docs.sparkSession
    borders = batch_borders(docs.select(F.col(id_col).alias("doc_id")), batches)
    batch = sum((F.coalesce(F.col("doc_id") > b, F.lit(True)).cast("int") for b in borders), F.lit(0))
    folder = new_folder(spark, "line-dedup")
    line_hashes(docs, id_col, text_col, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(
        f"{folder}/keys")
    keys = spark.read.schema(f"doc_id {dict(docs.dtypes)[id_col]}, t long, h1 long, h2 long, batch int").parquet(f"{folder}/keys")
    runs = Runs(spark, store or f"{folder}/store", fanout)
    for i in range(len(borders) + 1):
        runs.add(keys.filter(F.col("batch") == i).drop("batch"))
    lost = (keys.drop("batch").join(runs.read(), KEY)
            .filter(F.col("keeper").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("doc_id").alias("__id"), F.col("t").alias("__t"))
            .agg(F.flatten(F.collect_set(F.array(*KEY))).alias("__lost")))

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def strip(texts, lost_keys):
        import pandas as pd

        rows = []
        for text, lost in zip(texts, lost_keys, strict=True):
            raw = text or b""
            lines = raw.split(b"\n")
            if lost is None:
                rows.append((raw.decode(errors="replace"), len(lines), 0))
                continue
            gone = set(zip(lost[::2].tolist(), lost[1::2].tolist(), strict=True))
            kept = [x for x in lines if (k := line_key(x, min_chars)) is None or hash_pair(k) not in gone]
            rows.append((b"\n".join(kept).decode(errors="replace"), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    numbered = docs.select(*(F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(names)))
    id_name, text_name = (f"__{names.index(c)}" for c in (id_col, text_col))
    raw = F.coalesce(F.col(text_name), F.lit("")).cast("binary")
    same = F.col(id_name).eqNullSafe(F.col("__id")) & (F.xxhash64(raw) == F.col("__t"))
    made = numbered.join(lost, same, "left").withColumn("__made", strip(raw, F.col("__lost")))
    return made.select(*((F.col("__made.text") if f"__{i}" == text_name else F.col(f"__{i}")).alias(c)
                         for i, c in enumerate(names)), "__made.n_lines", "__made.n_dropped")
