"""Benchmark decontamination by winnowing.

Texts become lists of words. Of each sliding window of consecutive k-gram
hashes the smallest (the rightmost of equals) is kept as a fingerprint, with
k-gram and window sized so that any shared run of ``window`` words shares a
fingerprint at the same place. Fingerprints of documents and items are joined;
each hit is extended, word by word, to the left and right, and counts where
the equal run is a whole window. Items shorter than a window have no such
guarantee: of these the whole word list is the window, looked up at every
place of a document.

Scale: documents are read once. A bitmap over the item fingerprints (its size
is fixed by :data:`MOST_BITS`, whatever the benchmark's) goes to the tasks and
lets through the fingerprints that may match, without loss; only those, with
the few words around them, are written and shuffled. Spark splits a hot
fingerprint's side of the join (AQE); its counterpart are item rows. Positions
and items of a document are counted by two-step aggregates.

Defined cases: null texts have no words; items without words have no window;
a document row gets one result row, repeated ids and null ids included; items
whose id is null mark words as hit but are not listed or counted; repeated
items count once by id; an empty documents table gives an empty result, an
empty benchmark no hits; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_LOWER, ARROW_TYPES, ddl, id_and_text, id_type, rolling, word_hashes, written

WINDOW = 10
GRAM = 5
MOST_BITS = 1 << 26


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters a-z, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(ALNUM_LOWER).split()


def winnow(grams, width: int):
    """Places of the fingerprints: of each ``width`` consecutive hashes the
    smallest, the rightmost of equals."""
    import numpy as np

    if len(grams) < width:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, width)[:, ::-1]
    return np.unique(np.arange(len(view)) + (width - 1) - view.argmin(axis=1))


def _marks(text: bytes, known: dict, window: int, gram: int, lengths):
    """(kind, hash, place) arrays: winnowed grams under kind ``window`` and
    all runs of each of ``lengths``; and the words."""
    words = words_of(text)
    hashes = word_hashes(words, known)
    out = []
    if len(words) >= window:
        grams = rolling(hashes, gram)
        at = winnow(grams, window - gram + 1)
        out.append((window, grams[at], at))
    for m in lengths:
        runs = rolling(hashes, m)
        if len(runs):
            out.append((m, runs, None))
    return words, out


_FIELDS = [("kind", "int"), ("hash", "long"), ("at", "int"), ("gram", "string"), ("before", "array<string>"),
           ("after", "array<string>")]


def _row(words: list[bytes], kind: int, h: int, at: int, window: int, gram: int):
    size = gram if kind == window else kind
    near = window - gram if kind == window else 0
    before = [w.decode() for w in words[max(0, at - near):at][::-1]]
    after = [w.decode() for w in words[at + size:at + size + near]]
    return kind, h - (1 << 64) if h >> 63 else h, at, b" ".join(words[at:at + size]).decode(), before, after


def _batches(rows: list, schema):
    import pyarrow as pa

    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)


def item_marks(items: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    import pyarrow as pa

    fields = [("item_id", "string"), *_FIELDS]
    schema = pa.schema([(n, ARROW_TYPES[t]) for n, t in fields])

    def run(batches):
        known: dict = {}
        for batch in batches:
            rows = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                short = [len(words)] if 0 < len(words) < window else []
                _, marks = _marks(text, known, window, gram, short)
                for kind, hashes, at in marks:
                    places = range(len(hashes)) if at is None else at.tolist()
                    rows += [(item, *_row(words, kind, h, p, window, gram))
                             for h, p in zip(hashes.tolist(), places, strict=True)]
            yield _batches(rows, schema)

    texts = id_and_text(items, id_col, text_col)
    return texts.select(F.col("doc_id").cast("string"), "text").mapInArrow(run, ddl(fields)).distinct()


def bitmap(marks: DataFrame, n: int):
    """A bit for each item mark, 16 bits a mark where :data:`MOST_BITS` allow
    it. At most MOST_BITS / 64 rows reach the driver, whatever the benchmark."""
    import numpy as np

    bits = 1 << 16
    while bits < min(16 * n, MOST_BITS):
        bits *= 2
    place = F.col("hash").bitwiseAND(F.lit(bits - 1))
    cells = (marks.select(F.shiftright(place, 6).alias("cell"),
                          F.expr(f"shiftleft(1L, int(hash & {bits - 1}L & 63L))").alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas())
    out = np.zeros(bits // 64, np.int64)
    out[cells["cell"].to_numpy(np.int64)] = cells["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def document_marks(docs: DataFrame, shared, fields, lengths, window: int, gram: int) -> DataFrame:
    """For each row of ``docs`` one row with its word count (kind 0), and its
    marks that the bitmap lets through."""
    import pyarrow as pa

    schema = pa.schema([(n, ARROW_TYPES[t]) for n, t in fields])

    def run(batches):
        import numpy as np

        bits, known = shared.value, {}
        mask = np.uint64(len(bits) * 64 - 1)
        for batch in batches:
            rows = []
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, marks = _marks(text, known, window, gram, lengths)
                rows.append((row, doc, 0, 0, len(words), None, None, None))
                for kind, hashes, at in marks:
                    place = hashes & mask
                    hit = np.flatnonzero(bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1))
                    places = hit if at is None else at[hit]
                    rows += [(row, doc, *_row(words, kind, h, p, window, gram))
                             for h, p in zip(hashes[hit].tolist(), places.tolist(), strict=True)]
                if len(rows) >= 20_000:
                    yield _batches(rows, schema)
                    rows = []
            yield _batches(rows, schema)

    return docs.mapInArrow(run, ddl(fields))


def _equal_lead(a: Column, b: Column) -> Column:
    """How many leading entries of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit`` (words inside a shared
    window), ``items`` (sorted ids of the items with a window in it)."""
    if not 1 <= gram <= window:
        raise ValueError("gram must lie between 1 and window")
    own = written(item_marks(items, item_id_col, item_text_col, window, gram), "benchmark-marks")
    sizes = own.groupBy("kind").count().collect()  # a row for each length up to the window
    lengths = sorted(r["kind"] for r in sizes if r["kind"] < window)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(own, sum(r["count"] for r in sizes)))
    fields = [("row_id", "long"), ("doc_id", id_type(docs, id_col)), *_FIELDS]
    rows = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    marks = written(document_marks(rows, shared, fields, lengths, window, gram), "document-marks")

    other = own.select("item_id", "kind", "hash", "gram", F.col("before").alias("i_before"),
                       F.col("after").alias("i_after")).distinct()
    size = F.when(F.col("kind") == window, gram).otherwise(F.col("kind"))
    hits = (marks.filter("kind > 0").join(other, ["kind", "hash", "gram"])
            .withColumn("left", _equal_lead(F.col("before"), F.col("i_before")))
            .withColumn("right", _equal_lead(F.col("after"), F.col("i_after")))
            .filter((F.col("kind") < window) | (F.col("left") + F.col("right") + gram >= window))
            .select("row_id", "item_id", (F.col("at") - F.col("left")).alias("lo"),
                    (F.col("at") + size + F.col("right") - 1).alias("hi")))
    places = (hits.select("row_id", "lo", "hi").distinct()
              .select("row_id", F.explode(F.sequence("lo", "hi")).alias("word")).distinct()
              .groupBy("row_id").agg(F.count("*").alias("n_hit")))
    found = hits.select("row_id", "item_id").distinct().groupBy("row_id").agg(
        F.sort_array(F.collect_list("item_id")).alias("items"))
    return (marks.filter("kind = 0").select("row_id", "doc_id", F.col("at").cast("long").alias("n_words"))
            .join(places.join(found, "row_id"), "row_id", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
