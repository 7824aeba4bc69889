"""SimHash near-dedup by covering locality-sensitive hashing.

A document's fingerprint has a bit set where over half of its shingles' 64-bit
hashes have it. Each bit place i gets a non-zero vector m(i) of radius + 1
bits; for each non-zero vector v one table keeps the places where the inner
product of m(i) and v is odd. Any ``radius`` differing places leave some v
that is orthogonal to all their vectors, so two fingerprints within the radius
agree on all places that table keeps: every such pair collides.

A bucket of over :data:`MOST` distinct fingerprints is dealt again, by the
same construction over the places its mask has not kept (half of the rest each
time), until no bucket is larger; no pair is lost, as those places alone can
differ. Within a bucket a breadth-first search with numpy links each
fingerprint to the smallest one it reaches: one link a fingerprint, not one a
pair. Links become components over the whole table.

Scale: exact copies are one fingerprint (partial aggregate); 15 keys of 16
bytes travel for each distinct fingerprint (radius 3), never a text. The
fingerprint table and the links are written to the shared folder.

Defined cases: a text without words (null too) has fingerprint zero and is
linked like any other; rows with one id are separate rows of the result; a row
with a null id takes part in links but names no component (a component of
null ids alone has a null ``component_id``); an empty table gives an empty
result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, map_rows, written
from .components import connected_components

MOST = 4096
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the whole text (unsigned)."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # of bytes: A-Z alone, and white space of ASCII
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    runs = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) > shingle else [words]
    hashes = np.array([h64(x, SEED) for x in map(b" ".join, runs)], "<u8")
    set_in = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes)).view("<u8")[0])


def masks(places: list[int], radius: int) -> list[int]:
    """Covering masks over ``places`` of 64 bits."""
    top = 1 << radius + 1
    vectors = {p: 1 + i % (top - 1) for i, p in enumerate(places)}
    return [sum(1 << p for p in places if (vectors[p] & v).bit_count() % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(rows: DataFrame, refinement: dict[int, list[int]]) -> DataFrame:
    """``(mask, fp)`` to ``(mask, key, fp)``, each mask replaced by its own list."""
    deal = F.create_map(*(x for m, finer in refinement.items()
                          for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(f)) for f in finer)))))
    return (rows.select("fp", F.explode(deal[F.col("mask")]).alias("mask"))
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))


def link_sorted(prints, radius: int):
    """Links ``(fp, smallest fp it reaches)`` among distinct fingerprints of
    one bucket (a numpy array of uint64)."""
    import numpy as np

    rest, links = np.sort(prints), []
    while len(rest):
        root, frontier, rest = rest[0], [rest[0]], rest[1:]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= radius
            if near.any():
                found = rest[near]
                links += [(f, root) for f in found.tolist()]
                frontier += list(found)
                rest = rest[~near]
    return links


def _bucket_links(dealt: DataFrame, radius: int) -> DataFrame:
    """Links within the buckets of ``(mask, key, fp)``, none above MOST."""
    import pyarrow as pa

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        import numpy as np

        held = None

        def close(data):
            """Links of whole buckets, rows sorted by (mask, key)."""
            change = np.flatnonzero((data[0][1:] != data[0][:-1]) | (data[1][1:] != data[1][:-1])) + 1
            starts = np.concatenate([[0], change])
            sizes = np.diff(np.concatenate([starts, [len(data[0])]]))
            prints = data[2].view(np.uint64)
            pairs = starts[sizes == 2]
            x, y = prints[pairs], prints[pairs + 1]
            near = np.bitwise_count(x ^ y) <= radius
            a, b = [np.maximum(x, y)[near].view(np.int64)], [np.minimum(x, y)[near].view(np.int64)]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                links = np.array(link_sorted(prints[s:s + n], radius), np.uint64).reshape(-1, 2).view(np.int64)
                a.append(links[:, 0])
                b.append(links[:, 1])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=schema)

        for batch in batches:
            data = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(data[0]):
                continue
            if held is not None:
                data = [np.concatenate(x) for x in zip(held, data, strict=True)]
            last = (data[0] == data[0][-1]) & (data[1] == data[1][-1])
            cut = int(np.argmax(last))  # the last bucket may go on in the next batch
            held = [x[cut:] for x in data]
            if cut:
                yield close([x[:cut] for x in data])
        if held is not None:
            yield close(held)

    return (dealt.repartition("mask", "key").sortWithinPartitions("mask", "key")
            .mapInArrow(run, "a long, b long").distinct())


def near_links(prints: DataFrame, radius: int, most: int = MOST) -> DataFrame:
    """``(a, b)`` links that join, for distinct ``fp`` of ``prints``, all
    within ``radius`` bits of each other, through steps within the radius."""
    every = list(range(64))
    level = {0: masks(every, radius)}
    dealt = _deal(prints.select(F.lit(0).cast("long").alias("mask"), "fp"), level)
    out = None
    while True:
        sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n"))
        large = written(sizes.filter(F.col("n") > most).select("mask", "key"), "large-buckets")
        if large.isEmpty():
            links = _bucket_links(dealt, radius)
            return links if out is None else out.union(links)
        links = _bucket_links(dealt.join(large, ["mask", "key"], "left_anti"), radius)
        out = links if out is None else out.union(links)
        # masks in use are few (15, 225, ...); each round halves the places left
        used = [r["mask"] % (1 << 64) for r in large.select("mask").distinct().collect()]
        finer = {}
        for m in used:
            left = [p for p in every if not m >> p & 1]
            finer[m] = sorted({m | f for f in masks(left, radius)})
        dealt = _deal(dealt.join(large, ["mask", "key"], "left_semi"), finer).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   radius: int = 3, most: int = MOST) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fp`` (the fingerprint as a signed long)
    and ``component_id``, the smallest id among the rows it is linked to,
    directly or through others."""
    fields = [("doc_id", id_type(docs, id_col)), ("fp", "long")]
    texts = id_and_text(docs, id_col, text_col)
    rows = written(map_rows(texts, lambda: lambda text: (_signed(fingerprint(text, shingle)),), fields), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = connected_components(near_links(classes.select("fp"), radius, most))
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return (rows.join(rooted.select("fp", "root").join(names, "root").drop("root"), "fp", "left")
            .select("doc_id", "fp", "component_id"))
