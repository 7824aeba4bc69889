"""Importance resampling against plain Python over whole texts."""
import hashlib
import math
import re
import zlib
from collections import Counter

from paperlane.llm import resampling
from paperlane.llm.queries import op13_importance_resampling

from .util import EDGE_ROWS, clashing, docs, prose, rows_of

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}


def features(text, buckets):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def brute(rows, target, buckets=10_000, per_cent=5, least=20):
    made = [(i, *features(t, buckets)) for i, t in rows]
    s = Counter(b for _, _, f in made for b in f)
    t = Counter(b for x in target for b in features(x, buckets)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
            for b in range(buckets)]
    out = []
    for i, n, f in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for rank, r in enumerate(able[:per_cent * len(able) // 100], 1):
        r[5] = rank
    return sorted(((r[0], *r[2:]) for r in out), key=repr)


COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


def test_query_over_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = rows_of(op13_importance_resampling(spark, SF), *COLUMNS)
    assert got == brute(rows, target) and sum(r[4] is not None for r in got) > 3


def test_edge_rows(spark):
    target = spark.createDataFrame([(None,), (prose(1, 50),), ("É ß",)], "text string")
    for per_cent in (5, 60, 100, 0):
        got = resampling.resample(docs(spark, EDGE_ROWS), target, per_cent=per_cent, least_words=1)
        want = brute(EDGE_ROWS, [r.text for r in target.collect()], per_cent=per_cent, least=1)
        assert rows_of(got, *COLUMNS) == want
    extra = resampling.resample(clashing(docs(spark, EDGE_ROWS)), target, per_cent=0, least_words=1)
    assert rows_of(extra, *COLUMNS) == want
    assert not resampling.resample(docs(spark, EDGE_ROWS).limit(0), target).collect()
    alone = resampling.resample(docs(spark, EDGE_ROWS), target.limit(0))
    assert rows_of(alone, *COLUMNS) == brute(EDGE_ROWS, [])


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i % 40, prose(i % 3, 25)) for i in range(400)]
    target = [prose(1, 25)]
    got = resampling.resample(docs(spark, rows), spark.createDataFrame([(x,) for x in target], "text string"), per_cent=30)
    assert rows_of(got, *COLUMNS) == brute(rows, target, per_cent=30)


def test_windows_span_single_spaces(spark):
    own = resampling.Features()
    for text in ("A  b--c\n\nÉÀ d\x7fe'f 漢字 x1", "", "...", "one", prose(3, 400) + " é " + prose(4, 10)):
        n, found = own.of(text.encode())
        want = features(text, 10_000)
        assert n == want[0] and [int.from_bytes(found[i:i + 2], "little") for i in range(0, len(found), 2)] == want[1]


def test_many_buckets(spark):
    rows = [(i, prose(i, 30)) for i in range(60)]
    df = spark.createDataFrame([(prose(1, 25),)], "text string")
    got = resampling.resample(docs(spark, rows), df, buckets=100_000, per_cent=50)
    assert rows_of(got, *COLUMNS) == brute(rows, [prose(1, 25)], buckets=100_000, per_cent=50)
