"""Token files against the tokenizers library, ORC's own metadata and slices."""
import glob
import random
import struct
import tempfile
import zlib

import pytest
from pyspark.sql import functions as F

from paperlane.llm import tokenfiles
from paperlane.llm.queries import op11_token_files

from .util import EDGE_ROWS, clashing, docs, prose, rows_of

P = pytest.importorskip("public_tokenizers")
FILE, SF = P.path("byte_bpe_50k.json"), "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def store(spark, df, **layout):
    path = tempfile.mkdtemp(prefix="token-files-")
    tokenfiles.write_tokens(df, path, FILE, P.PATTERN, end_id=2, layout=layout)
    return path


def brute(rows, library):
    at, out = 0, []
    for i, text in rows:
        ids = library(text)
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_query_equals_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = op11_token_files(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == brute(rows, library)


def test_ids_equal_the_library_on_any_text(library):
    with open(FILE, encoding="utf-8") as f:
        own = tokenfiles.Encoder(f.read(), P.PATTERN)
    r = random.Random(5)
    pools = [(0x20, 0x7F), (0, 0x250), (0x370, 0x600), (0x2000, 0x2100), (0x4E00, 0x4F00), (0x1F300, 0x1F700)]
    texts = ["", " ", "\n\n", "don't we'll I'M  x", "a" * 3000, " " * 500 + "b", "<|endoftext|> x", prose(2, 2000)]
    for _ in range(500):
        pool = r.sample(pools, 2)
        texts.append("".join(r.choice([" ", "'", "\t", "\x85", chr(r.randrange(*r.choice(pool)))])
                             for _ in range(r.randrange(60))))
    assert [list(struct.unpack(f"<{len(b) // 4}I", b)) + [2] for b in map(own.encode, texts)] == [library(t) for t in texts]


def test_a_full_table_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "KNOWN", 50)
    with open(FILE, encoding="utf-8") as f:
        own = tokenfiles.Encoder(f.read(), P.PATTERN)
    for i in range(40):
        text = prose(i % 11, 60)
        assert own.encode(text) + struct.pack("<I", 2) == struct.pack(f"<{len(library(text))}I", *library(text))
    assert len(own) <= 50 + 60 and len(own.older) <= 50 + 60


def test_edge_rows(spark, library):
    path = store(spark, docs(spark, EDGE_ROWS))
    got = tokenfiles.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    assert sorted((r.doc_id or 0, r.ids) for r in got) == sorted((i or 0, library(t)) for i, t in EDGE_ROWS)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    extra = store(spark, clashing(docs(spark, EDGE_ROWS)))
    assert rows_of(tokenfiles.read_tokens(spark, extra), "doc_id", "start", "ids") == rows_of(
        tokenfiles.read_tokens(spark, path), "doc_id", "start", "ids")
    none = store(spark, docs(spark, EDGE_ROWS).limit(0))
    assert not tokenfiles.checksums(tokenfiles.read_tokens(spark, none)).collect()
    assert not tokenfiles.lookup(spark, none, [1]).collect()


def test_string_ids_and_bytes_that_are_no_text(spark):
    df = spark.sql("SELECT * FROM VALUES ('b', x'41FF'), ('a', x'41'), (null, x'') AS t(doc_id, raw)").select(
        "doc_id", F.col("raw").cast("string").alias("text"))
    got = tokenfiles.read_tokens(spark, store(spark, df)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, "a", "b"] and got[2].n_tokens > got[1].n_tokens


def test_files_are_in_order_and_have_stripes_indexes_and_filters(spark):
    from pyarrow import orc

    rows = [(i, prose(i % 7, 40)) for i in range(6000)]
    path = store(spark, docs(spark, rows), **{"orc.stripe.size": "65536"})
    files = tokenfiles.manifest(spark, path).orderBy("part").collect()
    assert sum(f.docs for f in files) == 6000
    assert all(a.last_id < b.first_id and a.base + a.tokens == b.base for a, b in zip(files, files[1:], strict=False))
    made = [orc.ORCFile(f) for f in glob.glob(f"{path}/data/*.orc")]
    assert any(f.nstripes > 1 for f in made) and all(f.row_index_stride == 1000 for f in made)


def scanned(df):
    """Rows that the scans of ``df`` hand on, from the plan's own counts."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        if "Scan orc" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return total


def test_lookup_reads_only_what_its_ids_need(spark):
    rows = [(2 * i, prose(i % 7, 12)) for i in range(20000)]
    path = store(spark, docs(spark, rows))
    found = tokenfiles.lookup(spark, path, [4000, 4001])
    assert "PushedFilters" in found._jdf.queryExecution().toString()
    every = {r.doc_id: (r.start, r.ids) for r in tokenfiles.read_tokens(spark, path).collect()}
    assert [(r.doc_id, r.start, r.ids) for r in found.collect()] == [(4000, *every[4000])]
    files = tokenfiles.manifest(spark, path).count()
    assert scanned(tokenfiles.lookup(spark, path, [4000])) <= 2000 + 2 * files < 20000
    assert scanned(tokenfiles.lookup(spark, path, [4001])) <= 2 * files  # Bloom filter: no row group


def test_a_span_of_tokens(spark):
    path = store(spark, docs(spark, [(i, prose(i, 30)) for i in range(50)]))
    every = [t for r in tokenfiles.read_tokens(spark, path).orderBy("start").collect() for t in r.ids]
    for a, b in ((0, 7), (100, 1000), (len(every) - 5, len(every) + 50), (10, 10)):
        got = tokenfiles.read_span(spark, path, a, b).orderBy("start").collect()
        assert [t for r in got for t in r.ids] == every[a:b]


def test_an_unfinished_write_is_refused_and_replaced(spark):
    path = tempfile.mkdtemp(prefix="token-files-")
    spark.range(3).write.orc(f"{path}/data")  # what a lost driver leaves
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tokenfiles.read_tokens(spark, path)
    tokenfiles.write_tokens(docs(spark, [(1, "x")]), path, FILE, P.PATTERN)
    assert [r.n_tokens for r in tokenfiles.read_tokens(spark, path).collect()] == [1]
