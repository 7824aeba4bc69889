"""Nulls, empty, very long, repeated rows, an empty table, clashing columns:
every operator gives one defined result per row."""
import pytest
from pyspark.sql import functions as F

from paperlane.llm import (bpe, decontaminate, language, licenses, linededup, passages, quality, secrets, simhash,
                           toxicity)

from .util import EDGE_ROWS, clashing, docs, rows_of

P = pytest.importorskip("public_tokenizers")


def items(spark):
    return spark.createDataFrame([("i1", "some words"), (None, "twice the"), ("i2", None), ("i3", "")],
                                 "item_id string, text string")


PER_ROW = {
    "toxicity": lambda s, d: toxicity.score_documents(d, toxicity.fit(["vile bad stuff", "nice calm day"], [1, 0])),
    "no model": lambda s, d: toxicity.score_documents(d, None),
    "language": lambda s, d: language.identify(d, language.build({"en": ["some words"], "de": ["manche worte"]})),
    "no languages": lambda s, d: language.identify(d, language.build({})),
    "secrets": lambda s, d: secrets.scan_secrets(d),
    "bpe": lambda s, d: bpe.digests(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN),
    "simhash": lambda s, d: simhash.simhash_groups(d),
    "lines": lambda s, d: linededup.dedup_lines(d),
    "quality": lambda s, d: quality.repetition_coverage(d),
    "decontaminate": lambda s, d: decontaminate.find_contamination(d, items(s)),
    "licenses": lambda s, d: licenses.scan_licenses(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_result_for_each_row(spark, name):
    d = docs(spark, EDGE_ROWS)
    plain = PER_ROW[name](spark, d)
    ids = [r[0] for r in rows_of(plain, "doc_id")]
    assert sorted(ids, key=repr) == sorted((r[0] for r in EDGE_ROWS), key=repr)
    assert not PER_ROW[name](spark, docs(spark, EDGE_ROWS).limit(0)).collect()
    own = [c for c in plain.columns if c not in ("source", "n_chars", "lang")]
    extra = PER_ROW[name](spark, clashing(docs(spark, EDGE_ROWS)))
    assert rows_of(plain, *own) == rows_of(extra, *own)


def test_passages_of_edge_rows(spark):
    d = docs(spark, EDGE_ROWS)
    assert not passages.by_pair(passages.find_passages(d)).collect()
    assert not passages.by_pair(passages.find_passages(clashing(d))).collect()
    assert not passages.find_passages(d.limit(0)).collect()


def test_stated_results(spark):
    d = docs(spark, EDGE_ROWS)
    lang = {r.doc_id: r.lang_pred for r in PER_ROW["language"](spark, d).collect()}
    assert lang[1] == lang[2] == lang[3] == "und" and lang[6] != "und"
    q = {r.doc_id: r for r in PER_ROW["quality"](spark, d).collect()}
    assert q[1].base_failed and not q[1].kept and q[1].n_words == 0
    assert not any(r.score for r in PER_ROW["no model"](spark, d).collect())
    lines = {r.doc_id: r for r in PER_ROW["lines"](spark, d).collect()}
    assert lines[1].n_lines == 1 and lines[1].text == "" and lines[4].text == "twice the same row"
    groups = {r.doc_id: r.component_id for r in PER_ROW["simhash"](spark, d).collect() if r.doc_id}
    assert groups[1] == groups[2] == groups[3] == 1
    hit = {r.doc_id: (r.n_hit, r["items"]) for r in PER_ROW["decontaminate"](spark, d).collect()}
    assert hit[None] in ((2, ["i1"]), (0, [])) and hit[4] == (2, [])
    licence = {r.doc_id: r for r in PER_ROW["licenses"](spark, d).collect()}
    assert licence[2].first_word is None and licence[2].score == 0 and licence[2].labels == ""
    assert q[5].n_words == 30000 and isinstance(d.select(F.max("doc_id")).first()[0], int)
