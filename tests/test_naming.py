"""Naming rules: the reference's own cases, extra edge cases, and a property
test against a plain-Python restatement of POSIX path rules."""
from pathlib import PurePosixPath
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paperlane.functions import naming as nm
from tests.conftest import one_col

TRANSLATED = [
    ("invoice.pdf", "invoice_en.pdf", "invoice_en.json"),
    ("invoice.PDF", "invoice_en.PDF", "invoice_en.json"),
    ("sub/invoice.pdf", "sub/invoice_en.pdf", "sub/invoice_en.json"),
    ("a/b/c/doc.docx", "a/b/c/doc_en.docx", "a/b/c/doc_en.json"),
    ("no-ext", "no-ext_en", "no-ext_en.json"),
    ("file.name.with.dots.pdf", "file.name.with.dots_en.pdf", "file.name.with.dots_en.json"),
    ("invoice_tr.pdf", "invoice_en.pdf", "invoice_en.json"),
]
SOURCE_LANG = [
    ("invoice_tr.pdf", "tr"), ("invoice_zh.pdf", "zh"), ("invoice_JA.pdf", "ja"),
    ("demo-invoice-20tax-7_fr.pdf", "fr"), ("sub/folder/doc_de.docx", "de"), ("invoice.pdf", None),
    ("invoice_abc.pdf", None), ("invoice_1x.pdf", None), ("invoice_t.pdf", None), ("no-ext", None),
    ("invoice_en.pdf", "en"),
]


def _eval(spark, values, fn):
    df = one_col(spark, values)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_translated_and_json_names(spark):
    names = [t[0] for t in TRANSLATED]
    assert _eval(spark, names, nm.translated_blob_name) == [t[1] for t in TRANSLATED]
    assert _eval(spark, names, nm.json_blob_name) == [t[2] for t in TRANSLATED]


def test_source_lang(spark):
    assert _eval(spark, [s[0] for s in SOURCE_LANG], nm.extract_source_lang) == [s[1] for s in SOURCE_LANG]


def test_raw_invoice_name(spark):
    df = spark.createDataFrame([("invoice.pdf", "tr"), ("invoice_de.pdf", "tr")], "n string, l string")
    out = [r[0] for r in df.select(nm.raw_invoice_blob_name("n", "l")).collect()]
    assert out == ["invoice_tr.pdf", "invoice_tr.pdf"]


def test_ocr_names(spark):
    df = one_col(spark, ["dir/My Invoice-1.pdf"])
    r = df.select(nm.ocr_output_name("v", True).alias("e"), nm.ocr_output_name("v", False).alias("n"),
                  nm.strip_ocr_suffix(F.lit("X_Enhanced_OCR.pdf")).alias("s")).first()
    assert (r.e, r.n, r.s) == ("My_Invoice_1_enhanced_ocr.pdf", "My_Invoice_1_ocr.pdf", "x")


def test_mime_lookup_and_normalize(spark):
    df = one_col(spark, ["a.PDF", "b.tif", "c.png", "d"])
    att = [r[0] for r in df.select(nm.content_type_for("v", "attachment")).collect()]
    doc = [r[0] for r in df.select(nm.content_type_for("v", "document")).collect()]
    assert att == ["application/pdf", "image/tiff", "application/octet-stream", "application/octet-stream"]
    assert doc[2] == "image/png"
    m = one_col(spark, ["Application/PDF; name=x", None, "  image/PNG  "])
    assert [r[0] for r in m.select(nm.normalize_mime("v")).collect()] == ["application/pdf", "", "image/png"]


# --- property test: Spark expressions vs POSIX path rules written in Python ---
def py_parts(name: str):
    p = PurePosixPath(name)
    base = p.name
    i = base.rfind(".")
    suffix = base[i:] if 0 < i < len(base) - 1 else ""
    stem = base[: len(base) - len(suffix)]
    lang = re.search(r"_([a-zA-Z]{2})$", stem)
    return base, stem, suffix.lower(), (lang.group(1).lower() if lang else None)


EXTRA = [".hidden", "x.", "a_tr_de.pdf", "_tr.pdf", "a..pdf", "sub.dir/noext", "a//b.pdf", "./a.pdf", "a/b/",
         "émoji_😀_fr.pdf", "a/./b_es.txt"]


@pytest.mark.parametrize("name", EXTRA)
def test_extra_cases(spark, name):
    df = one_col(spark, [name])
    stem, suffix = nm.stem_and_suffix(F.col("v"))
    r = df.select(nm.base_name("v"), stem, suffix, nm.extract_source_lang("v")).first()
    assert tuple(r) == py_parts(name)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab._-/ XY1", min_size=1, max_size=12), min_size=1, max_size=40))
def test_property_path_parts(spark, names):
    names = [n for n in names if n.strip("/") and not n.startswith("/")]
    if not names:
        return
    df = one_col(spark, names)
    stem, suffix = nm.stem_and_suffix(F.col("v"))
    got = [tuple(r) for r in df.select(nm.base_name("v"), stem, suffix, nm.extract_source_lang("v")).collect()]
    exp = [py_parts(n) for n in names]
    # POSIX path objects also drop '.' components in the middle and at the end
    for n, g, e in zip(names, got, exp):
        if n.endswith("/.") or n == "." or n.endswith("/..") or "/./" in n or n.startswith("./"):
            continue
        assert g == e, n


def py_names(name: str):
    p = PurePosixPath(name)
    base, stem, suffix_lower, _ = py_parts(name)
    suffix = base[len(stem):]
    clean = re.sub(r"_([a-zA-Z]{2})$", "", stem)
    parent = "" if str(p.parent) == "." else str(p.parent) + "/"
    norm = lambda s: s.replace(" ", "_").replace("-", "_")
    return (parent + clean + "_en" + suffix, parent + clean + "_en.json", parent + clean + "_xx" + suffix,
            norm(name), re.sub(r"(_enhanced)?_ocr$", "", stem.lower()), norm(stem + "_enhanced_ocr.pdf"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab._-/ XY1", min_size=1, max_size=12), min_size=1, max_size=40))
def test_property_derived_names(spark, names):
    names = [n for n in names if n.strip("/") and not n.startswith("/") and PurePosixPath(n).name
             and "/./" not in n and not n.startswith("./") and not n.endswith("/.") and ".." not in n.split("/")
             and n != "."]
    if not names:
        return
    df = one_col(spark, names)
    got = [tuple(r) for r in df.select(
        nm.translated_blob_name("v"), nm.json_blob_name("v"), nm.raw_invoice_blob_name("v", F.lit("xx")),
        nm.normalize_blob_name("v"), nm.strip_ocr_suffix("v"), nm.ocr_output_name("v", True)).collect()]
    for n, g in zip(names, got):
        assert g == py_names(n), n
