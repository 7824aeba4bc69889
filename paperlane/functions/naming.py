"""Blob/file naming as native column expressions.

POSIX path rules: the base name is the part after the last ``/``; the suffix
is the text from the last dot of the base name when that dot is neither its
first nor its last character; the stem is the rest. Names are first
normalised like a POSIX path object does (``//`` collapsed, leading ``./``
and trailing ``/`` dropped).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlane import vocab


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def posix_normalize(path) -> Column:
    """Collapse ``//``, drop leading / inner ``./`` and trailing ``/``.

    The regular expressions run only for names that need them; ordinary names
    pass through a few byte searches.
    """
    p = _c(path)
    needs = p.contains("/") & p.rlike(r"//|^\./|/\./|/$")  # one reference to p keeps nested expressions small
    n = F.regexp_replace(p, "/{2,}", "/")
    n = F.regexp_replace(n, r"^(\./)+", "")
    n = F.regexp_replace(n, r"/(\./)+", "/")
    n = F.regexp_replace(n, "(.)/+$", "$1")
    return F.when(needs, n).otherwise(p)


def _once(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` computed once. A name built of many copies of its
    path makes a generated method that the JVM no longer compiles."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _renamed(path, make: Callable[[Column, Column, Column], Column]) -> Column:
    """``make(dir, clean stem, suffix)`` of a path that is taken apart once."""
    def parts(n: Column) -> Column:
        base = F.substring_index(n, "/", -1)
        return F.struct(n.substr(F.lit(1), F.length(n) - F.length(base)).alias("dir"), base.alias("base"), path_suffix(base).alias("suffix"))

    def made(x: Column) -> Column:
        stem = x["base"].substr(F.lit(1), F.length(x["base"]) - F.length(x["suffix"]))
        return make(x["dir"], F.regexp_replace(stem, vocab.LANG_SUFFIX_PATTERN, ""), x["suffix"])

    return _once(_once(_once(_c(path), posix_normalize), parts), made)


def base_name(path) -> Column:
    """Last path component."""
    return F.substring_index(posix_normalize(path), "/", -1)


def dir_prefix(path) -> Column:
    """Directory part including its trailing ``/`` ('' at top level)."""
    n = posix_normalize(path)
    return n.substr(F.lit(1), F.length(n) - F.length(F.substring_index(n, "/", -1)))


def path_suffix(name) -> Column:
    """Suffix of a base name, original case ('' when none): from the last dot,
    when that dot is neither the first nor the last character."""
    return F.regexp_extract(_c(name), r"^.+(\.[^.]+)$", 1)


def path_stem(name) -> Column:
    """Base name without its suffix."""
    n = _c(name)
    suf = path_suffix(n)
    return n.substr(F.lit(1), F.length(n) - F.length(suf))


def stem_and_suffix(path) -> tuple[Column, Column]:
    """H1: (stem, lower-cased suffix) of a path."""
    b = base_name(path)
    return path_stem(b), F.lower(path_suffix(b))


def extract_source_lang(path) -> Column:
    """H2: two-letter language tail of the stem, lower case, else null."""
    stem = path_stem(base_name(path))
    return F.lower(F.nullif(F.regexp_extract(stem, vocab.LANG_SUFFIX_PATTERN, 1), F.lit("")))


def clean_stem(path) -> Column:
    """H3: the stem with one trailing ``_xx`` language tag removed."""
    return F.regexp_replace(path_stem(base_name(path)), vocab.LANG_SUFFIX_PATTERN, "")


def translated_blob_name(path) -> Column:
    """H4: ``dir/<clean stem>_en<suffix>`` (suffix keeps its case)."""
    return _renamed(path, lambda folder, stem, suffix: F.concat(folder, stem, F.lit("_en"), suffix))


def json_blob_name(path) -> Column:
    """H5: ``dir/<clean stem>_en.json``."""
    return _renamed(path, lambda folder, stem, suffix: F.concat(folder, stem, F.lit("_en.json")))


def raw_invoice_blob_name(path, lang_code) -> Column:
    """H6: ``dir/<clean stem>_<lang><suffix>``."""
    lang = _c(lang_code)
    return _renamed(path, lambda folder, stem, suffix: F.concat(folder, stem, F.lit("_"), lang, suffix))


def normalize_blob_name(name) -> Column:
    """H7: spaces and hyphens become underscores."""
    return F.translate(_c(name), " -", "__")


def strip_ocr_suffix(path) -> Column:
    """H8: lower-cased stem without a trailing ``_ocr`` / ``_enhanced_ocr``."""
    return F.regexp_replace(F.lower(path_stem(base_name(path))), vocab.OCR_SUFFIX_PATTERN, "")


def ocr_output_name(path, enhanced=True) -> Column:
    """H9: ``<stem>_enhanced_ocr.pdf`` or ``<stem>_ocr.pdf``; directory dropped; H7."""
    stem = path_stem(base_name(path))
    tail = F.when(_as_col(enhanced), F.lit("_enhanced_ocr.pdf")).otherwise(F.lit("_ocr.pdf"))
    return normalize_blob_name(F.concat(stem, tail))


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def py_strip(c) -> Column:
    """Strip leading/trailing white space the way ``str.strip()`` does (Unicode)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def normalize_mime(content_type) -> Column:
    """Lower case, cut at ``;``, strip; null -> ''."""
    return py_strip(F.split_part(F.lower(F.coalesce(_c(content_type), F.lit(""))), F.lit(";"), F.lit(1)))


def effective_lang(path, source_lang: str | None) -> Column:
    """Language from the file name, else the caller's value, else null (auto)."""
    return F.coalesce(extract_source_lang(path), F.lit(source_lang).cast("string"))


def _map_literal(pairs) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def content_type_for(path, variant: str = "attachment") -> Column:
    """Extension -> MIME type via a literal map (no join, no shuffle)."""
    table = vocab.ATTACHMENT_CONTENT_TYPES if variant == "attachment" else vocab.DOCUMENT_CONTENT_TYPES
    ext = F.lower(path_suffix(base_name(path)))
    return F.coalesce(_map_literal(table)[ext], F.lit(vocab.DEFAULT_CONTENT_TYPE))
