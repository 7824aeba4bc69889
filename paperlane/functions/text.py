"""Native text expressions: prefixes, chunks, numbers, language acceptance,
white-space guards (H12-H16, C8, C9).

Everything here is a Catalyst expression with no Python worker. Higher-order
array functions (``transform``, ``filter``) are evaluated per row outside
whole-stage code generation.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlane import vocab


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_prefix(text, n: int) -> Column:
    """The first ``n`` characters (code points)."""
    return F.substring(_c(text), 1, n)


def is_blank(text) -> Column:
    """Null, empty or only (Unicode) white space."""
    t = _c(text)
    # a search that stops at the first non-space character (no rewrite of the text)
    return t.isNull() | ~t.rlike(r"(?U)\S")


def needs_translation(lang) -> Column:
    """Anything but English and 'unknown'."""
    return ~F.coalesce(_c(lang), F.lit(vocab.UNKNOWN_LANG)).isin("en", vocab.UNKNOWN_LANG)


def chunk_text(text, size: int = vocab.TRANSLATION_CHUNK_SIZE) -> Column:
    """Fixed-size character chunks; empty or null text -> empty array.

    ``sequence(0, -1)`` would be ``[0, -1]``, hence the explicit guard.
    """
    t = _c(text)
    n = F.coalesce(F.length(t), F.lit(0))
    starts = F.sequence(F.lit(0), F.ceil(n / F.lit(size)).cast("int") - 1)
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(
        F.transform(starts, lambda i: t.substr(i * F.lit(size) + F.lit(1), F.lit(size))))


def extract_numbers(text) -> Column:
    """Every match of the amount pattern (match index 0; no capture group).

    ``(?U)`` makes ``\\d`` and ``\\b`` Unicode-aware like Python's ``re``.
    """
    return F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit("(?U)" + vocab.NUMBER_PATTERN), F.lit(0))


def normalize_numbers(numbers) -> Column:
    """Spaces and commas removed, duplicates dropped."""
    return F.array_distinct(F.transform(_c(numbers), lambda x: F.translate(x, " ,", "")))


def accept_language(language, score, min_score: float = vocab.LANG_MIN_SCORE) -> Column:
    """Keep a 2-letter code with score >= min; ``xx-Yyyy`` -> ``xx``; else null."""
    lang = _c(language)
    s = _c(score)
    ok = s >= F.lit(min_score)
    prefix = F.split_part(lang, F.lit("-"), F.lit(1))
    return (F.when(ok & (F.length(lang) == 2), F.lower(lang))
             .when(ok & lang.contains("-") & (F.length(prefix) == 2), F.lower(prefix)))
