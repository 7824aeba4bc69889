"""Amount integrity of a text transformation.

Numbers are extracted from the text before and after (e.g. OCR), normalised
and compared as sets with array functions, per row: no explode and no
shuffle. A document whose missing share reaches the threshold takes the
fallback path; both paths are one ``unionByName``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.functions import naming as nm
from paperlane.functions.text import extract_numbers, normalize_numbers


def missing_ratio(original_numbers: Column, ocr_numbers: Column) -> Column:
    """|orig - ocr| / |orig| on distinct normalised numbers (null when orig is empty)."""
    a = normalize_numbers(original_numbers)
    b = normalize_numbers(ocr_numbers)
    return F.when(F.size(a) > 0, F.size(F.array_except(a, b)) / F.size(a))


def amounts_missing(original_numbers: Column, ocr_numbers: Column,
                    threshold: float = vocab.AMOUNT_MISSING_THRESHOLD) -> Column:
    """E9 flag: ratio >= threshold; an empty original is never missing."""
    return F.coalesce(missing_ratio(original_numbers, ocr_numbers) >= F.lit(threshold), F.lit(False))


def amount_check(df: DataFrame, original_col: str = "original_text", ocr_col: str = "ocr_text",
                 threshold: float = vocab.AMOUNT_MISSING_THRESHOLD) -> DataFrame:
    orig = extract_numbers(F.col(original_col))
    ocr = extract_numbers(F.col(ocr_col))
    a = normalize_numbers(orig)
    return df.withColumns({
        "n_original": F.size(a),
        "n_missing": F.size(F.array_except(a, normalize_numbers(ocr))),
        "missing_ratio": missing_ratio(orig, ocr),
        "amounts_missing": amounts_missing(orig, ocr, threshold),
    })


def missing_amounts(df: DataFrame, key_cols: list[str], original_col: str = "original_text",
                    ocr_col: str = "ocr_text") -> DataFrame:
    """G1 in row form: one row per number of the original absent after the transformation."""
    a = normalize_numbers(extract_numbers(F.col(original_col)))
    b = normalize_numbers(extract_numbers(F.col(ocr_col)))
    return df.select(*key_cols, F.explode(F.array_except(a, b)).alias("number"))


def amount_integrity_paths(df: DataFrame, name_col: str = "name", original_col: str = "original_text",
                           ocr_col: str = "ocr_text", threshold: float = vocab.AMOUNT_MISSING_THRESHOLD) -> DataFrame:
    """I11 + G3: direct path when the check passes, enhanced (image) path when
    it fails; output names follow H9."""
    checked = amount_check(df, original_col, ocr_col, threshold)
    bad = F.col("amounts_missing")
    return checked.withColumns({"path": F.when(bad, "enhanced").otherwise("normal"),
                                "output_name": nm.ocr_output_name(F.col(name_col), bad)})
