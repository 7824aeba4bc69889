"""The stages of ``corpus_pipeline``, each one call of an operator.

All but the last return the columns of their input. Rows are chosen one by
one: those with the same id or none are decided each by its own text.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, linededup, simhash, toxicity
from .common import table, written


#: The number of a row, which the operators take in place of its id.
ROW = "__row"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row; written, so that it stays the same."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")


def _chosen(rows: DataFrame, numbers: DataFrame, how: str) -> DataFrame:
    """``rows`` with (``left_semi``) or without (``left_anti``) the numbers in ``doc_id``."""
    return rows.join(numbers.select(F.col("doc_id").alias(ROW)), ROW, how).drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under one half."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    rows = _numbered(docs)
    scored = toxicity.score_documents(rows, model, id_col=ROW)
    return _chosen(rows, scored.filter("score >= 0.5"), "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller id keeps; ``n_chars``, where
    there is one, follows. Columns named like the operator's counts are kept."""
    own = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in ("n_lines", "n_dropped")}
    made = linededup.dedup_lines(docs.withColumnsRenamed(own)).select(*(F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns))
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return made


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the row with the smallest id, of equal ids the
    first one; a row without an id only where no other has one."""
    rows = _numbered(docs)
    groups = simhash.simhash_groups(rows, id_col=ROW).select(F.col("doc_id").alias(ROW), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    kept = (rows.select("doc_id", ROW).join(groups, ROW).groupBy("component_id").agg(F.min(order).alias("first"))
            .select(F.col(f"first.{ROW}").alias("doc_id")))
    return _chosen(rows, kept, "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    rows = _numbered(docs)
    found = decontaminate.find_contamination(rows, table(spark, sf_dir, "benchmark"), id_col=ROW)
    return _chosen(rows, found.filter("n_hit > 0"), "left_anti")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every document."""
    import public_tokenizers

    made = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
