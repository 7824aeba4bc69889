"""The registered queries of this subpackage and their SQL twins.

Each query applies one operator to the whole of its table and derives the
digest columns of its contract from the operator's output.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, centroids, decontaminate, language, licenses, linededup, passages, quality, resampling, secrets,
               simhash, tokenfiles, toxicity)
from .common import new_folder, table


def _held_out(remainder: int, modulus: int):
    return F.crc32(F.col("doc_id").cast("string")) % modulus == remainder


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~_held_out(0, 5)))
    return toxicity.score_documents(docs, model).select(
        "doc_id", _held_out(0, 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.array_join("spans", ",").alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.filter(~_held_out(1, 3)))
    return language.identify(docs, model).select(
        "doc_id", _held_out(1, 3).alias("held_out"), "lang_pred", "score")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.coalesce("found", F.array().cast(found.schema["found"].dataType))

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["rule"] < len(secrets.BASE_RULES))
    return found.select("doc_id", *(count(r.kind) for r in secrets.BASE_RULES),
                        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                        secrets.span_text(spans).alias("spans"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.by_pair(passages.find_passages(table(spark, sf_dir, "documents")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition_coverage(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_folder(spark, "token-files")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.PATTERN, end_id=2)
    return tokenfiles.checksums(tokenfiles.read_tokens(spark, path))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, final = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", centroids.centroid_digests(final))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


REGISTRY = {f.__name__: f for f in (
    op1_toxicity, op2_language_id, op3_secret_scan, op4_byte_bpe, op5_simhash, op6_substring_dedup, op7_line_dedup,
    op8_quality_rules, op9_decontamination, op10_license_scan, op11_token_files, op12_centroid_clustering,
    op13_importance_resampling)}


def oracle_sql() -> dict[str, str]:
    from . import sql

    return dict(sql.ORACLES)
