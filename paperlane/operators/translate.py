"""Chunked translation with per-chunk fallback and reassembly.

Two execution forms, same semantics (empty text -> '' with no call; chunks
of ``chunk_size`` characters; a chunk that fails with a given source
language is retried under auto-detect; a failure under auto-detect fails the
document; results joined with ``\\n`` in chunk order):

* **native** — the translator is a Column function ``(chunk, lang) ->
  struct<text, error>``. Chunk, translate and re-join happen inside one
  projection with higher-order functions: no explode, no shuffle.
* **distributed** — the translator is a pandas batch function (a real
  service). Chunks become rows, are hash-repartitioned on ``(doc, chunk)`` so
  one long document is spread over many tasks, translated by a pandas UDF
  with the retry policy, then re-assembled by a grouped ordered
  concatenation bounded by the document's own chunk count.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.functions.text import chunk_text
from paperlane.operators.injected import CallPolicy

RESULT_TYPE = "struct<text:string,error:string>"


# ---------------------------------------------------------------------------------------------
# translators
# ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class NativeTranslator:
    """``fn(chunk, lang) -> struct<text, error>`` built from Column expressions."""
    fn: Callable[[Column, Column], Column]


@dataclass(frozen=True)
class BatchTranslator:
    """``fn(chunks: Series, langs: Series) -> Series`` raising on failure."""
    fn: Callable[[pd.Series, pd.Series], pd.Series]
    policy: CallPolicy = field(default_factory=CallPolicy)


def _ok(text: Column) -> Column:
    return F.struct(text.alias("text"), F.lit(None).cast("string").alias("error"))


def _err(msg: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("text"), msg.alias("error"))


def prefix_translator(prefix: str = "[EN]") -> NativeTranslator:
    """The test translator: ``prefix + chunk``."""
    return NativeTranslator(lambda chunk, lang: _ok(F.concat(F.lit(prefix), chunk)))


def failing_translator(fail_langs=("es",), prefix: str = "[EN]") -> NativeTranslator:
    """Deterministic failures: an unsupported source language fails (auto works);
    under auto-detect a chunk without any letter fails."""
    def fn(chunk: Column, lang: Column) -> Column:
        bad_lang = lang.isNotNull() & lang.isin(*fail_langs)
        undetectable = lang.isNull() & ~chunk.rlike(r"\p{L}")
        return (F.when(bad_lang, _err(F.concat(F.lit("unsupported source language: "), lang)))
                 .when(undetectable, _err(F.lit("language detection failed")))
                 .otherwise(_ok(F.concat(F.lit(prefix), chunk))))
    return NativeTranslator(fn)


def prefix_batch_translator(prefix: str = "[EN]", policy: CallPolicy = CallPolicy(base_delay=0.0)) -> BatchTranslator:
    return BatchTranslator(lambda chunks, langs: prefix + chunks, policy)


# ---------------------------------------------------------------------------------------------
# native form
# ---------------------------------------------------------------------------------------------
def _with_fallback(tr: NativeTranslator, chunk: Column, lang: Column) -> Column:
    first = tr.fn(chunk, lang)
    return F.when(first["error"].isNotNull() & lang.isNotNull(),
                  tr.fn(chunk, F.lit(None).cast("string"))).otherwise(first)


def translate_native(df: DataFrame, translator: NativeTranslator, text_col: str = "text",
                     lang_col: str | None = "lang", chunk_size: int = vocab.TRANSLATION_CHUNK_SIZE,
                     out_col: str = "translated_text", only_when: Column | None = None) -> DataFrame:
    """``only_when``: rows to translate; other rows keep their text unchanged
    and are never chunked."""
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    results = F.transform(chunk_text(F.col(text_col), chunk_size),
                          lambda c: _with_fallback(translator, c, lang))
    if only_when is not None:
        results = F.when(only_when, results)
    errors = F.filter(F.transform(F.col("__trc"), lambda r: r["error"]), lambda e: e.isNotNull())
    return (df.withColumn("__trc", results)
            .withColumns({
                "n_chunks": F.size("__trc"),
                "translation_error": F.get(errors, 0),
            })
            .withColumn(out_col, F.when(F.col("__trc").isNull(), F.col(text_col))
                        .when(F.col("translation_error").isNull(),
                              F.array_join(F.transform("__trc", lambda r: r["text"]), "\n")))
            .drop("__trc"))


# ---------------------------------------------------------------------------------------------
# distributed form
# ---------------------------------------------------------------------------------------------
def explode_chunks(df: DataFrame, key_cols: list[str], text_col: str = "text", lang_col: str | None = "lang",
                   chunk_size: int = vocab.TRANSLATION_CHUNK_SIZE, keep_empty: bool = False) -> DataFrame:
    """one row per chunk with its 1-based index; with ``keep_empty`` a text
    without chunks keeps one row of nulls."""
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return df.select(*key_cols, lang.alias("src_lang"),
                     explode(chunk_text(F.col(text_col), chunk_size)).alias("pos", "chunk")).select(
        *key_cols, "src_lang", (F.col("pos") + 1).alias("chunk_idx"), "chunk")


def _batch_udf(translator: BatchTranslator):
    policy = translator.policy
    fn = translator.fn

    @F.pandas_udf(RESULT_TYPE)
    def call(chunks: pd.Series, langs: pd.Series) -> pd.DataFrame:
        there = chunks.notna().to_numpy()  # the row of an empty text costs no call
        out = pd.DataFrame({"text": None, "error": None}, index=range(len(chunks)), dtype=object)
        if there.any():
            out.loc[there] = translated(chunks[there].reset_index(drop=True), langs[there].reset_index(drop=True)).to_numpy()
        return out

    def translated(chunks: pd.Series, langs: pd.Series) -> pd.DataFrame:
        text, err, _ = policy.call(fn, chunks, langs)
        if err is None and text is not None and len(text) == len(chunks):
            texts, errors = list(text), [None] * len(chunks)
        else:
            texts, errors = [], []
            for c, l in zip(chunks, langs):
                t, e, _ = policy.call(fn, pd.Series([c]), pd.Series([l]))
                texts.append(None if e else t.iloc[0])
                errors.append(e)
        # fallback: retry failed chunks that had a source language under auto-detect
        for i, (c, l) in enumerate(zip(chunks, langs)):
            if errors[i] is not None and l is not None and not pd.isna(l):
                t, e, _ = policy.call(fn, pd.Series([c]), pd.Series([None], dtype=object))
                texts[i], errors[i] = (None, e) if e else (t.iloc[0], None)
        return pd.DataFrame({"text": texts, "error": errors})

    return call


def reassemble_chunks(chunks: DataFrame, key_cols: list[str], text_col: str = "text",
                      error_col: str | None = "error", out_col: str = "translated_text") -> DataFrame:
    """Ordered ``\\n`` join of translated chunks per document (+ first error)."""
    parts = F.sort_array(F.collect_list(F.struct(
        F.col("chunk_idx"), F.col(text_col).alias("t"),
        (F.col(error_col) if error_col else F.lit(None).cast("string")).alias("e"))))
    parts = F.filter(parts, lambda x: x["chunk_idx"].isNotNull())
    g = chunks.groupBy(*key_cols).agg(parts.alias("_p"))
    err = F.get(F.filter(F.transform("_p", lambda x: x["e"]), lambda e: e.isNotNull()), 0)
    return g.select(*key_cols, F.size("_p").alias("n_chunks"), err.alias("translation_error"),
                    F.when(err.isNull(), F.array_join(F.transform("_p", lambda x: x["t"]), "\n")).alias(out_col))


def translate_distributed(df: DataFrame, translator: BatchTranslator, key_cols: list[str],
                          text_col: str = "text", lang_col: str | None = "lang",
                          chunk_size: int = vocab.TRANSLATION_CHUNK_SIZE, num_partitions: int | None = None,
                          out_col: str = "translated_text") -> DataFrame:
    """Returns ``key_cols + (n_chunks, translation_error, translated_text)``.

    Chunk -> shuffle by key and chunk -> pandas UDF -> ordered re-assembly; one
    long document is spread over many tasks. A document without text keeps one
    row without a chunk, so the texts are read once and never shuffled back. The
    number of partitions is left to Spark unless the service's own limit asks
    for ``num_partitions``.
    """
    ch = explode_chunks(df, key_cols, text_col, lang_col, chunk_size, keep_empty=True)
    by = [*key_cols, "chunk_idx"]
    ch = ch.repartition(num_partitions, *by) if num_partitions else ch.repartition(*by)
    res = ch.withColumn("_r", _batch_udf(translator)(F.col("chunk"), F.col("src_lang")))
    res = res.select(*key_cols, "chunk_idx", F.col("_r.text").alias("text"), F.col("_r.error").alias("error"))
    return reassemble_chunks(res, key_cols, out_col=out_col)
