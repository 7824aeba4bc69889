"""Composite pipelines (J2-J4) as single DataFrame plans.

Each pipeline is a function of input DataFrames and parameters returning
DataFrames; nothing loops per document or per message on the driver. The
``run_*`` helpers write the outcome table once and derive the other outputs
from what was written, so expensive steps are never recomputed and a lost
executor only repeats its own tasks.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.functions import naming as nm
from paperlane.functions.text import is_blank, needs_translation
from paperlane.operators import classify as cl
from paperlane.operators import extract as ex
from paperlane.operators import integrity as ig
from paperlane.operators import listing as ls
from paperlane.operators import mail as ml
from paperlane.operators import notify as nt
from paperlane.operators import sinks as sk
from paperlane.operators import translate as tr
from paperlane.operators.language import detect_language
from paperlane.plans.staged import StagedRun


# ---------------------------------------------------------------------------------------------
# OCR batch
# ---------------------------------------------------------------------------------------------
def ocr_batch_outcomes(source: DataFrame, target: DataFrame, texts: DataFrame, lookback_hours: float,
                       as_of: dt.datetime, force_img_processing: bool = True,
                       normalize_keys: bool = False) -> DataFrame:
    """Per worklist file: path taken, output name, success or error.

    ``texts``: ``(doc_id, original_text, ocr_text)`` — the text layer before
    and after OCR — and, where payloads are to be stored, ``original`` and
    ``ocr_output`` (bytes), which the outcomes then carry. A file whose OCR text
    is blank fails (dead letter). With ``force_img_processing`` every file takes
    the enhanced path; otherwise the amount check (I11) picks the path.
    """
    work = ls.ocr_worklist(source, target, lookback_hours, as_of, normalize_keys)
    j = work.join(texts, "doc_id", "left")
    if force_img_processing:
        j = j.withColumn("amounts_missing", F.lit(None).cast("boolean")).withColumn("enhanced", F.lit(True))
    else:
        j = ig.amount_check(j).withColumn("enhanced", F.col("amounts_missing"))
    failed = is_blank(F.col("ocr_text"))
    return j.select(
        "doc_id", "container", "name", F.col("path").alias("worklist"), "amounts_missing",
        F.when(F.col("enhanced"), "enhanced").otherwise("normal").alias("ocr_path"),
        F.when(~failed, nm.ocr_output_name(F.col("name"), F.col("enhanced"))).alias("output_name"),
        F.when(failed, nm.normalize_blob_name(F.col("name"))).alias("failed_name"),
        F.when(failed, F.lit("OCR returned no text")).alias("error"),
        *(c for c in ("original", "ocr_output") if c in j.columns),
    )


def run_ocr_batch(source: DataFrame, target: DataFrame, texts: DataFrame, lookback_hours: float, as_of: dt.datetime, out_dir: str,
                  **options) -> dict[str, str]:
    """J2 with its outputs: outcomes and payloads are staged once; from the
    stage come the files of the target container (OCR output) and of the
    failed container (original bytes), and the log. A repeated run resumes."""
    run = StagedRun(source.sparkSession, out_dir, f"ocr-{as_of.strftime('%Y%m%d-%H%M%S-%f')}")
    stage = run.write("stage", lambda: ocr_batch_outcomes(source, target, texts, lookback_hours, as_of, **options))
    ok = F.col("error").isNull()
    run.write("containers", lambda: stage.select(
        F.when(ok, F.lit(vocab.OCR_TARGET_CONTAINER)).otherwise(F.lit(vocab.OCR_FAILED_CONTAINER)).alias("container"),
        F.when(ok, F.col("output_name")).otherwise(F.col("failed_name")).alias("blob_name"), "doc_id",
        F.when(ok, F.col("ocr_output")).otherwise(F.col("original")).alias("content"), "error"), "container")
    run.step("log", lambda: sk.write_run_log(ocr_batch_log(stage, run.run_id, as_of), f"{run.path}/log"))
    return {"outcomes": run.folder("stage"), "containers": run.folder("containers"), "log": f"{run.path}/log"}


def ocr_batch_log(outcomes: DataFrame, run_id: str, as_of: dt.datetime) -> DataFrame:
    """J2 log rows: one ``ocr_completed`` / ``ocr_failed`` per file plus the final
    ``workflow_completed`` row (also when files failed; an empty worklist logs nothing)."""
    ok = F.col("error").isNull()
    per_file = sk.log_rows(
        outcomes, run_id, "OCRPipeline", F.when(ok, "ocr_completed").otherwise("ocr_failed"),
        F.when(ok, "Completed").otherwise("Failed"), step_value=F.col("name"),
        detail=F.when(ok, F.concat(F.lit("Output: "), F.col("output_name"))).otherwise(F.col("error")),
        logged_at=as_of)
    final = sk.log_rows(
        outcomes.agg(F.count(F.lit(1)).alias("n")).where("n > 0"), run_id, "OCRPipeline", "workflow_completed", "Completed",
        detail=F.format_string("Processed %d file(s).", F.col("n")), logged_at=as_of)
    return sk.union_log(per_file, final)


# ---------------------------------------------------------------------------------------------
# Mailbox scan
# ---------------------------------------------------------------------------------------------
def email_scan_outcomes(messages: DataFrame, attachments: DataFrame, lookback_hours: float, as_of: dt.datetime,
                        translator: tr.NativeTranslator | None = None) -> DataFrame:
    """Per usable attachment of every message in the window: OCR-text guard,
    language, translation, classification and routing.

    ``attachments`` carry their OCR result in ``ocr_text`` and, where payloads
    are to be stored, their bytes in ``content``, which the outcomes then carry.
    """
    translator = translator or tr.prefix_translator()
    window = messages.where(ml.message_window_predicate(messages, lookback_hours, as_of))
    j = ml.scan_attachments(window, attachments).withColumn("ocr_text", F.coalesce(F.col("ocr_text"), F.lit("")))
    j = j.withColumns({"filename": ml.attachment_filename("name", "att_id"), "is_empty": is_blank(F.col("ocr_text"))})
    j = detect_language(j, "ocr_text")
    j = j.withColumn("lang_code", F.when(F.col("is_empty"), F.lit(None).cast("string")).otherwise(F.col("lang_code")))
    j = tr.translate_native(j, translator, text_col="ocr_text", lang_col="lang_code", out_col="translated_text",
                            only_when=needs_translation(F.col("lang_code")))
    j = cl.classify_rules(j, "translated_text")
    failed_tr = needs_translation(F.col("lang_code")) & F.col("translation_error").isNotNull()
    j = j.withColumns({
        "is_valid": ~F.col("is_empty") & ~failed_tr & F.coalesce(F.col("is_invoice"), F.lit(False)),
        "reason": F.when(F.col("is_empty"), F.lit(vocab.EMPTY_TEXT_REASON))
                   .when(failed_tr, F.concat(F.lit("Processing error: "), F.col("translation_error")))
                   .otherwise(F.coalesce(F.col("reason"), F.lit(vocab.NO_REASON))),
    })
    j = j.withColumn("lang_code", F.when(~F.coalesce(failed_tr, F.lit(False)), F.col("lang_code")))
    routed = ml.route_by_outcome(j)
    return routed.select("message_id", "att_id", "filename", "is_valid", "container", "blob_name", "lang_code",
                         "reason", "is_empty", *(("content", "content_type") if "content" in attachments.columns else ()))


def email_scan_notifications(messages: DataFrame, outcomes: DataFrame, as_of: dt.datetime) -> DataFrame:
    msgs = ml.with_sender_defaults(messages).select(F.col("id").alias("message_id"), "subject", "sender_name")
    return nt.compose_notifications(msgs, outcomes, as_of)


def email_scan_summary(messages: DataFrame, outcomes: DataFrame, lookback_hours: float,
                       as_of: dt.datetime) -> DataFrame:
    window = messages.where(ml.message_window_predicate(messages, lookback_hours, as_of))
    return ml.scan_summary(window, outcomes)


def email_scan_log(messages: DataFrame, outcomes: DataFrame, lookback_hours: float, as_of: dt.datetime,
                   run_id: str) -> DataFrame:
    """Process-log rows of a scan (all step kinds, SURVEY Q1) + the summary line.

    One ``explode`` makes both per-attachment rows (processed + validation
    verdict); a per-message aggregate (map-side partial) gives the
    ``email_received`` rows; the one-pass scan summary gives the final row.
    """
    v = F.col("is_valid")
    step = F.struct(F.lit("attachment_processed").alias("step_name"), F.lit("Completed").alias("status"),
                    F.lit(None).cast("string").alias("detail"))
    verdict = F.struct(F.when(v, "attachment_validation_passed").otherwise("attachment_validation_failed").alias(
        "step_name"), F.when(v, "Completed").otherwise("Failed").alias("status"), F.col("reason").alias("detail"))
    per_att = outcomes.select("filename", F.explode(F.array(step, verdict)).alias("s"))
    per_att = sk.log_rows(per_att, run_id, "EmailScanner", F.col("s.step_name"), F.col("s.status"),
                          step_value=F.col("filename"), detail=F.col("s.detail"), logged_at=as_of)
    per_msg = outcomes.groupBy("message_id").agg(F.count(F.lit(1)).alias("n"))
    received = sk.log_rows(per_msg, run_id, "EmailScanner", "email_received", "Completed",
                           step_value=F.col("message_id").cast("string"), logged_at=as_of)
    s = email_scan_summary(messages, outcomes, lookback_hours, as_of)
    final = sk.log_rows(s, run_id, "EmailScanner", "workflow_completed", "Completed",
                        detail=F.format_string("messages=%d valid=%d invalid=%d", F.col("messages_scanned"),
                                               F.col("valid_invoices"), F.col("invalid_invoices")),
                        logged_at=as_of)
    return sk.union_log(received, per_att, final)


def run_email_scan(messages: DataFrame, attachments: DataFrame, lookback_hours: float, as_of: dt.datetime, out_dir: str) -> dict[str, str]:
    """J3 with its outputs: outcomes (with ``content``, if the attachments have
    it) are staged once; from the stage come notifications, summary and log. With
    content the stage is laid out by container, so that the files of the raw and
    the invalid container are its parts and no payload is written twice. Each run
    has folders of its own, earlier runs stay; a repeated run resumes after its
    last finished step."""
    rid = f"email-{as_of.strftime('%Y%m%d-%H%M%S-%f')}"  # H19 format, no Spark job needed
    run = StagedRun(messages.sparkSession, out_dir, rid)
    if "content" in attachments.columns:  # empty texts have an outcome, but aren't stored
        outcomes = run.write("containers", lambda: email_scan_outcomes(messages, attachments, lookback_hours, as_of).withColumn(
            "stored", F.col("container").isNotNull()), "stored", "container", compression="zstd")
        staged, containers = run.folder("containers"), f"{run.folder('containers')}/stored=true"
    else:
        outcomes = run.write("outcomes", lambda: email_scan_outcomes(messages, attachments, lookback_hours, as_of))
        staged, containers = run.folder("outcomes"), run.folder("containers")
    run.write("notifications", lambda: email_scan_notifications(messages, outcomes, as_of))
    run.write("summary", lambda: email_scan_summary(messages, outcomes, lookback_hours, as_of))
    run.step("log", lambda: sk.write_run_log(email_scan_log(messages, outcomes, lookback_hours, as_of, rid), f"{run.path}/log"))
    return {"outcomes": staged, "containers": containers, "notifications": run.folder("notifications"),
            "summary": run.folder("summary"), "log": f"{run.path}/log"}


# ---------------------------------------------------------------------------------------------
# Translate + extract batch
# ---------------------------------------------------------------------------------------------
def translate_batch(source: DataFrame, existing: DataFrame, payloads: DataFrame, source_lang: str | None = None,
                    translator: tr.NativeTranslator | None = None, skip_existing: bool = True) -> DataFrame:
    """Per source blob: skipped / translated + extracted / failed.

    ``payloads``: ``(name, text)`` — the OCR text of each source blob.
    """
    translator = translator or tr.prefix_translator()
    if skip_existing:
        split = ls.skip_if_exists(source, existing)
    else:
        split = source.withColumns({"target_name": nm.translated_blob_name(F.col("name")),
                                    "status": F.lit("todo")})
    todo = split.where(F.col("status") == "todo").join(payloads, "name", "left")
    # Q3: an OCR output name keeps its language tag only after the OCR suffix is stripped
    lang_name = F.regexp_replace(F.col("name"), r"(?i)(_enhanced)?_ocr(\.[^./]+)$", "$2")
    todo = todo.withColumn("src_lang", nm.effective_lang(lang_name, source_lang))
    empty = is_blank(F.col("text"))
    todo = tr.translate_native(todo, translator, text_col="text", lang_col="src_lang")
    todo = ex.extract_details(ex.extract_baseline(todo, "translated_text"), "translated_text")
    error = (F.when(F.col("text").isNull(), F.lit("Downloaded blob is empty"))
              .when(empty, F.lit("OCR returned no text"))
              .otherwise(F.col("translation_error")))
    fields = ex.BASELINE_FIELDS + ex.DETAIL_FIELDS
    extracted = F.to_json(F.struct(*[F.col(c) for c in fields]))
    done = todo.select(
        "name", error.isNull().alias("success"),
        F.when(error.isNull(), F.col("target_name")).alias("translated_blob"),
        F.when(error.isNull(), nm.json_blob_name(F.col("name"))).alias("json_blob"),
        error.alias("error"), F.when(error.isNull(), extracted).alias("extracted_json"),
        F.lit(False).alias("skipped"))
    skipped = split.where(F.col("status") == "skipped").select(
        "name", F.lit(True).alias("success"), F.col("target_name").alias("translated_blob"),
        nm.json_blob_name(F.col("name")).alias("json_blob"), F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("extracted_json"), F.lit(True).alias("skipped"))
    return done.unionByName(skipped)


def translate_batch_log(results: DataFrame, run_id: str, as_of: dt.datetime) -> DataFrame:
    """J4 log rows: per blob that was not skipped its translation step and,
    once translated, its extraction step; then the run's ``workflow_completed``
    row with the summary line."""
    ok = F.col("success")
    translation = F.struct(F.when(ok, "translation_completed").otherwise("translation_failed").alias("step"),
                           F.when(ok, "Completed").otherwise("Failed").alias("status"),
                           F.when(ok, F.col("translated_blob")).otherwise(F.col("error")).alias("detail"))
    extraction = F.when(ok, F.struct(F.lit("extraction_completed").alias("step"), F.lit("Completed").alias("status"),
                                     F.col("json_blob").alias("detail")))
    steps = results.where(~F.col("skipped")).select("name", F.explode(F.filter(
        F.array(translation, extraction), lambda s: s.isNotNull())).alias("s"))
    per_blob = sk.log_rows(steps, run_id, "DocTranslator", F.col("s.step"), F.col("s.status"),
                           step_value=F.col("name"), detail=F.col("s.detail"), logged_at=as_of)
    final = sk.log_rows(batch_summary(results), run_id, "DocTranslator", "workflow_completed", "Completed",
                        detail=F.col("summary"), logged_at=as_of)
    return sk.union_log(per_blob, final)


def batch_summary(results: DataFrame) -> DataFrame:
    """E5: total / succeeded / failed (one row) and the summary string."""
    s = results.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("success")).alias("succeeded"))
    s = s.withColumn("failed", F.col("total") - F.col("succeeded"))
    return s.withColumn("summary", F.format_string("total=%d succeeded=%d failed=%d", "total", "succeeded", "failed"))
