"""Registered queries: one per operator of the inventory, over the fixture views.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables. Column names equal those of the DuckDB twins in
``oracle_sql.py``.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperlane import vocab
from paperlane.operators import lineage as lin
from paperlane.session import ensure_checkpoint_dir
from paperlane.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = getattr(fn, "__name__", name)
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


# ---------------------------------------------------------------------------------------------
# lineage
# ---------------------------------------------------------------------------------------------
def _period_queries():
    for p in vocab.VALID_PERIODS:
        register(f"lineage_summary_{p}")(
            lambda spark, sf, p=p: lin.lineage_summary(fx.process_log(spark, sf), p, fx.AS_OF_LOG))
        register(f"lineage_counts_{p}")(
            lambda spark, sf, p=p: lin.lineage_counts(fx.process_log(spark, sf), p, fx.AS_OF_LOG))


_period_queries()


@register("lineage_response")
def q_lineage_response(spark, sf):
    return lin.lineage_response(fx.process_log(spark, sf), " Last_7_Days ", fx.AS_OF_LOG, country_code="TR")


@register("scan_process_log")
def q_scan_process_log(spark, sf):
    return lin.scan_process_log(fx.process_log(spark, sf), "yesterday", fx.AS_OF_LOG)


@register("preview_process_log")
def q_preview_process_log(spark, sf):
    return lin.preview_process_log(fx.process_log(spark, sf))


@register("workflow_step_counts")
def q_workflow_step_counts(spark, sf):
    return lin.workflow_step_counts(fx.process_log(spark, sf), "last_30_days", fx.AS_OF_LOG, with_subtotals=True)


@register("run_drilldown")
def q_run_drilldown(spark, sf):
    return lin.run_drilldown(fx.process_log(spark, sf), "run-7")


@register("latest_step_per_run")
def q_latest_step_per_run(spark, sf):
    return lin.latest_step_per_run(fx.process_log(spark, sf))


# ---------------------------------------------------------------------------------------------
# naming (H1-H11, D4)
# ---------------------------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from paperlane.functions import naming as nm  # noqa: E402
from paperlane.operators import listing as ls  # noqa: E402


def _names(spark, sf):
    return fx.blob_names(spark, sf)


@register("path_stem_suffix")
def q_path_stem_suffix(spark, sf):
    stem, suffix = nm.stem_and_suffix(F.col("name"))
    return _names(spark, sf).select("origin", "item_id", "name", nm.base_name("name").alias("base"),
                                    nm.dir_prefix("name").alias("dir"), stem.alias("stem"), suffix.alias("suffix"))


@register("extract_source_lang")
def q_extract_source_lang(spark, sf):
    return _names(spark, sf).select("origin", "item_id", "name", nm.extract_source_lang("name").alias("source_lang"))


@register("clean_stem")
def q_clean_stem(spark, sf):
    return _names(spark, sf).select("origin", "item_id", "name", nm.clean_stem("name").alias("clean_stem"))


@register("translated_blob_name")
def q_translated_blob_name(spark, sf):
    return _names(spark, sf).select("origin", "item_id", "name",
                                    nm.translated_blob_name("name").alias("translated_name"))


@register("json_blob_name")
def q_json_blob_name(spark, sf):
    return _names(spark, sf).select("origin", "item_id", "name", nm.json_blob_name("name").alias("json_name"))


@register("raw_invoice_blob_name")
def q_raw_invoice_blob_name(spark, sf):
    lang = F.coalesce(F.col("lang"), F.lit("xx"))
    return _names(spark, sf).select("origin", "item_id", "name",
                                    nm.raw_invoice_blob_name("name", lang).alias("raw_name"))


@register("normalize_blob_name")
def q_normalize_blob_name(spark, sf):
    return _names(spark, sf).select("origin", "item_id", "name", nm.normalize_blob_name("name").alias("normalized"))


@register("strip_ocr_suffix")
def q_strip_ocr_suffix(spark, sf):
    t = fx.target_blobs(spark, sf, as_of=None)
    return t.select("doc_id", "name", nm.strip_ocr_suffix("name").alias("stem_key"))


@register("ocr_output_name")
def q_ocr_output_name(spark, sf):
    return _names(spark, sf).select(
        "origin", "item_id", "name",
        nm.ocr_output_name("name", F.col("item_id") % 2 == 1).alias("ocr_name"))


@register("normalize_mime")
def q_normalize_mime(spark, sf):
    a = fx.attachments(spark, sf)
    return a.select("message_id", "att_id", "content_type", nm.normalize_mime("content_type").alias("mime"))


@register("effective_lang")
def q_effective_lang(spark, sf):
    return _names(spark, sf).select("origin", "item_id", "name", nm.effective_lang("name", "de").alias("lang_used"))


@register("mime_lookup")
def q_mime_lookup(spark, sf):
    return _names(spark, sf).select(
        "origin", "item_id", "name",
        nm.content_type_for("name", "attachment").alias("attachment_type"),
        nm.content_type_for("name", "document").alias("document_type"))


# ---------------------------------------------------------------------------------------------
# listing (A1, C1-C3, D1, D2, G2, F2, F4, J1)
# ---------------------------------------------------------------------------------------------
LISTING_COLS = ["container", "name", "last_modified", "size"]


@register("scan_blob_listing")
def q_scan_blob_listing(spark, sf):
    return fx.source_blobs(spark, sf).select(*LISTING_COLS)


@register("lookback_filter")
def q_lookback_filter(spark, sf):
    return ls.lookback_filter(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), 12, fx.AS_OF_BLOB).select(*LISTING_COLS)


@register("pdf_filter")
def q_pdf_filter(spark, sf):
    return ls.pdf_filter(fx.source_blobs(spark, sf)).select(*LISTING_COLS)


@register("same_utc_day_filter")
def q_same_utc_day_filter(spark, sf):
    return ls.same_utc_day_filter(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), fx.AS_OF_BLOB).select(*LISTING_COLS)


@register("reconcile_unprocessed")
def q_reconcile_unprocessed(spark, sf):
    return ls.reconcile_unprocessed(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), fx.target_blobs(spark, sf, fx.AS_OF_BLOB),
                                    fx.AS_OF_BLOB).select(*LISTING_COLS)


@register("reconcile_unprocessed_normalized")
def q_reconcile_unprocessed_normalized(spark, sf):
    return ls.reconcile_unprocessed(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), fx.target_blobs(spark, sf, fx.AS_OF_BLOB),
                                    fx.AS_OF_BLOB, normalize_keys=True).select(*LISTING_COLS)


@register("reconcile_with_manifest")
def q_reconcile_with_manifest(spark, sf):
    """D1 against a bucketed manifest of the target container."""
    from paperlane.operators.manifest import TargetManifest

    manifest = TargetManifest(spark, _folder(spark, "manifest"), buckets=16)
    manifest.add(fx.target_blobs(spark, sf, fx.AS_OF_BLOB))
    return manifest.reconcile(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), fx.AS_OF_BLOB).select(*LISTING_COLS)


@register("ocr_worklist")
def q_ocr_worklist(spark, sf):
    return ls.ocr_worklist(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), fx.target_blobs(spark, sf, fx.AS_OF_BLOB), 12,
                           fx.AS_OF_BLOB).select(*LISTING_COLS, "path")


@register("ocr_worklist_reconcile")
def q_ocr_worklist_reconcile(spark, sf):
    return ls.ocr_worklist(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), fx.target_blobs(spark, sf, fx.AS_OF_BLOB), 0,
                           fx.AS_OF_BLOB).select(*LISTING_COLS, "path")


@register("skip_if_exists")
def q_skip_if_exists(spark, sf):
    return ls.skip_if_exists(fx.source_blobs(spark, sf), fx.translated_blobs(spark, sf)).select(
        "name", "target_name", "status")


@register("skip_if_exists_both_outputs")
def q_skip_if_exists_both(spark, sf):
    return ls.skip_if_exists(fx.source_blobs(spark, sf), fx.translated_blobs(spark, sf),
                             require_also=nm.json_blob_name).select("name", "target_name", "target_json", "status")


@register("dedup_listing")
def q_dedup_listing(spark, sf):
    page1 = fx.source_blobs(spark, sf).select(*LISTING_COLS)
    page2 = fx.source_blobs(spark, sf, as_of=fx.AS_OF_BLOB.replace(hour=6)).select(*LISTING_COLS)
    return ls.dedup_listing(page1.unionByName(page2))


@register("latest_write_per_blob")
def q_latest_write_per_blob(spark, sf):
    return ls.latest_write_per_blob(fx.blob_writes(spark, sf))


@register("target_name_collisions")
def q_target_name_collisions(spark, sf):
    """most attachments are named alike; of every third message the names are its own."""
    own = F.concat(F.col("message_id").cast("string"), F.lit("-"), F.col("att_id"), F.lit("-"), F.col("name"))
    w = fx.attachments(spark, sf).withColumn("name", F.when(F.col("message_id") % 3 == 0, own).otherwise(F.col("name")))
    stored = F.when(F.col("is_valid"), nm.raw_invoice_blob_name("name", F.lit("en"))).otherwise(F.col("name"))
    df = w.select("message_id", "att_id", "name",
                  F.concat(F.when(F.col("is_valid"), F.lit("raw-invoices/")).otherwise(F.lit("invalid-invoices/")),
                           stored).alias("target_name"))
    return ls.target_name_collisions(df)


# ---------------------------------------------------------------------------------------------
# mail (A3-A5, C4-C6, C10, C13, D3, E3, E4, E6, H17, H18, B2)
# ---------------------------------------------------------------------------------------------
from paperlane.operators import mail as ml  # noqa: E402

MAIL_WINDOW_H = 720          # 30 days before the mail anchor
MAIL_ALL_H = 61368           # 7 years: every message of the fixture


def _window_messages(spark, sf, hours=MAIL_ALL_H):
    m = fx.messages(spark, sf)
    return m.where(ml.message_window_predicate(m, hours, fx.AS_OF_MAIL))


def _stand_in_outcomes(spark, sf):
    """Usable attachments of all window messages with the fixture's stand-in verdict."""
    return ml.scan_attachments(_window_messages(spark, sf), fx.attachments(spark, sf))


@register("scan_messages")
def q_scan_messages(spark, sf):
    return ml.scan_messages(fx.messages(spark, sf), MAIL_WINDOW_H, fx.AS_OF_MAIL)


@register("message_window_filter")
def q_message_window_filter(spark, sf):
    return _window_messages(spark, sf).select("id", "received_at")


@register("usable_attachment_filter")
def q_usable_attachment_filter(spark, sf):
    return ml.usable_attachments(fx.attachments(spark, sf)).select("message_id", "att_id", "content_type", "size")


@register("supported_mime_filter")
def q_supported_mime_filter(spark, sf):
    return ml.usable_attachments(fx.attachments(spark, sf), apply_allow_list=True).select(
        "message_id", "att_id", "content_type")


@register("scan_attachments")
def q_scan_attachments(spark, sf):
    return ml.scan_attachments(_window_messages(spark, sf, MAIL_WINDOW_H), fx.attachments(spark, sf)).select(
        "message_id", "att_id", "name", "content_type", "size")


@register("decode_attachment_payload")
def q_decode_attachment_payload(spark, sf):
    a = fx.attachments(spark, sf)
    b64 = F.when(F.col("content_type").isNotNull(), F.base64(F.encode(F.col("reason"), "UTF-8")))
    raw = ml.decode_payload(b64)
    return a.select("message_id", "att_id", F.length(raw).alias("n_bytes"),
                    F.decode(raw, "UTF-8").alias("payload_text"))


@register("message_attachments")
def q_message_attachments(spark, sf):
    return ml.message_attachments(_window_messages(spark, sf), fx.attachments(spark, sf)).select(
        "message_id", "att_id", "subject", "sender_email", "sender_name")


@register("sender_name_default")
def q_sender_name_default(spark, sf):
    return ml.with_sender_defaults(fx.messages(spark, sf)).select("id", "sender_email", "sender_name")


@register("subject_filename_defaults")
def q_subject_filename_defaults(spark, sf):
    m = ml.with_sender_defaults(fx.messages(spark, sf)).select(F.col("id").alias("message_id"), "subject")
    a = fx.attachments(spark, sf).select(
        "message_id", "att_id",
        ml.attachment_filename(F.when(F.col("size") >= 100, F.col("name")), "att_id").alias("filename"))
    return a.join(m, "message_id", "inner")


@register("skip_message_without_usable_attachments")
def q_skip_message(spark, sf):
    return ml.messages_with_usable_attachments(_window_messages(spark, sf), fx.attachments(spark, sf)).select("id")


@register("message_rollup")
def q_message_rollup(spark, sf):
    return ml.message_rollup(_stand_in_outcomes(spark, sf))


@register("scan_summary")
def q_scan_summary(spark, sf):
    return ml.scan_summary(_window_messages(spark, sf), _stand_in_outcomes(spark, sf))


@register("run_exit_status")
def q_run_exit_status(spark, sf):
    return ml.exit_status(_stand_in_outcomes(spark, sf), ~F.col("is_valid"))


@register("split_valid_invalid")
def q_split_valid_invalid(spark, sf):
    good, bad = ml.split_valid_invalid(_written(_stand_in_outcomes(spark, sf), "outcomes"))
    cols = ["message_id", "att_id", "is_valid"]
    return (good.select(*cols, F.lit("valid").alias("half"))
            .unionByName(bad.select(*cols, F.lit("invalid").alias("half"))))


@register("route_by_outcome")
def q_route_by_outcome(spark, sf):
    o = _stand_in_outcomes(spark, sf).select(
        "message_id", "att_id", F.col("name").alias("filename"), "is_valid",
        F.lit("en").alias("lang_code"), F.col("content_type").isNull().alias("is_empty"))
    out = _folder(spark, "containers")  # B2: routed, written by container and read again
    sk.route_to_containers(ml.route_by_outcome(o), out, "run-1")
    return spark.read.parquet(out).select("message_id", "att_id", "container", "blob_name", "content_type")


# ---------------------------------------------------------------------------------------------
# text: prefixes, chunks, translation, language, numbers (H12-H16, C8, C9, E9, E10, F3, G1,
# G3, I1-I3, I11)
# ---------------------------------------------------------------------------------------------
from paperlane.functions import text as tx  # noqa: E402
from paperlane.operators import integrity as ig  # noqa: E402
from paperlane.operators import language as lg  # noqa: E402
from paperlane.operators import translate as tr  # noqa: E402


@register("text_prefix")
def q_text_prefix(spark, sf):
    d = fx.ocr_text(spark, sf)
    return d.select("doc_id", tx.text_prefix("text", 500).alias("prefix_500"),
                    tx.text_prefix("text", 4000).alias("prefix_4000"))


@register("chunk_text")
def q_chunk_text(spark, sf):
    return tr.explode_chunks(fx.ocr_text(spark, sf), ["doc_id"]).select("doc_id", "chunk_idx", "chunk")


@register("chunk_index")
def q_chunk_index(spark, sf):
    ch = tr.explode_chunks(fx.ocr_text(spark, sf), ["doc_id"], chunk_size=1000)
    return ch.select("doc_id", "chunk_idx", F.length("chunk").alias("chunk_len"))


@register("reassemble_chunks")
def q_reassemble_chunks(spark, sf):
    ch = tr.explode_chunks(fx.ocr_text(spark, sf), ["doc_id"], chunk_size=2000)
    ch = ch.withColumn("text", F.concat(F.lit("[EN]"), F.col("chunk"))).withColumn("error", F.lit(None).cast("string"))
    return tr.reassemble_chunks(ch, ["doc_id"]).select("doc_id", "n_chunks", "translated_text")


def _doc_with_lang(spark, sf):
    d = fx.ocr_text(spark, sf)
    return d.withColumn("src_lang", nm.effective_lang(F.col("filename"), None))


@register("translate_documents")
def q_translate_documents(spark, sf):
    out = tr.translate_native(_doc_with_lang(spark, sf), tr.prefix_translator(), lang_col="src_lang")
    return out.select("doc_id", "n_chunks", "translated_text", "translation_error")


@register("translate_documents_distributed")
def q_translate_documents_distributed(spark, sf):
    out = tr.translate_distributed(_doc_with_lang(spark, sf), tr.prefix_batch_translator(), ["doc_id"],
                                   lang_col="src_lang")
    return out.select("doc_id", "n_chunks", "translated_text", "translation_error")


@register("translate_with_fallback")
def q_translate_with_fallback(spark, sf):
    d = _doc_with_lang(spark, sf).withColumn(
        "text", F.when(F.col("doc_id") % 10 == 3, F.regexp_replace("text", r"\p{L}", "")).otherwise(F.col("text")))
    out = tr.translate_native(d, tr.failing_translator(("es",)), lang_col="src_lang")
    return out.select("doc_id", "n_chunks", "translated_text", "translation_error")


@register("detect_language")
def q_detect_language(spark, sf):
    return lg.detect_language(fx.ocr_text(spark, sf)).select(
        "doc_id", "detected", "hits", "total_hits", "score", "lang_code")


@register("language_accuracy")
def q_language_accuracy(spark, sf):
    d = lg.detect_language(fx.ocr_text(spark, sf))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"),
                                 F.sum(F.when(F.col("lang_code") == F.col("lang"), 1).otherwise(0)).cast("bigint")
                                 .alias("n_correct"),
                                 F.sum(F.when(F.col("lang_code") == "xx", 1).otherwise(0)).cast("bigint")
                                 .alias("n_unsure"))


#: Other scripts for the documents' letters: fixed stand-ins of the fixture, letter for letter.
SCRIPT_LETTERS = ("абвгдежзийклмнопрстуфхцчшщ", "あいうえおかきくけこさしすせそたちつてとなにぬねのは", "一二三四五六七八九十百千万上下左右中大小日月年火水木",
                  "ابتثجحخدذرزسشصضطظعغفقكلمنه", "가나다라마바사아자차카타파하거너더러머버서어저처커터")


def _scripts(spark, sf):
    """Documents, five in six of them in letters of another script."""
    t = F.lower(F.col("text"))
    text = F.when(F.col("doc_id") % 6 == 5, F.col("text"))
    for i, letters in enumerate(SCRIPT_LETTERS):
        text = text.when(F.col("doc_id") % 6 == i, F.translate(t, "abcdefghijklmnopqrstuvwxyz", letters))
    return fx.ocr_text(spark, sf).select("doc_id", "lang", text.alias("text"))


@register("detect_language_scripts")
def q_detect_language_scripts(spark, sf):
    """I1 over scripts that are not Latin."""
    return lg.detect_language(_scripts(spark, sf)).select("doc_id", "detected", "score", "lang_code")


@register("language_profiles")
def q_language_profiles(spark, sf):
    """Character profiles counted from labelled documents (those with an id that is not 1 modulo 3)."""
    return lg.learn_profiles(fx.ocr_text(spark, sf).where(F.col("doc_id") % 3 != 1))


@register("language_profile_accuracy")
def q_language_profile_accuracy(spark, sf):
    """Documents that the profiles were not counted from, per language."""
    docs = fx.ocr_text(spark, sf)
    held = docs.where(F.col("doc_id") % 3 == 1)
    found = lg.detect_by_profile(held, _written(lg.learn_profiles(docs.where(F.col("doc_id") % 3 != 1)), "profiles"), "doc_id")
    return held.join(found, "doc_id", "left").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("detected") == F.col("lang")).alias("n_correct"))


@register("accept_lang")
def q_accept_lang(spark, sf):
    d = lg.detect_language(fx.ocr_text(spark, sf))
    reported = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("detected"), F.lit("-Latn"))).otherwise(F.col("detected"))
    return d.select("doc_id", reported.alias("reported"), "score",
                    tx.accept_language(reported, F.col("score")).alias("accepted"))


@register("non_empty_guard")
def q_non_empty_guard(spark, sf):
    d = fx.ocr_text(spark, sf)
    t = F.when(F.col("doc_id") % 17 == 0, F.regexp_replace("text", r"\S", "")).otherwise(F.col("text"))
    return d.select("doc_id", tx.is_blank(t).alias("is_blank"))


@register("needs_translation")
def q_needs_translation(spark, sf):
    d = lg.detect_language(fx.ocr_text(spark, sf))
    return d.select("doc_id", "lang_code", tx.needs_translation(F.col("lang_code")).alias("needs_translation"))


@register("extract_numbers")
def q_extract_numbers(spark, sf):
    d = fx.ocr_text(spark, sf)
    nums = tx.extract_numbers(F.col("text"))
    return d.select("doc_id", F.size(nums).alias("n_numbers"), F.array_join(nums, "|").alias("numbers"))


@register("normalize_numbers")
def q_normalize_numbers(spark, sf):
    d = fx.ocr_text(spark, sf)
    nums = tx.normalize_numbers(tx.extract_numbers(F.col("text")))
    return d.select("doc_id", F.size(nums).alias("n_distinct"), F.array_join(F.array_sort(nums), "|").alias("numbers"))


@register("missing_amount_ratio")
def q_missing_amount_ratio(spark, sf):
    return ig.amount_check(fx.ocr_pairs(spark, sf)).select(
        "doc_id", "n_original", "n_missing", "missing_ratio", "amounts_missing")


@register("missing_amounts")
def q_missing_amounts(spark, sf):
    return ig.missing_amounts(fx.ocr_pairs(spark, sf), ["doc_id"])


@register("amount_integrity_check")
def q_amount_integrity_check(spark, sf):
    return ig.amount_integrity_paths(fx.ocr_pairs(spark, sf)).select(
        "doc_id", "name", "amounts_missing", "path", "output_name")


@register("union_paths")
def q_union_paths(spark, sf):
    return ig.amount_integrity_paths(fx.ocr_pairs(spark, sf)).groupBy("path").agg(
        F.count(F.lit(1)).alias("n_docs"))


# ---------------------------------------------------------------------------------------------
# extraction (I5-I10, D5, D6, H21-H23, H26), classification (I4, H27), notifications
# ---------------------------------------------------------------------------------------------
from paperlane.operators import classify as cl  # noqa: E402
from paperlane.operators import extract as ex  # noqa: E402
from paperlane.operators import notify as nt  # noqa: E402


@register("extract_baseline")
def q_extract_baseline(spark, sf):
    return ex.extract_baseline(fx.invoice_text(spark, sf)).select("doc_id", "invoiceNumber", "invoiceDate")


@register("normalize_invoice_date")
def q_normalize_invoice_date(spark, sf):
    t = fx.invoice_text(spark, sf)
    raw = F.regexp_extract("text", ex.DATE_VALUE, 1)
    return t.select("doc_id", raw.alias("raw_date"), ex.normalize_invoice_date(raw).alias("invoiceDate"))


@register("valid_po_number")
def q_valid_po_number(spark, sf):
    t = fx.invoice_text(spark, sf)
    po = F.regexp_extract("text", r"PO:\s*([0-9]+)", 1)
    alt = F.concat(F.lit("66"), F.lpad((F.col("doc_id") % 1000).cast("string"), 7, "0"))
    return t.select("doc_id", po.alias("po"), ex.valid_po_number(po).alias("po_valid"),
                    alt.alias("alt_po"), ex.valid_po_number(alt).alias("alt_valid"))


@register("bank_swift_checks")
def q_bank_swift_checks(spark, sf):
    c = fx.read_table(spark, sf, "customer")
    acct = F.concat(F.col("c_custkey").cast("string"), F.lit("0000000"))
    bic = F.substring(F.upper(F.regexp_replace("c_name", "[^A-Za-z0-9]", "")), 1,
                      F.when(F.col("c_custkey") % 5 == 0, 10).when(F.col("c_custkey") % 2 == 0, 11).otherwise(8))
    return c.select("c_custkey", acct.alias("account"), ex.valid_bank_account(acct).alias("account_valid"),
                    bic.alias("bic"), ex.valid_swift(bic).alias("bic_valid"))


def _details(spark, sf):
    return ex.extract_details(fx.invoice_text(spark, sf))


@register("extract_details_doctype")
def q_extract_details_doctype(spark, sf):
    return _details(spark, sf).select("doc_id", "purchaseOrderNumber", "doctype")


@register("extract_details_invoice_type")
def q_extract_details_invoice_type(spark, sf):
    return _details(spark, sf).select("doc_id", "currency", "invoiceType")


@register("extract_details_amounts_ids")
def q_extract_details_amounts_ids(spark, sf):
    return _details(spark, sf).select("doc_id", "vendorNumber", "totalInvoiceAmount", "taxAmount", "currency",
                                      "Bank_Account_Number", "Global_Bank_Identifier", "vatTaxAmount", "totalNetAmount",
                                      "taxIdentification", "receiverVATID", "taxPercentage", "vatPercentage",
                                      "withholdingPercentage", "Bank_Key", "buyerName")


@register("extract_line_items")
def q_extract_line_items(spark, sf):
    """The line items of every invoice, from its text."""
    return ex.extract_line_items(fx.itemised_invoice_text(spark, sf))


@register("flatten_line_items")
def q_flatten_line_items(spark, sf):
    return ex.flatten_line_items(fx.extraction_json(spark, sf))


@register("validate_extraction")
def q_validate_extraction(spark, sf):
    return ex.validate_extraction(fx.extraction_json(spark, sf)).select("doc_id", "n_violations", "violations")


@register("validate_baseline")
def q_validate_baseline(spark, sf):
    """I10 on the baseline's two required fields, some taken out or of another type."""
    k = F.col("doc_id")
    base = ex.extract_baseline(fx.invoice_text(spark, sf)).withColumns({
        "invoiceDate": F.when(k % 6 != 0, F.col("invoiceDate")), "number": F.when(k % 10 == 3, k)})
    js = (F.when(k % 17 == 0, F.lit("[1]")).when(k % 19 == 0, F.lit('"text"'))
           .when(k % 10 == 3, F.to_json(F.struct(F.col("number").alias("invoiceNumber"), "invoiceDate")))
           .otherwise(F.to_json(F.struct("invoiceNumber", "invoiceDate"))))
    return ex.validate_extraction(base.select("doc_id", js.alias("json")), "json", ex.baseline_json_schema()).select(
        "doc_id", "n_violations", "violations")


@register("json_roundtrip")
def q_json_roundtrip(spark, sf):
    p = ex.parse_details(fx.extraction_json(spark, sf))
    return p.select("doc_id", F.col("d.doctype").alias("doctype"), F.col("d.currency").alias("currency"),
                    ex.money(F.col("d.totalInvoiceAmount")).alias("totalInvoiceAmount"),
                    F.size(F.coalesce("d.invoiceLineItems", F.array())).alias("n_items"))


@register("merge_extractions")
def q_merge_extractions(spark, sf):
    base = ex.extract_baseline(fx.invoice_text(spark, sf)).select(
        "doc_id", "invoiceNumber", "invoiceDate", ex.currency(F.col("text")).alias("currency"))
    det = ex.parse_details(fx.extraction_json(spark, sf)).select(
        "doc_id", F.col("d.doctype").alias("doctype"), F.col("d.currency").alias("currency"))
    return ex.merge_extractions(base, det)


@register("buyer_match")
def q_buyer_match(spark, sf):
    o = fx.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = fx.read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    inv = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("doc_id"), F.lower(F.replace("c_name", F.lit("#"), F.lit(" # "))).alias("buyer_text"))
    buyers = c.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_name").alias("buyer_name"))
    return ex.buyer_match(inv, buyers).select("doc_id", "buyerName")


@register("classify_invoice")
def q_classify_invoice(spark, sf):
    return cl.classify_rules(fx.invoice_text(spark, sf)).select(
        "doc_id", "is_invoice", "confidence", "reason", "doc_kind", "detected_vendor", "detected_invoice_number")


@register("classify_documents")
def q_classify_documents(spark, sf):
    """Prose and invoices, mixed."""
    inv = fx.invoice_text(spark, sf).select("doc_id", F.col("text").alias("invoice"))
    mixed = fx.ocr_text(spark, sf).join(inv, "doc_id", "left").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, F.coalesce("invoice", "text")).otherwise(F.col("text")).alias("text"))
    return cl.classify_rules(mixed).select("doc_id", "is_invoice", "confidence", "reason")


@register("classification_defaults")
def q_classification_defaults(spark, sf):
    c = cl.classify_rules(fx.invoice_text(spark, sf))
    k = F.col("doc_id")
    js = (F.when(k % 11 == 0, F.lit(None).cast("string"))
           .when(k % 7 == 0, F.to_json(F.struct("is_invoice", "confidence")))
           .when(k % 5 == 0, F.to_json(F.struct("confidence", "reason")))
           .otherwise(F.to_json(F.struct("is_invoice", "confidence", "reason"))))
    return cl.classification_defaults(c.select("doc_id", js.alias("classification_json"))).select(
        "doc_id", "is_invoice", "confidence", "reason")


@register("classify_invoice_learned")
def q_classify_invoice_learned(spark, sf):
    """I4 learned: invoices and prose, each scored by a model that has not seen it."""
    inv = fx.invoice_text(spark, sf).select(F.concat(F.lit("i"), "doc_id").alias("doc"), "text")
    docs = inv.unionByName(fx.ocr_text(spark, sf).select(F.concat(F.lit("d"), "doc_id").alias("doc"), "text"))
    voted = _written(cl.weak_labels(docs), "weak-labels")
    return cl.learned_out_of_fold(voted, "doc").select("doc", "fold", "label", "p_invoice", "predicted")


def _notify_inputs(spark, sf):
    outcomes = _stand_in_outcomes(spark, sf).select("message_id", "att_id", F.col("name").alias("filename"),
                                                    "reason", "is_valid")
    msgs = ml.with_sender_defaults(_window_messages(spark, sf)).select(
        F.col("id").alias("message_id"), "subject", "sender_name")
    return msgs, outcomes


@register("rejection_table")
def q_rejection_table(spark, sf):
    _, outcomes = _notify_inputs(spark, sf)
    return nt.rejection_table(outcomes)


@register("compose_notifications")
def q_compose_notifications(spark, sf):
    msgs, outcomes = _notify_inputs(spark, sf)
    return nt.compose_notifications(msgs, outcomes, fx.AS_OF_MAIL)


@register("long_date_format")
def q_long_date_format(spark, sf):
    m = fx.messages(spark, sf)
    return m.select("id", nt.long_date_col("received_at").alias("received_long"))


# ---------------------------------------------------------------------------------------------
# composite pipelines (J2-J4), sinks (B1, B3-B5), batch summary (E5)
# ---------------------------------------------------------------------------------------------
from paperlane.operators import sinks as sk  # noqa: E402
from paperlane.plans import pipelines as pl  # noqa: E402

RUN_AS_OF = fx.AS_OF_BLOB


EXTRACTED = [(f, "string" if f not in ("totalInvoiceAmount", "taxAmount", "vatTaxAmount", "totalNetAmount", "taxPercentage",
                                       "vatPercentage", "withholdingPercentage") else "decimal(18,2)")
             for f in ex.BASELINE_FIELDS + ex.DETAIL_FIELDS if f != "invoiceLineItems"]
ITEM_RECORD = "array<struct<" + ", ".join(
    f"{f}: " + {"quantity": "decimal(18,3)", "unitPrice": "decimal(18,4)"}.get(f, "decimal(18,2)" if f.endswith(("Amount", "Percentage")) else "string")
    for f in ex.ITEM_FIELDS) + ">>"
EXTRACTED.append(("invoiceLineItems", ITEM_RECORD))


def _folder(spark, tag: str) -> str:
    """A new folder for a sink query, in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def _ocr_texts(spark, sf):
    return fx.ocr_pairs(spark, sf).select(
        "doc_id", "original_text",
        F.when(F.col("doc_id") % 13 == 0, F.lit("  ")).otherwise(F.col("ocr_text")).alias("ocr_text"))


def _ocr_outcomes(spark, sf, force=True):
    texts = _ocr_texts(spark, sf)
    return pl.ocr_batch_outcomes(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), fx.target_blobs(spark, sf, fx.AS_OF_BLOB), texts, 24,
                                 fx.AS_OF_BLOB, force_img_processing=force)


@register("ocr_batch_outcomes")
def q_ocr_batch_outcomes(spark, sf):
    return _ocr_outcomes(spark, sf, force=False)


def _written(df, tag):
    """An outcome table, written once and read by all that follows from it."""
    path = _folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register("ocr_batch_log")
def q_ocr_batch_log(spark, sf):
    return pl.ocr_batch_log(_written(_ocr_outcomes(spark, sf), "ocr-outcomes"), "ocr-20240110-120000-000000", RUN_AS_OF)


@register("ocr_batch_containers")
def q_ocr_batch_containers(spark, sf):
    """The files that a run puts into the target and the failed container, read again."""
    texts = _ocr_texts(spark, sf).withColumns({"original": F.encode("original_text", "UTF-8"), "ocr_output": F.encode("ocr_text", "UTF-8")})
    paths = pl.run_ocr_batch(fx.source_blobs(spark, sf, fx.AS_OF_BLOB), fx.target_blobs(spark, sf, fx.AS_OF_BLOB), texts, 24, fx.AS_OF_BLOB,
                             _folder(spark, "ocr-run"))
    return spark.read.parquet(paths["containers"]).select("container", "blob_name", "doc_id", "error", F.length("content").cast("long").alias("n_bytes"),
                                                          F.sha2("content", 256).alias("content_sha256"))


@register("dead_letter")
def q_dead_letter(spark, sf):
    """B4, written and read again."""
    out = _folder(spark, "dead-letters")
    sk.write_with_dead_letters(_ocr_outcomes(spark, sf), out, "run-1")
    return sk.read_dead_letters(spark, out).select("doc_id", "name", "failed_name", "error")


def _scan(spark, sf):
    return pl.email_scan_outcomes(fx.messages(spark, sf), fx.attachments_with_text(spark, sf), MAIL_ALL_H,
                                  fx.AS_OF_MAIL)


@register("email_scan_outcomes")
def q_email_scan_outcomes(spark, sf):
    return _scan(spark, sf)


@register("email_scan_notifications")
def q_email_scan_notifications(spark, sf):
    return pl.email_scan_notifications(fx.messages(spark, sf), _scan(spark, sf), fx.AS_OF_MAIL).select(
        "message_id", "kind", "valid_count", "invalid_count", "subject")


@register("email_scan_summary")
def q_email_scan_summary(spark, sf):
    return pl.email_scan_summary(fx.messages(spark, sf), _scan(spark, sf), MAIL_ALL_H, fx.AS_OF_MAIL)


@register("append_process_log")
def q_append_process_log(spark, sf):
    return pl.email_scan_log(fx.messages(spark, sf), _written(_scan(spark, sf), "scan-outcomes"), MAIL_ALL_H, fx.AS_OF_MAIL,
                             "email-20010801-000000-000000")


@register("email_scan_containers")
def q_email_scan_containers(spark, sf):
    """The files that a run puts into the raw and the invalid container, read again."""
    atts = fx.attachments_with_text(spark, sf, payload=True)
    paths = pl.run_email_scan(fx.messages(spark, sf), atts, MAIL_ALL_H, fx.AS_OF_MAIL, _folder(spark, "scan-run"))
    return spark.read.parquet(paths["containers"]).select("container", "blob_name", "message_id", "att_id", "content_type",
                                                          F.sha2("content", 256).alias("content_sha256"))


def _payloads(spark, sf):
    """Invoices and prose, mixed; some payloads are blank."""
    invoices = fx.itemised_invoice_text(spark, sf).select("doc_id", F.col("text").alias("invoice"))
    d = fx.ocr_text(spark, sf).join(invoices, "doc_id", "left").select(
        F.col("filename").alias("name"),
        F.when(F.col("doc_id") % 2 == 0, F.coalesce("invoice", "text")).otherwise(F.col("text")).alias("text"))
    return d.withColumn("text", F.when(F.col("name").contains("_13"), F.lit(" ")).otherwise(F.col("text")))


def _batch(spark, sf):
    return pl.translate_batch(fx.source_blobs(spark, sf), fx.translated_blobs(spark, sf), _payloads(spark, sf))


@register("translate_batch_results")
def q_translate_batch_results(spark, sf):
    b = _batch(spark, sf)
    x = F.from_json("extracted_json", "invoiceNumber string, invoiceDate string, doctype string, "
                                      "invoiceType string, currency string")
    return b.select("name", "success", "translated_blob", "json_blob", "error", "skipped",
                    x["invoiceNumber"].alias("invoiceNumber"), x["invoiceDate"].alias("invoiceDate"),
                    x["doctype"].alias("doctype"), x["invoiceType"].alias("invoiceType"),
                    x["currency"].alias("currency"))


@register("validate_batch")
def q_validate_batch(spark, sf):
    """I10 over what J4 extracts."""
    ok = _batch(spark, sf).where(F.col("success") & ~F.col("skipped"))
    return ex.validate_extraction(ok, "extracted_json").select("name", "n_violations", "violations")


@register("translate_batch_log")
def q_translate_batch_log(spark, sf):
    return pl.translate_batch_log(_batch(spark, sf), "translation-20240110-120000-000000", RUN_AS_OF)


@register("batch_summary")
def q_batch_summary(spark, sf):
    return pl.batch_summary(_batch(spark, sf))


@register("failed_results")
def q_failed_results(spark, sf):
    return _batch(spark, sf).where(~F.col("success")).select("name", "error")


@register("translate_exit_status")
def q_translate_exit_status(spark, sf):
    return ml.exit_status(_batch(spark, sf), ~F.col("success"))


@register("write_extraction_json")
def q_write_extraction_json(spark, sf):
    ok = _batch(spark, sf).where(F.col("success") & ~F.col("skipped"))
    out = _folder(spark, "extraction-json")  # B3, every extracted field, written and read again
    record = ", ".join(f"{f} {t}" for f, t in EXTRACTED)
    rows = ok.select("json_blob", F.from_json("extracted_json", record).alias("x")).select("json_blob", "x.*")
    sk.write_extraction_json(rows, out, "run-1")
    return sk.read_extraction_json(spark, out)


@register("overwrite_by_key")
def q_overwrite_by_key(spark, sf):
    """B1: two runs written one after the other, the present state read again."""
    out, writes = _folder(spark, "blobs"), fx.blob_writes(spark, sf)
    for run in (0, 1):
        state = sk.overwrite_by_key(writes.where(F.col("message_id") % 2 == run), out, f"run-{run}")
    return state.select("container", "name", "written_at", "att_id")


@register("sealed_workflow_totals")
def q_sealed_workflow_totals(spark, sf):
    """Totals of 30 whole days from sealed days' sums and the raw rows of the open one."""
    from paperlane.operators.sealed import SealedCounts

    out, last = _folder(spark, "sealed"), fx.AS_OF_LOG.date()
    sk.append_process_log(fx.process_log(spark, sf), f"{out}/log")
    sealed = SealedCounts(spark, f"{out}/log", f"{out}/sums")
    sealed.seal(last)
    return sealed.workflow_totals(last - dt.timedelta(days=29), last)


# ---------------------------------------------------------------------------------------------
# streaming batch twins (K1, K2, K3, K5, K6)
# ---------------------------------------------------------------------------------------------
from paperlane.streaming import jobs as sj  # noqa: E402


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@register("stream_lineage_counts")
def q_stream_lineage_counts(spark, sf):
    return _ntz(sj.lineage_window_counts(fx.process_log(spark, sf)), "window_start", "window_end")


@register("stream_new_documents")
def q_stream_new_documents(spark, sf):
    page1 = fx.source_blobs(spark, sf).select(*LISTING_COLS)
    page2 = fx.source_blobs(spark, sf, as_of=fx.AS_OF_BLOB.replace(hour=6)).select(*LISTING_COLS)
    again = page1.where(F.col("size") % 10 == 0).withColumn(
        "last_modified", F.col("last_modified") + F.expr("INTERVAL 1 DAY"))  # uploaded once more
    out = sj.new_documents(page1.unionByName(page2).unionByName(again))
    return _ntz(out, "last_modified").select("container", "name", "last_modified")


@register("stream_skip_processed")
def q_stream_skip_processed(spark, sf):
    return sj.skip_processed(fx.source_blobs(spark, sf), fx.translated_blobs(spark, sf)).select("name")


@register("stream_first_of_target")
def q_stream_first_of_target(spark, sf):
    """K3 batch twin: scans of a document in several languages have one target."""
    src = fx.source_blobs(spark, sf).select(*LISTING_COLS)
    other = src.where(F.col("size") % 3 == 0).withColumns({
        "name": F.regexp_replace("name", "_[a-z]{2}([.])", "_xx$1"), "last_modified": F.col("last_modified") - F.expr("INTERVAL 1 HOUR")})
    todo = sj.skip_processed(sj.first_of_target(src.unionByName(other)), fx.translated_blobs(spark, sf))
    return _ntz(todo, "last_modified").select("name", "last_modified")


@register("stream_late_reconcile")
def q_stream_late_reconcile(spark, sf):
    src = fx.source_blobs(spark, sf, as_of=None)
    emitted = fx.source_blobs(spark, sf, as_of=fx.AS_OF_BLOB)
    return sj.late_reconcile(src, emitted).select("name", "last_modified")


@register("stream_run_sessions")
def q_stream_run_sessions(spark, sf):
    return _ntz(sj.run_sessions(fx.process_log(spark, sf)), "session_start", "session_end")


# ---------------------------------------------------------------------------------------------
# injected document function (L1-L3)
# ---------------------------------------------------------------------------------------------
from pyspark.sql import types as T  # noqa: E402

from paperlane.operators import injected as inj  # noqa: E402


def _measure_service(batch):
    """Stand-in for a per-document service: text length in characters."""
    import pandas as pd

    return pd.DataFrame({"n_chars": batch["text"].fillna("").str.len().astype("int64")})


@register("injected_document_function")
def q_injected_document_function(spark, sf):
    d = fx.ocr_text(spark, sf)
    schema = T.StructType([T.StructField("n_chars", T.LongType())])
    return inj.apply_document_fn(d, _measure_service, ["text"], schema, keep_cols=["doc_id"], policy=inj.NO_WAIT)


def _refusing_service(batch):
    """As :func:`_measure_service`, but it refuses documents with an id that ends in 7."""
    if (batch["doc_id"] % 10 == 7).any():
        raise ValueError("document refused")
    return _measure_service(batch)


def _measure_one(row):
    """As :func:`_refusing_service` for one document."""
    if row["doc_id"] % 10 == 7:
        raise ValueError("document refused")
    return {"n_chars": len(row["text"] or "")}


@register("concurrent_calls")
def q_concurrent_calls(spark, sf):
    """L1 and L2 for a service that takes one document a call: five at once, in order."""
    out = inj.apply_concurrently(fx.ocr_text(spark, sf), _measure_one, ["doc_id", "text"],
                                 T.StructType([T.StructField("n_chars", T.LongType())]), keep_cols=["doc_id"],
                                 policy=inj.CallPolicy(max_attempts=2, base_delay=0.0), limits=inj.Limits(deadline=600.0))
    return out.select("doc_id", "n_chars", "error", "attempts")


@register("call_policy")
def q_call_policy(spark, sf):
    """L2 through L1: a batch that fails is tried again row by row; a refused
    document costs its own result only."""
    schema = T.StructType([T.StructField("n_chars", T.LongType())])
    policy = inj.CallPolicy(max_attempts=2, base_delay=0.0)
    out = inj.apply_document_fn(fx.ocr_text(spark, sf), _refusing_service, ["doc_id", "text"], schema,
                                keep_cols=["doc_id"], policy=policy)
    return out.select("doc_id", "n_chars", "error")


# ---------------------------------------------------------------------------------------------
# remaining inventory items under their own names
# ---------------------------------------------------------------------------------------------
@register("scan_documents")
def q_scan_documents(spark, sf):
    """A2: each payload read once; its byte length and the empty-payload guard."""
    d = fx.ocr_text(spark, sf)
    n_bytes = F.octet_length(F.col("text"))
    return d.select(F.col("filename").alias("name"), F.coalesce(n_bytes, F.lit(0)).alias("n_bytes"),
                    (F.coalesce(n_bytes, F.lit(0)) == 0).alias("is_empty"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))


@register("period_filter")
def q_period_filter(spark, sf):
    """Rows selected by each period predicate."""
    log = fx.process_log(spark, sf)
    counts = log.agg(*(F.count_if(lin.period_predicate(log, p, fx.AS_OF_LOG)).alias(p) for p in vocab.VALID_PERIODS))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(p).alias("period"), F.col(p).alias("n_rows"))
                                            for p in vocab.VALID_PERIODS))))


@register("response_filter_echo")
def q_response_filter_echo(spark, sf):
    """Filters are echoed, not applied (totals equal the unfiltered summary)."""
    return lin.lineage_response(fx.process_log(spark, sf), "overall", fx.AS_OF_LOG, country_code="TR",
                                source_lang="tr")


@register("outcome_join")
def q_outcome_join(spark, sf):
    """Per-message outcome counts re-attached to the message header."""
    roll = ml.message_rollup(_stand_in_outcomes(spark, sf))
    head = ml.with_sender_defaults(fx.messages(spark, sf)).select(
        F.col("id").alias("message_id"), "subject", "sender_email", "sender_name")
    return roll.join(head, "message_id", "inner")


@register("order_messages_newest_first")
def q_order_messages_newest_first(spark, sf):
    """the whole window sorted newest first (a distributed range sort)."""
    return ml.scan_messages(fx.messages(spark, sf), MAIL_ALL_H, fx.AS_OF_MAIL).select("id", "received_at")


@register("run_id_format")
def q_run_id_format(spark, sf):
    """Run ids from log timestamps."""
    log = fx.process_log(spark, sf)
    return log.select("run_id", "step_name", "logged_at", lin.run_id_for("ocr", F.col("logged_at")).alias("new_run_id"))


@register("parse_lookback_param")
def q_parse_lookback_param(spark, sf):
    """Lookback parameters as sent (empty, junk, numbers) parsed with a default."""
    ev = fx.read_table(spark, sf, "events")
    k = F.regexp_extract("props", r"(\d+)", 1)
    raw = (F.when(F.col("event_id") % 5 == 0, F.lit("")).when(F.col("event_id") % 5 == 1, F.lit("abc"))
            .otherwise(F.concat(k, F.lit("."), (F.col("event_id") % 10).cast("string"))))
    return ev.select("event_id", raw.alias("raw"), lin.parse_lookback(raw, 0.5).alias("lookback_hours"))


@register("summary_strings")
def q_summary_strings(spark, sf):
    """The operator-facing summary lines of a scan and of a batch."""
    s = ml.scan_summary(_window_messages(spark, sf), _stand_in_outcomes(spark, sf))
    return s.select(
        F.format_string("messages=%d valid=%d invalid=%d", "messages_scanned", "valid_invoices",
                        "invalid_invoices").alias("scan_line"),
        F.format_string("Processed %d file(s).", "total_attachments").alias("files_line"))


@register("stream_route")
def q_stream_route(spark, sf):
    """K4 batch twin: the rows the routing sink writes, by container."""
    new = sj.new_documents(fx.source_blobs(spark, sf).select(*LISTING_COLS))
    todo = sj.skip_processed(new, fx.translated_blobs(spark, sf))
    out = _folder(spark, "routed")
    sj.route_sink(out)(todo.select(*LISTING_COLS), 0)
    return spark.read.parquet(out).select("container", "name")


@register("structured_output_schema")
def q_structured_output_schema(spark, sf):
    """L3: model JSON parsed with the type derived from the JSON schema."""
    p = fx.extraction_json(spark, sf).select("doc_id", F.from_json("details_json", ex.DETAILS_TYPE).alias("d"))
    return p.select("doc_id", F.col("d.doctype").alias("doctype"), F.col("d.currency").alias("currency"),
                    F.col("d.purchaseOrderNumber").alias("purchaseOrderNumber"),
                    ex.money(F.col("d.vatTaxAmount")).alias("vatTaxAmount"),
                    F.size(F.coalesce("d.invoiceLineItems", F.array())).alias("n_items"))
