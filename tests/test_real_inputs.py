"""Inputs as they come: text message ids, broken JSON, failing translators,
empty worklists, whole texts, amounts in both styles, chance words."""
import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from paperlane.operators import classify as cl
from paperlane.operators import extract as ex
from paperlane.operators import lineage as lin
from paperlane.operators import mail as ml
from paperlane.operators.language import detect_language
from paperlane.operators.translate import NativeTranslator
from paperlane.plans import pipelines as pl
from paperlane.streaming.jobs import new_documents

from .conftest import one_col

INVOICE = "Invoice No: INV-77\nInvoice Date: 03-02-2024\nVendor: Acme Ltd\nGrand Total: 1,200.50\n"


def test_text_message_ids_in_the_scan_summary(spark):
    out = spark.createDataFrame([("AAMk-1=", True), ("AAMk-1=", False), ("AAMk-2=", True)], "message_id string, is_valid boolean")
    s = ml.scan_summary(spark.range(5), out).first()
    assert tuple(s) == (5, 2, 3, 2, 1)


@pytest.mark.parametrize("text, want", [
    ("Total: 5 items\nGrand Total: 1,200.50", "1200.50"), ("Grand total 1.200,50 EUR", "1200.50"),
    ("Total amount: 1.234.567", "1234567.00"), ("Amount due: 12,5", "12.50"), ("Total: 3 pcs", None),
    ("Balance Due: 100%\nTotal: 80", "80.00"), ("Total : -15.5", "-15.50")])
def test_amounts(spark, text, want):
    got = one_col(spark, [text]).select(ex.amount_after(F.col("v"), cl.AMOUNT_LABELS)).first()[0]
    assert got == (want and decimal.Decimal(want))


def test_a_rate_is_no_tax_amount(spark):
    got = one_col(spark, ["Tax 18%: 216.00", "Tax: 18%"]).select(ex.amount_after(F.col("v"), ("tax amount", "tax"))).collect()
    assert [r[0] for r in got] == [decimal.Decimal("216.00"), None]


def test_whole_texts_and_named_kinds(spark):
    filler = "x " * 3000
    texts = [INVOICE.replace("Grand", filler + "\nGrand"), INVOICE + "Purchase Order: 4500000001\nContract no 5",
             "Purchase Order\nNo amounts here"]
    got = cl.classify_rules(one_col(spark, texts, "text")).select("is_invoice", "reason").collect()
    assert [r.is_invoice for r in got] == [True, True, False] and "purchase order" in got[2].reason


def test_languages(spark):
    texts = ["Bu fatura için ödeme yapıldı ve kayıt daha sonra kontrol edildi", "Kargo ürünleri on gün içinde teslim alındı",
             "The cat is on the mat", None, "the " + "qwr " * 300]
    got = [r.lang_code for r in detect_language(one_col(spark, texts, "text")).select("lang_code").collect()]
    assert got == ["tr", "tr", "en", "xx", "xx"]  # the second by its letters: few words, none of them listed
    own = detect_language(one_col(spark, ["ja nee ja"], "text"), function_words={"nl": ("ja", "nee"), "xy": ("zz",)})
    assert own.first().lang_code == "nl"


def test_broken_json_breaks_one_row(spark):
    rows = [(1, "{not json"), (2, None), (3, '{"totalInvoiceAmount": true, "currency": null}')]
    df = spark.createDataFrame(rows, "doc_id long, details_json string")
    got = {r.doc_id: r.violations.split(",") for r in ex.validate_extraction(df).collect()}
    assert "malformed_json" in got[1] and "malformed_json" in got[2] and "malformed_json" not in got[3]
    assert "not_number:totalInvoiceAmount" in got[3]
    assert ex.validate_extraction(df).count() == 3


def test_lookback_numbers(spark):
    got = one_col(spark, ["1d", "2f", "1e1", " 2.5 ", "", None, "nan", "-3"]).select(lin.parse_lookback("v", 0.5)).collect()
    assert [r[0] for r in got] == [0.5, 0.5, 10.0, 2.5, 0.5, 0.5, 0.5, -3.0]


def test_an_empty_worklist_logs_nothing(spark):
    empty = spark.createDataFrame([], "name string, output_name string, error string")
    assert pl.ocr_batch_log(empty, "run", dt.datetime(2024, 1, 1)).count() == 0


def test_a_new_upload_is_a_new_document(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("c", "a", t), ("c", "a", t), ("c", "a", t + dt.timedelta(hours=1)), ("c", "b", t)]
    out = new_documents(spark.createDataFrame(rows, "container string, name string, last_modified timestamp_ntz"))
    assert out.count() == 3


def test_a_failed_translation_has_no_language(spark):
    failing = NativeTranslator(lambda chunk, lang: F.struct(F.lit(None).cast("string").alias("text"),
                                                            F.lit("service down").alias("error")))
    t = dt.datetime(2001, 7, 31)
    messages = spark.createDataFrame([("m1", "s", "n", "a@b", t, True)], "id string, subject string, from_name string, "
                                     "from_address string, received_at timestamp_ntz, has_attachments boolean")
    text = "Los documentos del mes y las facturas para el pago con su firma"
    rows = [("m1", "a1", "x.pdf", "application/pdf", 5000, False, text)]
    atts = spark.createDataFrame(rows, "message_id string, att_id string, name string, content_type string, size long, "
                                       "is_inline boolean, ocr_text string")
    r = pl.email_scan_outcomes(messages, atts, 48, dt.datetime(2001, 8, 1), failing).first()
    assert (r.is_valid, r.lang_code, r.reason) == (False, None, "Processing error: service down")
