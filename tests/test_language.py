"""Scripts without word spaces, short texts, profiles from a labelled table."""
import pytest
from pyspark.sql import functions as F

from paperlane import langdata
from paperlane.operators import language as lg
from paperlane.plans import queries as q

from .conftest import SF_ORACLE, one_col

CASES = {
    "ja": ["請求書番号をご確認ください", "お支払いは三十日以内にお願いします", "カタカナ"],
    "zh": ["你好", "发票号码和日期", "请在三十天内付款"], "ko": ["청구서 번호", "결제해 주세요"],
    "ru": ["Счёт на оплату", "номер счета и дата", "Оплатите в течение тридцати дней"], "uk": ["Рахунок на оплату їжі", "Кількість і ціна"],
    "bg": ["Фактура за плащане въз основа на договор"], "sr": ["Рачун за плаћање љубичасто"], "ar": ["رقم الفاتورة", "يرجى الدفع خلال ثلاثين يوما"],
    "fa": ["شماره فاکتور پرداخت چک"], "el": ["Τιμολόγιο"], "he": ["חשבונית מס"], "th": ["ใบแจ้งหนี้"], "hi": ["चालान संख्या"],
    "tr": ["Fatura numarası", "Ödeme", "Kargo ürünleri on gün içinde teslim alındı", "sipariş tarihi"],
    "de": ["Rechnung", "Bitte überweisen", "Lieferschein Nummer", "offener Betrag"], "en": ["Invoice number", "payment terms", "unit price"],
    "fr": ["Numéro de facture", "bon de commande", "échéance du paiement"], "es": ["número de factura", "fecha de entrega", "dirección del cliente"],
    "xx": ["", "   ", None, "12 34", "x", "hello", "漢", "§ — “€”"],
}


@pytest.fixture(scope="module")
def got(spark):
    texts = [t for ts in CASES.values() for t in ts]
    rows = lg.detect_language(one_col(spark, texts, "text")).select("text", "lang_code").collect()
    return {r.text: r.lang_code for r in rows}


@pytest.mark.parametrize("lang", CASES)
def test_short_texts(got, lang):
    assert [got[t] for t in CASES[lang]] == [lang] * len(CASES[lang])  # all of them: accuracy 1 per language


def test_mixed_scripts_go_by_most_letters(spark):
    texts = ["The invoice for the goods is on the table 你好", "请在三十天内付款给供应商 invoice", "номер счета и дата 漢字"]
    assert [r.lang_code for r in lg.detect_language(one_col(spark, texts, "text")).collect()] == ["en", "zh", "ru"]


def test_scripts_over_whole_documents(spark):
    """Cyrillic, kana, Han, Arabic and Hangul stand-ins of the documents' letters."""
    rows = q.q_detect_language_scripts(spark, SF_ORACLE).join(spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", F.length("text").alias("n")), "doc_id")
    for i, langs in enumerate([("ru", "bg", "uk"), ("ja",), ("zh",), ("ar", "fa", "ur"), ("ko",)]):
        found = rows.where((F.col("doc_id") % 6 == i) & (F.col("n") >= 30))
        right = found.where(F.col("lang_code").isin(*langs)).count()
        assert right >= 0.95 * found.count() > 0


def test_learned_profiles_on_held_out_documents(spark):
    rows = {r.lang: r for r in q.q_language_profile_accuracy(spark, SF_ORACLE).collect()}
    assert set(rows) == {"en", "de", "fr", "es"}
    assert all(r.n_correct >= 0.97 * r.n_docs for r in rows.values())


def test_profiles_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "ab ab cd", "aa"), (2, None, "bb"), (3, "xy", None), (4, "", "cc")], "id int, text string, lang string")
    prof = lg.learn_profiles(df, most=3)
    rows = prof.collect()
    assert {r.lang for r in rows} == {"aa"} and len(rows) == 4 and sum(r.gram is None for r in rows) == 1
    out = {r.id: (r.detected, r.margin) for r in lg.detect_by_profile(df, prof, "id").collect()}
    assert out == {1: ("aa", 0), 3: ("aa", 0)}  # texts without letters have no row; a single language has no lead
    assert lg.detect_by_profile(df, prof.limit(0), "id").count() == 0


def test_samples_weigh_every_language():
    profiles = lg.sample_profiles()
    assert set(profiles) == set(langdata.SAMPLES) == set(lg.LANGS)
    assert all(none < min(table.values()) for table, none in profiles.values())
