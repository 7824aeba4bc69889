"""Line items from text: the parser's cases, and what J4 makes of them."""
import decimal
import json

import pytest
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.operators import classify as cl
from paperlane.operators import extract as ex
from paperlane.operators import lineitems as li
from paperlane.plans import queries as q
from paperlane.sources import fixtures as fx

from .conftest import SF_SMALL, one_col

HEAD = "No  Description  Qty  Unit  Unit price  VAT %  Net amount\n"


def found(spark, text, fields=("lineNumber", "description", "quantity", "unitOfMeasure", "unitPrice", "vatPercentage", "netAmount")):
    rows = ex.extract_line_items(one_col(spark, [text], "text").withColumn("doc_id", F.lit(1))).collect()
    return [tuple(float(r[f]) if isinstance(r[f], decimal.Decimal) else r[f] for f in fields) for r in rows]


@pytest.mark.parametrize("line, want", [
    ("1  Steel rods 10 mm 10 EA 1,234.50 18% 12,345.00", ("1", "Steel rods 10 mm", 10, "EA", 1234.5, 18, 12345)),
    ("1. Steel rods 10 mm 10 EA 1.234,50 18 % 12.345,00", ("1", "Steel rods 10 mm", 10, "EA", 1234.5, 18, 12345)),
    ("1) Cable 1.200 m 1,5 1.800,00", ("1", "Cable", 1200, "M", 1.5, 0, 1800)),
    ("1 Cable 1,200 m 1.5 1,800.00", ("1", "Cable", 1200, "M", 1.5, 0, 1800)),
    ("1 Freight $3 €50.00 TRY 150.00", ("1", "Freight", 3, "", 50, 0, 150)),
    ("1 Printing of\nspring 24\ncatalogues 4 HUR 25,00 8% 100,00", ("1", "Printing of spring 24 catalogues", 4, "HUR", 25, 8, 100)),
    ("1 Pumps 2 EA 5.00 10.00\n   as agreed", ("1", "Pumps as agreed", 2, "EA", 5, 0, 10)),
    ("1 Pumps 2 EA 10.00", ("1", "Pumps", 2, "EA", 5, 0, 10)),  # no price: from amount and quantity
    ("1 Returned pumps 2 EA -5.00 -10.00", ("1", "Returned pumps", 2, "EA", -5, 0, -10))])
def test_lines(spark, line, want):
    assert found(spark, "INVOICE\n" + HEAD + line + "\nPayment within 30 days\nTotal: 5 items") == [want]


def test_a_table_is_needed_and_ends_with_a_total(spark):
    assert found(spark, "1 Steel 2 EA 5.00 10.00") == []
    text = HEAD + "1 Steel 2 EA 5.00 10.00\nSubtotal 10.00\n2 Iron 1 EA 5.00 5.00"
    assert [x[0] for x in found(spark, text)] == ["1"]
    again = text + "\n" + HEAD + "1 Wool 3 KG 1.00 3.00\n300 dpi 2\n2 Wood 1 EA 4.00 4.00"
    assert [x[1] for x in found(spark, again)] == ["Steel", "Wool", "Wood"]


def test_columns_that_a_table_lacks(spark):
    assert found(spark, "Item Description Amount\n1 Cleaning 500.00\n2 Meals 8% 1.000,50", ("quantity", "unitPrice", "netAmount")) == [
        (1, 500, 500), (1, 1000.5, 1000.5)]
    assert found(spark, "description quantity price\n1 pump 2 7.25", ("quantity", "unitPrice", "netAmount")) == [(2, 7.25, 14.5)]
    assert found(spark, "No Description Quantity VAT % Net amount\n1 Rods 12 mm 30 5% 60.00", ("description", "quantity", "unitPrice")) == [
        ("Rods 12 mm", 30, 2)]


def test_rates_come_from_the_line_or_the_invoice(spark):
    text = "VAT rate: 20%\nTax 5%: 9.00\nWithholding 2%\n" + HEAD + "1 A one 1 EA 10.00 8% 10.00\n2 B two 1 EA 10.00 10.00"
    got = found(spark, text, ("vatPercentage", "vatAmount", "taxPercentage", "taxAmount", "withholdingPercentage"))
    assert got == [(8, 0.8, 5, 0.5, 2), (20, 2, 5, 0.5, 2)]


def test_arithmetic_is_checked(spark):
    text = HEAD + "1 A one 2 EA 10.00 20.00\n2 B two 2 EA 10.00 30.00\n3 C three 2 EA 20.00"
    assert found(spark, text, ("agrees",)) == [(True,), (False,), (None,)]


@pytest.mark.parametrize("text, want", [("Printing of brochures", "PRINTING_PUBLISHING"), ("Freight for printing of booklet", "PRINTING_PUBLISHING"),
                                        ("freight, steel", "TRANSPORT_FREIGHT"), ("scrap metal", "METALS_SCRAP"), ("", "OTHER_SERVICES"),
                                        ("consulting", "OTHER_SERVICES")])
def test_category(spark, text, want):
    assert one_col(spark, [text]).select(li.category(F.col("v"))).first()[0] == want


def test_every_category_has_keywords_of_its_own():
    words = [w for ws in li.CATEGORY_KEYWORDS.values() for w in ws]
    assert len(words) == len(set(words))
    assert [*li.CATEGORY_KEYWORDS, li.OTHER_CATEGORY] == list(vocab.LINE_ITEM_CATEGORIES)


def test_odd_texts(spark):
    rows = ["", None, "\n\n", HEAD, HEAD + "1 nothing", "x " * 5000, HEAD + "\n".join(f"{i} Pump 1 EA 2.00 2.00" for i in range(1, 400))]
    df = one_col(spark, rows, "text").withColumn("doc_id", F.monotonically_increasing_id())
    assert ex.extract_line_items(df).count() == 399


def test_every_line_of_the_fixture_is_found(spark):
    got = ex.extract_line_items(fx.itemised_invoice_text(spark, SF_SMALL))
    lines, parts = (fx.read_table(spark, SF_SMALL, t) for t in ("lineitem", "part"))
    cents = F.floor("l_quantity") * F.floor(F.col("p_retailprice") * 100 + 0.5)
    want = lines.join(parts, lines.l_partkey == parts.p_partkey).agg(
        F.count(F.lit(1)), F.sum(F.floor("l_quantity")), F.sum(cents)).first()
    have = got.agg(F.count(F.lit(1)), F.sum("quantity").cast("long"), (F.sum("netAmount") * 100).cast("long")).first()
    assert tuple(have) == tuple(want) and got.filter(~F.col("agrees")).count() == 0


def test_records_of_a_batch_hold_their_items_and_pass(spark):
    rows = q.q_write_extraction_json(spark, SF_SMALL).collect()
    records = [json.loads(r.json) for r in rows]
    assert all(set(r) >= set(ex.BASELINE_FIELDS) and "invoiceLineItems" in r for r in records)
    items = [x for r in records for x in r["invoiceLineItems"]]
    assert items and all(x["category"] in vocab.LINE_ITEM_CATEGORIES and set(vocab.LINE_ITEM_REQUIRED) <= set(x) for x in items)
    checked = q.q_validate_batch(spark, SF_SMALL).collect()
    assert any(r.n_violations == 0 for r in checked) and not any("lineItem" in r.violations for r in checked)


INVOICE = "INVOICE\nInvoice No: INV-77\nInvoice Date: 03-02-2024\nVendor: Acme Ltd\n"


@pytest.mark.parametrize("text, want", [
    (INVOICE + "Grand Total: 5.00", True), (INVOICE + HEAD + "1 Pump 2 EA 5.00 10.00", True), (INVOICE + "2 pumps", False),
    ((INVOICE + "Total: 5.00").replace("INVOICE", "DELIVERY NOTE", 1), False), ((INVOICE + "Total: 5.00").replace("INVOICE", "Service contract", 1), False),
    ((INVOICE + "Total: 5.00").replace("INVOICE", "Packing Slip", 1), False), ("Acme Ltd\n\nReceipt\n" + INVOICE[8:] + "Total: 5.00", False),
    (INVOICE + "Purchase Order: 4500000001\nTotal: 5.00\nDelivery note\nsee the contract", True),
    ("Invoice for receipt 7\n" + INVOICE[8:] + "Purchase order\nTotal: 5.00", True)])
def test_titles_reject(spark, text, want):
    r = cl.classify_rules(one_col(spark, [text], "text")).first()
    assert r.is_invoice is want, r.reason


@pytest.mark.parametrize("text, want", [
    ("Total: 5 Items\nTotal: 1,200.50 TRY", "1200.50"), ("Total 120.00 euro", "120.00"), ("Total: 7 documents\nTotal: $80", "80.00"),
    ("Total: 3\nTotal: 12,50", "12.50"), ("Total EUR 1.200,50", "1200.50"), ("Total: 4 Pieces", None), ("Total\n5.00", None),
    ("Total: 80 Acme", "80.00")])
def test_amounts_and_counts(spark, text, want):
    got = one_col(spark, [text]).select(ex.amount_after(F.col("v"), ("total",))).first()[0]
    assert got == (want and decimal.Decimal(want))


def test_type_keywords_count_in_the_title(spark):
    lines = ["Acme", "a", "b", "c", "d", "Dekont e-Serbest Meslek Makbuzu"]
    rows = ["Dekont\nAcme", "\n".join(lines), "e-Serbest Meslek Makbuzu no 5"]
    got = one_col(spark, rows).select(ex.invoice_type("v", F.lit("TRY"))).collect()
    assert [r[0] for r in got] == ["RECEIPT", "STANDARD", "FREELANCE_INVOICE"]
