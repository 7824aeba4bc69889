"""The learned classifier: votes of the rules, held-out figures, calibration."""
from pyspark.sql import functions as F

from paperlane.operators import classify as cl
from paperlane.plans import queries as q

from .conftest import SF_SMALL, one_col

INVOICE = "INVOICE\nInvoice No: INV-77\nInvoice Date: 03-02-2024\nVendor: Acme Ltd\nTotal: 5.00"


def test_votes(spark):
    texts = [INVOICE, INVOICE.replace("INVOICE", "DELIVERY NOTE", 1), "just words", INVOICE.replace("Vendor: ", ""), ""]
    assert [r.label for r in cl.weak_labels(one_col(spark, texts, "text")).collect()] == [1, 0, 0, None, 0]


def test_held_out_precision_and_recall(spark):
    out = q.q_classify_invoice_learned(spark, SF_SMALL)
    assert out.count() == out.select("doc").distinct().count() == 1700 and out.select("fold").distinct().count() == 3
    r = out.where("label is not null").agg(
        F.count_if((F.col("predicted") == 1) & (F.col("label") == 1)).alias("hit"), F.sum("predicted").alias("taken"), F.sum("label").alias("yes")).first()
    assert r.yes > 1000 and r.hit >= 0.97 * r.taken and r.hit >= 0.97 * r.yes
    notes = out.where("label = 0 and doc like 'i%'")
    assert notes.count() > 100 and notes.where("predicted = 0").count() >= 0.9 * notes.count()


def test_a_table_of_one_label_scores_nothing(spark):
    rows = [(str(i), "some words", 0) for i in range(9)] + [("x", None, None)]
    out = cl.learned_out_of_fold(spark.createDataFrame(rows, "doc string, text string, label int"), "doc").collect()
    assert len(out) == 10 and all(r.predicted == 0 and r.p_invoice == 0 for r in out)


def test_calibration_is_monotone():
    table, cut = cl.calibration({0: (0, 10), 3: (5, 10), 4: (2, 10), 9: (10, 10)}, 10)
    assert table == sorted(table) and table[3] == table[4] == 7 / 20 and table[9] == 1 and cut in (3, 9)
    assert cl.calibration({}, 4) == ([0.0] * 4, 4)
