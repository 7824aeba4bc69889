import datetime as dt

from paperlane.operators import mail as ml
from paperlane.operators import notify as nt


def _compose(spark, sender, subject, outcomes):
    msgs = spark.createDataFrame([(1, subject, sender)], "message_id long, subject string, sender_name string")
    out = spark.createDataFrame([(1, f"a{i}", f, v, r) for i, (f, v, r) in enumerate(outcomes)],
                                "message_id long, att_id string, filename string, is_valid boolean, reason string")
    return nt.compose_notifications(msgs, out, dt.date(2024, 1, 10)).first()


def test_success_email(spark):
    r = _compose(spark, "Acme Corp", "Invoice Submission", [("a.pdf", True, "ok"), ("b.pdf", True, "ok"),
                                                            ("c.pdf", True, "ok")])
    assert r.kind == "success" and "3" in r.body_html and "Acme Corp" in r.body_html
    assert r.subject.startswith("RE: Invoice Submission")


def test_full_failure_lists_all(spark):
    r = _compose(spark, "Vendor Ltd", "Documents", [("delivery_note.pdf", False, "This is a delivery note."),
                                                    ("brochure.pdf", False, "Marketing brochure.")])
    assert "delivery_note.pdf" in r.body_html and "brochure.pdf" in r.body_html and "Action Required" in r.subject


def test_partial_failure_and_escaping(spark):
    r = _compose(spark, "Supplier <Inc>", "Monthly Docs", [("invoice_001.pdf", True, "Valid invoice."),
                                                           ("packing_list.pdf", False, "Packing list & no amount")])
    assert "invoice_001.pdf" in r.body_html and "packing_list.pdf" in r.body_html
    assert "✅" in r.body_html and "⚠️" in r.body_html
    assert "&amp; no amount" in r.body_html and "Supplier &lt;Inc&gt;" in r.body_html


def test_attachment_filter_and_rollup(spark):
    att = spark.createDataFrame([
        (1, "a", "f.pdf", "application/pdf", 500, None, True),
        (1, "b", "logo.png", "IMAGE/PNG; x", 500, False, True),
        (1, "c", "tiny.pdf", "application/pdf", 99, False, True),
        (1, "d", "inline.pdf", "application/pdf", 500, True, True),
        (2, "e", "x.pdf", None, None, None, False),
    ], "message_id long, att_id string, name string, content_type string, size long, is_inline boolean, "
       "is_valid boolean")
    usable = ml.usable_attachments(att)
    assert sorted(r.att_id for r in usable.collect()) == ["a"]
    roll = {r.message_id: r for r in ml.message_rollup(att).collect()}
    assert roll[1].all_valid and not roll[1].all_invalid and roll[2].all_invalid
