"""The schema compiler: types, enums, required, formats, nested arrays."""
import json

import pytest
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.operators import extract as ex
from paperlane.operators import schema as sc

from .conftest import one_col

ITEM = {"lineNumber": "1", "category": "OTHER_SERVICES", "quantity": 2, "unitOfMeasure": "EA", "unitPrice": 1.5, "netAmount": 3, "vatAmount": 0,
        "vatPercentage": 0, "withholdingPercentage": 0}
RECORD = {"doctype": "POI", "invoiceType": "STANDARD", "purchaseOrderNumber": "4500000001", "taxAmount": 1, "vatTaxAmount": 1.25,
          "totalInvoiceAmount": 10, "taxPercentage": 18, "vatPercentage": 8, "currency": "TRY", "invoiceLineItems": [ITEM]}


def broken(spark, texts, schema=None):
    rows = ex.validate_extraction(one_col(spark, texts, "details_json"), schema=schema).collect()
    return [r.violations for r in rows]


@pytest.mark.parametrize("change, want", [
    ({}, ""), ({"doctype": "N/A"}, ""), ({"purchaseOrderNumber": ""}, ""), ({"buyerName": None}, ""), ({"other": [1]}, ""),
    ({"currency": None}, "missing:currency"), ({"totalInvoiceAmount": "10"}, "not_number:totalInvoiceAmount"),
    ({"totalInvoiceAmount": True}, "not_number:totalInvoiceAmount"), ({"doctype": "XXX"}, "enum:doctype"), ({"doctype": 5}, "enum:doctype,not_string:doctype"),
    ({"purchaseOrderNumber": "77"}, "format:purchaseOrderNumber"), ({"invoiceLineItems": {}}, "not_array:invoiceLineItems"),
    ({"invoiceLineItems": []}, ""), ({"invoiceLineItems": [ITEM, 5]}, "not_object:invoiceLineItems"),
    ({"invoiceLineItems": [{**ITEM, "quantity": "abc"}]}, "not_number:invoiceLineItems.quantity"),
    ({"invoiceLineItems": [ITEM, {**ITEM, "category": "NO"}, {**ITEM, "category": "NEITHER"}]}, "enum:invoiceLineItems.category"),
    ({"invoiceLineItems": [{k: v for k, v in ITEM.items() if k != "unitPrice"}]}, "missing:invoiceLineItems.unitPrice"),
    ({"invoiceLineItems": [{**ITEM, "vatAmount": None}]}, "missing:invoiceLineItems.vatAmount")])
def test_details(spark, change, want):
    assert broken(spark, [json.dumps({**RECORD, **change})]) == [want]


def test_what_is_no_record(spark):
    texts = ["[1]", '"text"', "5", "null", "{broken", "", None, "{}"]
    got = broken(spark, texts)
    assert got[:4] == ["not_object:$"] * 4 and got[4:7] == ["malformed_json"] * 3
    assert got[7] == ",".join(sorted(f"missing:{f}" for f in vocab.DETAILS_REQUIRED))


def test_other_schemas(spark):
    schema = {"properties": {"n": {"type": "integer"}, "a": {"type": ["string", "null"]}, "deep": {"type": "object", "properties": {
        "rows": {"type": "array", "items": {"type": "array", "items": {"type": "number"}}}}, "required": ["rows"]}}, "required": ["a"]}
    texts = ['{"n": 1, "a": null}', '{"n": 1.5, "a": "x"}', '{"a": 1}', '{}', '{"a": "", "deep": {}}', '{"a": "", "deep": {"rows": [[1, 2.5], [3]]}}',
             '{"a": "", "deep": {"rows": [[1], ["x"], 7]}}', '{"n": 12345678901234567890, "a": ""}']
    assert broken(spark, texts, schema) == ["", "not_integer:n", "not_string:a", "missing:a", "missing:deep.rows", "",
                                            "not_array:deep.rows,not_number:deep.rows", ""]


def test_the_baseline_needs_both_fields(spark):
    got = broken(spark, ['{"invoiceNumber": "", "invoiceDate": ""}', '{"invoiceNumber": 7}'], ex.baseline_json_schema())
    assert got == ["", "missing:invoiceDate,not_string:invoiceNumber"]


def test_it_is_one_projection(spark):
    df = ex.validate_extraction(one_col(spark, ["{}"], "details_json"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert df.select(F.size(sc.violations(F.col("details_json"), {"properties": {}}))).first()[0] == 0
