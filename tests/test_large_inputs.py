"""What keeps the costly queries linear and cheap by the row: texts and names are searched once, not once for each use."""
from pyspark.sql import functions as F

from paperlane.functions import naming as nm
from paperlane.operators import extract as ex
from tests.conftest import one_col


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_path_is_taken_apart_once(spark):
    names = ["a/b_tr.PDF", "./x//y.z/doc_en.tar.gz", "plain", ".hidden", "dot.", "", None, "a/", "é_de.pdf", "a\nb_fr.pdf"]
    df = one_col(spark, names).withColumn("lang", F.lit("de"))
    out = df.select("v", nm.raw_invoice_blob_name("v", F.col("lang")).alias("raw"), nm.translated_blob_name("v").alias("tr"),
                    nm.json_blob_name("v").alias("js"), nm.clean_stem("v").alias("stem"), nm.dir_prefix("v").alias("dir"),
                    nm.path_suffix(nm.base_name("v")).alias("suffix"))
    for r in out.collect():
        known = r.v is not None
        assert r.raw == (f"{r.dir}{r.stem}_de{r.suffix}" if known else None)
        assert r.tr == (f"{r.dir}{r.stem}_en{r.suffix}" if known else None)
        assert r.js == (f"{r.dir}{r.stem}_en.json" if known else None)
    for name in (nm.raw_invoice_blob_name("v", F.col("lang")), nm.translated_blob_name("v"), nm.json_blob_name("v")):
        assert _plan(df.select(name.alias("x"))).count("RLIKE") <= 2  # 8 and more, when each part began with the whole path


def test_rates_are_searched_once_a_text_and_lines_before_a_table_are_passed_over(spark):
    text = ("Item 3\nVAT (8%)\n1  Not in a table 2 EA 10.00 20.00\nNo  Description  Qty  Unit  Unit price  Net amount\n"
            "1  Steel rods 2 EA 10.00 20.00\n2  Freight\n    as ordered 1 EA 1.200,50 1.200,50\nTotal 1,220.50")
    out = ex.extract_line_items(one_col(spark, [text, "", None, "Qty only"], "text").withColumn("doc_id", F.lit(1)))
    got = [(r.lineNumber, r.description, str(r.netAmount), str(r.vatPercentage), r.agrees) for r in out.collect()]
    assert got == [("1", "Steel rods", "20.00", "8.00", True), ("2", "Freight as ordered", "1200.50", "8.00", True)]
    assert _plan(out).count("bwithholding") == 1


def test_a_date_is_parsed_by_the_forms_it_may_have_only(spark):
    values = ["3-4-2024", "03/04/2024", "2024-4-3", "3-APR-2024", "3-Apr-2024", "31-31-2024", "1-2-03", "2024/4/3", "12024-1-1", "+12024-1-1",
              "1-1-12024", "1-1-+12024", " 3-4-2024", "3-4-2024 ", "", "x", None, "0-0-0000", "2024-4-3-1", "003-4-2024"]
    df = one_col(spark, values)
    plain = F.coalesce(F.date_format(F.coalesce(*[F.try_to_date("v", f) for f in ex.DATE_FORMATS]), "yyyyMMdd"), F.lit(""))
    rows = df.select("v", ex.normalize_invoice_date("v").alias("got"), plain.alias("plain")).collect()
    assert [(r.v, r.got) for r in rows] == [(r.v, r.plain) for r in rows]
    assert _plan(df.select(ex.normalize_invoice_date("v").alias("x"))).count("RLIKE") >= len(ex.DATE_FORMATS)


def test_rates_that_are_not_there_are_null(spark):
    df = one_col(spark, ["VAT (8%)", "VAT 8,5 %", "vat", "", None])
    assert [str(r[0]) for r in df.select(ex.percentage("v", "vat")).collect()] == ["8.00", "8.50", "None", "None", "None"]


def test_sound_records_are_told_by_a_search_and_a_parse(spark):
    item = ('{"lineNumber": "1", "category": "OTHER_SERVICES", "quantity": 2, "unitOfMeasure": "EA", "unitPrice": 1.5, "netAmount": 3, "vatAmount": 0, '
            '"vatPercentage": 0, "withholdingPercentage": 0}')
    good = ('{"doctype": "POI", "invoiceType": "STANDARD", "purchaseOrderNumber": "", "taxAmount": 1, "vatTaxAmount": 1, "totalInvoiceAmount": 10, '
            '"taxPercentage": 18, "vatPercentage": 8, "currency": "TRY", "invoiceLineItems": [' + item + "]}")
    cases = [(good, ""), (f"[{good}]", "not_object:$"), (good[:-1], "malformed_json"), (good.replace('"POI"', '"POI", "doctype": "POI"'), "malformed_json"),
             (good.replace('"doctype": "POI"', '"doct\\u0079pe": 5'), "enum:doctype,not_string:doctype"), (good.replace('"POI"', '"P\\u004fI"'), ""),
             (good.replace('"quantity": 2', '"quantity" : "NaN"'), "not_number:invoiceLineItems.quantity"),
             (good.replace("}]", "}, null]"), "not_object:invoiceLineItems"), (good.replace('"TRY"', '"a \\"doctype\\": 5"'), ""),
             (good.replace('"currency"', '"Currency"'), "missing:currency")]
    df = ex.validate_extraction(one_col(spark, [c for c, _ in cases], "details_json"))
    assert [r.violations for r in df.collect()] == [want for _, want in cases]
    assert "jsontostructs" in _plan(df).lower() or "from_json" in _plan(df).lower()


def test_texts_are_taken_apart_once_for_all_folds(spark):
    from paperlane.operators.classify import learned_out_of_fold

    rows = spark.range(60).selectExpr("concat('d', id) doc", "if(id % 2 = 0, 'invoice total due', 'poem of the sea') text", "cast(1 - id % 2 as int) label")
    out = learned_out_of_fold(rows, "doc")
    assert out.where("predicted = label").count() == 60
    plan = _plan(out)
    assert "text" not in plan and "UDF" not in plan and plan.count("Relation") == 1  # the scores are read, not made again
