"""Views over the driver tables that stand in for the pipeline's inputs.

Each view is derived by Spark from the given tables, so its size grows with
the scale factor. Expressions are chosen so that the DuckDB twins in
``oracle_sql.py`` compute the same values (e.g. ``floor`` before integer
casts, because DuckDB rounds where Spark truncates).
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.sources.tables import read_table

# Fixed anchors of the fixtures (never now()).
AS_OF_LOG = dt.datetime(2024, 1, 30, 12, 0, 0)
AS_OF_BLOB = dt.datetime(2024, 1, 10, 12, 0, 0)
AS_OF_MAIL = dt.datetime(2001, 8, 1, 0, 0, 0)


def _case(key: Column, values) -> Column:
    """``values[key]`` for a small integer key, as a CASE expression."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, F.lit(v)) if expr is None else expr.when(key == i, F.lit(v))
    return expr


# --- A1 ------------------------------------------------------------------------------
def process_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_log_from(read_table(spark, sf_dir, "events"))


def process_log_from(ev: DataFrame) -> DataFrame:
    """A1 over an events DataFrame (batch or streaming)."""
    step = _case(F.col("event_id") % 13, vocab.STEP_NAMES + ("unknown_step",))
    workflow = _case(F.col("user_id") % 3, ("EmailScanner", "OCRPipeline", "DocTranslator"))
    failed = step.endswith("_failed")
    return ev.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        workflow.alias("workflow_name"),
        step.alias("step_name"),
        F.col("props").alias("step_value"),
        (F.lit(1) + (F.floor("value").cast("int") % 5)).cast("int").alias("item_count"),
        F.when(failed, "Failed").otherwise("Completed").alias("status"),
        F.col("ts").alias("logged_at"),
        F.when(failed, F.col("event_type")).alias("detail"),
    )


# --- A2 / A6 --------------------------------------------------------------------------
def _doc_blob_stem(doc_id: Column, lang: Column) -> Column:
    prefix = F.when(doc_id % 4 == 0, "doc-").otherwise("doc_")
    return F.concat(prefix, doc_id.cast("string"), F.lit("_"), lang)


def _doc_blob_name(doc_id: Column, lang: Column) -> Column:
    ext = (F.when(doc_id % 7 == 0, ".PDF").when(doc_id % 11 == 0, ".txt").otherwise(".pdf"))
    return F.concat(F.lit("source/"), _doc_blob_stem(doc_id, lang), ext)


def source_blobs(spark: SparkSession, sf_dir: str, as_of: dt.datetime | None = None) -> DataFrame:
    """Listing of the source container, all of it or as it was at ``as_of``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    df = docs.join(ev, ev.event_id == docs.doc_id * 5, "inner").select(
        F.col("doc_id"),
        F.col("lang"),
        F.lit(vocab.RAW_INVOICE_CONTAINER).alias("container"),
        _doc_blob_name(F.col("doc_id"), F.col("lang")).alias("name"),
        F.col("ts").alias("last_modified"),
        F.col("n_chars").alias("size"),
    )
    if as_of is not None:
        df = df.where(F.col("last_modified") <= F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    return df


# --- A3 ---------------------------------------------------------------------------------
def target_blobs(spark: SparkSession, sf_dir: str, as_of: dt.datetime | None = None) -> DataFrame:
    from paperlane.functions.naming import normalize_blob_name

    src = source_blobs(spark, sf_dir, as_of)
    # the stem of the source base name, built from its parts (it equals
    # path_stem(base_name(name)) for these names, as the SQL twin checks)
    stem = _doc_blob_stem(F.col("doc_id"), F.col("lang"))
    suffix = F.when(F.col("doc_id") % 2 == 0, "_ocr.pdf").otherwise("_enhanced_ocr.pdf")
    return src.where(F.col("doc_id") % 3 != 0).select(
        F.col("doc_id"),
        F.lit(vocab.OCR_TARGET_CONTAINER).alias("container"),
        normalize_blob_name(F.concat(stem, suffix)).alias("name"),
        F.col("last_modified"),
        F.col("size"),
    )


# --- A4 ------------------------------------------------------------------------------------
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        k.alias("id"),
        F.when(k % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Order "), k.cast("string"))).alias("subject"),
        F.when(k % 8 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("from_name"),
        F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.com")).alias("from_address"),
        F.col("o_orderdate").alias("received_at"),
        (F.col("o_orderstatus") != "P").alias("has_attachments"),
    )


def nested_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 in the mail server's nested shape: ``from.emailAddress.{address,name}``."""
    m = messages(spark, sf_dir)
    return m.select(
        "id", "subject",
        F.struct(F.struct(F.col("from_address").alias("address"),
                          F.col("from_name").alias("name")).alias("emailAddress")).alias("from"),
        F.col("received_at").alias("receivedDateTime"),
        F.col("has_attachments").alias("hasAttachments"),
    )


# --- A5 -------------------------------------------------------------------------------------
ATTACHMENT_MIME_BY_PARTKEY = ("application/pdf", "Application/PDF; name=x", "image/png", "image/tiff",
                              "application/msword", None)


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("message_id"),
        F.concat_ws("-", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
                    F.col("l_suppkey").cast("string")).alias("att_id"),
        F.concat(F.lit("att_"), F.col("l_linenumber").cast("string"), F.lit(".pdf")).alias("name"),
        _case(F.col("l_partkey") % 6, ATTACHMENT_MIME_BY_PARTKEY).alias("content_type"),
        (F.floor("l_quantity").cast("bigint") * 10).alias("size"),
        F.when(F.col("l_suppkey") % 9 == 1, F.lit(None).cast("boolean"))
         .otherwise(F.col("l_suppkey") % 9 == 0).alias("is_inline"),
        (F.col("l_returnflag") != "R").alias("is_valid"),
        F.when(F.col("l_returnflag") != "R", F.lit("Valid invoice."))
         .otherwise(F.concat(F.lit("Rejected: "), F.col("l_linestatus"))).alias("reason"),
        F.col("l_shipdate").alias("written_at"),
        F.col("l_extendedprice").alias("tiebreak"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_linenumber").alias("line_no"),
    )


# --- A6 ---------------------------------------------------------------------------------------
def ocr_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", _doc_blob_name(F.col("doc_id"), F.col("lang")).alias("filename"), "text", "lang")


# --- A7 ---------------------------------------------------------------------------------------
CURRENCY_BY_KEY = ("TRY", "USD", "EUR", "JPY")


def _invoice_date_text(d: Column, key: Column) -> Column:
    return (F.when(key % 4 == 0, F.date_format(d, "dd-MM-yyyy"))
             .when(key % 4 == 1, F.date_format(d, "dd/MM/yyyy"))
             .when(key % 4 == 2, F.date_format(d, "yyyy-MM-dd"))
             .otherwise(F.upper(F.date_format(d, "dd-MMM-yyyy"))))


def order_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor of an order = supplier with the lowest supplier key on its lines."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    low = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("vendor_key"))
    return low.join(s, low.vendor_key == s.s_suppkey, "left").select(
        "l_orderkey", "vendor_key", F.col("s_name").alias("vendor_name"))


INVOICE_LABELS = ("Invoice No: ", "Invoice Number: ", "Invoice # ", "Document Number: ", "Reference Number: ")


def _hundredths(n: Column) -> Column:
    """A whole number of hundredths as text."""
    return F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))


def invoice_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    v = order_vendor(spark, sf_dir)
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    title = F.when(k % 9 == 0, "DELIVERY NOTE").when(k % 11 == 0, "CREDIT NOTE").otherwise("INVOICE")
    lines = F.concat_ws(
        "\n",
        title,
        F.when(k % 13 != 0, F.concat(_case(k % 5, INVOICE_LABELS), F.lit("INV"), k.cast("string"))),
        F.when(k % 29 == 0, F.lit("Invoice Date: 31-31-2024")).otherwise(
            F.concat(F.lit("Invoice Date: "), _invoice_date_text(F.col("o_orderdate"), k))),
        F.when(k % 31 == 0, F.lit(vocab.FREELANCE_KEYWORD)).when(k % 37 == 0, F.lit(vocab.RECEIPT_KEYWORD))
         .when(k % 41 == 0, F.lit("Import goods")).when(k % 47 == 0, F.lit(vocab.NOTARY_KEYWORD)),
        F.when(F.col("vendor_name").isNotNull(), F.concat(F.lit("Vendor: "), F.col("vendor_name"))),
        F.when(k % 2 == 0, F.concat(F.lit("PO: 45"), F.lpad(k.cast("string"), 8, "0"))),
        F.concat(F.lit("Currency: "), _case(k % 4, CURRENCY_BY_KEY)),
        F.when(k % 6 == 1, F.lit("Total: 5 items")),
        F.concat(F.when(k % 3 == 0, "Grand Total: ").otherwise("Total: "),
                 F.when(k % 5 == 0, F.replace(price.cast("string"), F.lit("."), F.lit(",")))
                  .when(k % 5 == 1, F.format_number(price, 2)).otherwise(price.cast("string"))),
        F.when(k % 4 != 3, F.concat(F.lit("Net amount: "), _hundredths(k * 91))),
        F.when(k % 4 == 0, F.concat(F.lit("Tax "), (k % 9 + 1).cast("string"), F.lit("%: "), _hundredths(k * 7))),
        F.when(k % 4 == 1, F.concat(F.lit("VAT ("), (k % 20 + 1).cast("string"), F.lit(",5%)\nVAT amount: "), _hundredths(k * 13))),
        F.when(k % 8 == 2, F.concat(F.lit("Withholding rate: "), (k % 3 + 2).cast("string"), F.lit("%"))),
        F.when(k % 3 == 1, F.concat(F.lit("Vendor No: V-"), (k * 3).cast("string"))),
        F.when(k % 3 == 2, F.concat(F.lit("Account No: "), F.lpad((k * 17).cast("string"), 12, "1"), F.lit("\nSWIFT: BNKA"),
                                    F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("\nBank key: BK"), k.cast("string"))),
        F.when(k % 7 == 0, F.concat(F.lit("Tax ID: "), F.lpad(k.cast("string"), 10, "2"), F.lit("\nBuyer VAT ID: TR"),
                                    F.lpad(k.cast("string"), 9, "3"), F.lit("\nBuyer: Buyer "), (k % 100).cast("string"))),
    )
    return o.join(v, o.o_orderkey == v.l_orderkey, "left").select(
        k.alias("doc_id"), lines.alias("text"))


ITEM_TEXT_BY_PTYPE = (("ECONOMY", "Office cleaning service"), ("SMALL", "Printing of brochures"), ("MEDIUM", "Machine maintenance"),
                      ("PROMO", "Advertising campaign"), ("STANDARD", "Steel rods 12 mm"), ("LARGE", "Freight to plant"))


def _styled(cents: Column, key: Column) -> Column:
    """Cents as text, in the decimal style of the order."""
    amount = (cents / F.lit(100)).cast("decimal(18,2)")
    grouped = F.format_number(amount, 2)
    return (F.when(key % 5 == 0, F.replace(amount.cast("string"), F.lit("."), F.lit(",")))
             .when(key % 5 == 1, grouped).when(key % 5 == 2, F.translate(grouped, ",.", ".,")).otherwise(amount.cast("string")))


def itemised_invoice_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`invoice_text` with VAT on the orders that have tax, and a table of
    the order's lines: descriptions wrapped before or after the amounts, tables
    without a rate or a price, four decimal styles."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_suppkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    words = None
    for ptype, t in ITEM_TEXT_BY_PTYPE:
        words = F.when(F.col("p_type") == ptype, t) if words is None else words.when(F.col("p_type") == ptype, t)
    q = F.floor("l_quantity").cast("bigint")
    price = F.floor(F.col("p_retailprice") * 100 + 0.5).cast("bigint")
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", q.alias("q"), price.alias("price"), words.alias("words"))
    tables = (li.join(part, li.l_partkey == part.p_partkey).groupBy("l_orderkey")  # an order's lines
              .agg(F.sort_array(F.collect_list(line)).alias("lines")))
    k = F.col("l_orderkey")

    def text(x: Column, i: Column) -> Column:
        n = i + 1
        wrapped = F.when((k + n) % 4 == 0, "\n    as ordered").otherwise("")
        rest = F.when((k + n) % 4 == 1, "\n    as agreed").otherwise("")
        return F.concat(
            n.cast("string"), F.lit("  "), F.coalesce(x["words"], F.lit("Consulting")), wrapped, F.lit(" "), x["q"].cast("string"),
            F.when(k % 7 == 5, "").otherwise(F.concat(F.lit(" "), _case(x["l_partkey"] % 3, ("EA", "HUR", "kg")), F.lit(" "), _styled(x["price"], k))),
            F.when(k % 7 == 3, "").otherwise(F.concat(F.lit(" "), (x["l_partkey"] % 20 + 1).cast("string"), F.lit("%"))),
            F.lit(" "), _styled(x["q"] * x["price"], k), rest)

    head = (F.when(k % 7 == 3, "No  Description  Qty  Unit  Unit price  Net amount")
             .when(k % 7 == 5, "No  Description  Quantity  VAT %  Net amount")
             .otherwise("No  Description  Qty  Unit  Unit price  VAT %  Net amount"))
    rows = tables.select(k.alias("item_order"), F.concat(head, F.lit("\n"), F.array_join(F.transform("lines", text), "\n"),
                                                         F.lit("\nPayment within 30 days")).alias("item_table"))
    inv = invoice_text(spark, sf_dir)
    vat = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("VAT (8%)\nVAT amount: "), _hundredths(F.col("doc_id") * 11)))
    return inv.join(rows, inv.doc_id == rows.item_order, "left").select("doc_id", F.concat_ws("\n", "text", vat, "item_table").alias("text"))


# --- A8 ---------------------------------------------------------------------------------------
CATEGORY_BY_PTYPE = (
    ("ECONOMY", "OTHER_SERVICES"),
    ("SMALL", "PRINTING_PUBLISHING"),
    ("MEDIUM", "MAINTENANCE_TECHNICAL"),
    ("PROMO", "ADVERTISING"),
    ("STANDARD", "INDUSTRIAL_OTHER_DELIVERIES"),
    ("LARGE", "TRANSPORT_FREIGHT"),
)


def _cents(x: Column) -> Column:
    """Round to cents on the binary value (identical in every IEEE engine)."""
    return F.floor(x * 100 + 0.5) / 100


def extraction_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One structured-output JSON document per order, with planted violations.

    Line items are aggregated per order with partial aggregation; an order's
    line list is bounded by its own line count.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    cat = None
    for ptype, c in CATEGORY_BY_PTYPE:
        cat = (F.when(F.col("p_type") == ptype, c) if cat is None else cat.when(F.col("p_type") == ptype, c))
    cat = cat.otherwise("OTHER_SERVICES")
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    item = F.struct(
        F.col("l_linenumber").cast("string").alias("lineNumber"),
        F.col("p_type").alias("description"),
        cat.alias("category"),
        F.col("l_quantity").alias("quantity"),
        F.lit("EA").alias("unitOfMeasure"),
        F.col("p_retailprice").alias("unitPrice"),
        net.alias("netAmount"),
        (net * F.col("l_tax")).alias("taxAmount"),
        (F.col("l_tax") * 100).alias("taxPercentage"),
        (net * F.col("l_tax")).alias("vatAmount"),
        (F.col("l_tax") * 100).alias("vatPercentage"),
        F.lit(0.0).alias("withholdingPercentage"),
    )
    items = (li.join(p, li.l_partkey == p.p_partkey, "inner")
             .groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("k"),
                                                       F.col("l_extendedprice").alias("k2"),
                                                       item.alias("item")))).alias("lines"))
             .select("l_orderkey", F.transform("lines", lambda x: x["item"]).alias("invoiceLineItems")))
    k = F.col("o_orderkey")
    total = F.col("o_totalprice")
    header = F.struct(
        F.when(k % 19 == 0, F.lit("XXX")).when(k % 2 == 0, F.lit("POI")).otherwise(F.lit("NPI")).alias("doctype"),
        F.lit("STANDARD").alias("invoiceType"),
        F.when(k % 2 == 0, F.concat(F.lit("45"), F.lpad(k.cast("string"), 8, "0"))).otherwise(F.lit("")).alias(
            "purchaseOrderNumber"),
        F.concat(F.lit("V"), (k % 97).cast("string")).alias("vendorNumber"),
        _cents(total * 0.18).alias("taxAmount"),
        _cents(total * 0.18).alias("vatTaxAmount"),
        _cents(total - total * 0.18).alias("totalNetAmount"),
        total.alias("totalInvoiceAmount"),
        F.lit(18.0).alias("taxPercentage"),
        F.lit(18.0).alias("vatPercentage"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(_case(k % 4, CURRENCY_BY_KEY)).alias("currency"),
        F.coalesce(F.col("invoiceLineItems"), F.array()).alias("invoiceLineItems"),
    )
    js = F.to_json(header)
    # planted violation: the total sent as a JSON string
    js = F.when(k % 23 == 0, F.regexp_replace(js, r'"totalInvoiceAmount":([-0-9.Ee+]+)',
                                              '"totalInvoiceAmount":"$1"')).otherwise(js)
    return o.join(items, o.o_orderkey == items.l_orderkey, "left").select(
        k.alias("doc_id"), js.alias("details_json"))


# --- A9 -----------------------------------------------------------------------------------------
def ocr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return d.select(
        "doc_id",
        _doc_blob_name(F.col("doc_id"), F.col("lang")).alias("name"),
        F.col("text").alias("original_text"),
        F.when(F.col("doc_id") % 2 == 0, F.regexp_replace("text", "[.]", " ")).otherwise(F.col("text")).alias(
            "ocr_text"),
    )


# --- A10 ------------------------------------------------------------------------------------------
def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")


# --- names with many path shapes (documents + web page paths) -------------------------------
def blob_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for the naming functions: document blob names plus the paths of
    the crawled pages (directories, trailing ``/``, no extension, ``./`` and
    ``//`` forms)."""
    docs = ocr_text(spark, sf_dir).select(
        F.lit("doc").alias("origin"), F.col("doc_id").alias("item_id"), F.col("filename").alias("name"), "lang")
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"^[a-z]+://[^/]+/([^?#]*)", 1).alias("p"))
    pid = F.col("page_id")
    page_names = pages.select(
        F.lit("page").alias("origin"), pid.alias("item_id"),
        F.when(pid % 5 == 0, F.concat(F.lit("./"), F.col("p")))
         .when(pid % 7 == 0, F.replace(F.col("p"), F.lit("/"), F.lit("//")))
         .otherwise(F.col("p")).alias("name"),
        F.nullif(F.regexp_extract("p", r"^([a-z]{2})/", 1), F.lit("")).alias("lang"))
    return docs.unionByName(page_names)


def translated_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target container of the translator: outputs that already exist."""
    from paperlane.functions.naming import json_blob_name, translated_blob_name

    src = source_blobs(spark, sf_dir)
    done = src.where(F.col("doc_id") % 5 != 0)
    docs = done.select(F.lit("translated-invoices").alias("container"),
                       translated_blob_name(F.col("name")).alias("name"), "last_modified")
    jsons = done.where(F.col("doc_id") % 3 != 0).select(
        F.lit("translated-invoices").alias("container"), json_blob_name(F.col("name")).alias("name"),
        "last_modified")
    return docs.unionByName(jsons)


def blob_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload log of the mail scanner: one write per attachment."""
    a = attachments(spark, sf_dir)
    return a.select(
        F.when(F.col("is_valid"), F.lit(vocab.RAW_INVOICE_CONTAINER))
         .otherwise(F.lit(vocab.INVALID_INVOICE_CONTAINER)).alias("container"),
        F.concat(F.col("message_id").cast("string"), F.lit("/"), F.col("name")).alias("name"),
        "written_at", "tiebreak", "size", "att_id", "message_id")


def attachments_with_text(spark: SparkSession, sf_dir: str, payload: bool = False) -> DataFrame:
    """A5 with the OCR result of each attachment: odd line numbers carry the
    order's invoice text, even ones the prose document whose id is the part
    key; no such document -> no text (empty OCR). With ``payload`` also the
    bytes of the text as ``content``."""
    a = attachments(spark, sf_dir)
    text = [F.col("text").alias("ocr_text"), *([F.encode("text", "UTF-8").alias("content")] if payload else [])]
    inv = invoice_text(spark, sf_dir).select(F.col("doc_id").alias("message_id"), *text)
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("part_key"), *text)
    odd = F.coalesce(F.col("line_no") % 2 == 1, F.lit(False))
    # each half takes its text in its last join, so no text is shuffled with the attachments; of the other
    # table it takes the keys alone (an id that comes twice there gives two rows). The content is made on the text's
    # side: made above the join, it would keep Spark from moving a reader's semi-join on the messages below the join
    one = a.where(odd).join(docs.select("part_key"), "part_key", "left").join(inv, "message_id", "left")
    other = a.where(~odd).join(inv.select("message_id"), "message_id", "left").join(docs, "part_key", "left")
    columns = ["part_key", "message_id", *(c for c in a.columns if c not in ("part_key", "message_id")), "ocr_text"]
    columns += ["content"] if payload else []
    return one.select(*columns).unionByName(other.select(*columns))
