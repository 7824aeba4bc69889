"""Invoice field extraction as native rules.

The structured-output contract (field names, enums, required lists, PO /
bank formats) is kept; the values are found with label-anchored regular
expressions and typed with ``try_*`` casts, so every rule is a Catalyst
expression evaluated in the scan stage. Model output (JSON) is parsed with
``from_json`` (partial results on bad fields) and type-checked through the
VARIANT type.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.operators.lineitems import ITEM_FIELDS, line_items
from paperlane.operators.schema import _let, violations


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def label_regex(label: str) -> str:
    """Case-insensitive pattern for ``<label> [:#] <value with a digit>``."""
    core = label.rstrip(".").replace(".", r"\.").replace(" ", r"\s*")
    return r"(?i)\b" + core + r"\.?\s*[:#]?\s*([A-Za-z0-9/\-]*[0-9][A-Za-z0-9/\-]*)"


DATE_VALUE = r"(?i)\b(?:invoice|billing|issue)?\s*date\s*[:.]?\s*([0-9]{1,4}[-/][0-9A-Za-z]{1,3}[-/][0-9]{1,4})"
# accepted date forms, in order: DD-MM-YYYY, DD/MM/YYYY, YYYY-MM-DD, DD-MMM-YYYY
DATE_FORMATS = ("d-M-yyyy", "d/M/yyyy", "yyyy-M-d", "d-MMM-yyyy")
#: What every date of a form has; a text without it isn't parsed, as a parse that fails costs an exception.
DATE_SHAPES = (r"-\+?[0-9]{4}", "/", r"^\+?[0-9]{4}", "[A-Za-z]")


def normalize_invoice_date(value) -> Column:
    """One of the four accepted forms -> ``YYYYMMDD``; otherwise ''."""
    parsed = _let(_c(value), lambda v: F.coalesce(*[F.when(v.rlike(shape), F.try_to_date(v, f))
                                                    for f, shape in zip(DATE_FORMATS, DATE_SHAPES, strict=True)]))
    return F.coalesce(F.date_format(parsed, "yyyyMMdd"), F.lit(""))


def valid_po_number(value) -> Column:
    """``66`` or ``45`` followed by 8 digits."""
    return F.coalesce(_c(value).rlike(vocab.PO_NUMBER_PATTERN), F.lit(False))


def valid_bank_account(value) -> Column:
    """9-18 digits."""
    return F.coalesce(_c(value).rlike(vocab.BANK_ACCOUNT_PATTERN), F.lit(False))


def valid_swift(value) -> Column:
    """8 or 11 alphanumerics."""
    return F.coalesce(_c(value).rlike(vocab.SWIFT_BIC_PATTERN), F.lit(False))


def gated(t: Column, words, expr: Column, low: Column | None = None) -> Column:
    """``expr`` only where the lower-cased text contains one of ``words``.

    A literal byte search is far cheaper than a case-insensitive regex; the
    regex can only match where its (ASCII) keyword occurs, so the result is
    unchanged.
    """
    low = F.lower(t) if low is None else low
    cond = None
    for w in words:
        c = low.contains(w)
        cond = c if cond is None else cond | c
    return F.when(cond, expr)


def invoice_number(text, low: Column | None = None) -> Column:
    """Value after the first label (priority order) that has one; a PO
    number is never an invoice number; '' when unknown. ``low``: the text
    already lower-cased (computed once by the caller)."""
    t = _c(text)
    found = F.coalesce(*[gated(t, [l.split()[0].lower()], F.nullif(F.regexp_extract(t, label_regex(l), 1), F.lit("")),
                               low)
                         for l in vocab.INVOICE_NUMBER_LABELS] + [gated(t, ["invoice"], _inv_no_short(t), low)])
    return _let(found, lambda n: F.when(n.isNull() | valid_po_number(n), F.lit("")).otherwise(n))


def _inv_no_short(t: Column) -> Column:
    # 'Invoice No:' written without the dot
    return F.nullif(F.regexp_extract(t, r"(?i)\binvoice\s*no\s*[:#]\s*([A-Za-z0-9/\-]*[0-9][A-Za-z0-9/\-]*)", 1),
                    F.lit(""))


def invoice_date(text, low: Column | None = None) -> Column:
    t = _c(text)
    return normalize_invoice_date(F.coalesce(gated(t, ["date"], F.regexp_extract(t, DATE_VALUE, 1), low), F.lit("")))


def extract_baseline(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``invoiceNumber``, ``invoiceDate`` (both always present, '' when unknown)."""
    d = df.withColumn("__low", F.lower(F.col(text_col)))
    low = F.col("__low")
    return d.withColumns({"invoiceNumber": invoice_number(F.col(text_col), low),
                          "invoiceDate": invoice_date(F.col(text_col), low)}).drop("__low")


def _kw(words) -> str:
    return r"(?i)\b(?:" + "|".join(w.replace(" ", r"\s+") for w in words) + r")\b"


CURRENCY_SYMBOLS = (("$", "USD"), ("€", "EUR"), ("£", "GBP"), ("¥", "JPY"), ("₺", "TRY"))


def currency(text) -> Column:
    t = _c(text)
    code = F.regexp_extract(t, r"(?i)\bcurrency\s*[:.]?\s*([A-Za-z]{3})\b", 1)
    sym = None
    for s, c in CURRENCY_SYMBOLS:
        cond = t.contains(s)
        sym = F.when(cond, F.lit(c)) if sym is None else sym.when(cond, F.lit(c))
    return F.when(code != "", F.upper(code)).otherwise(F.coalesce(sym, F.lit("")))


def parse_amount(raw: Column) -> Column:
    """``1,200.50``, ``1.200,50``, ``1200,5`` and ``1.200.300`` as decimals."""
    return _let(raw, _parsed)


def _parsed(raw: Column) -> Column:
    plain = (F.when(raw.rlike(r"^-?[0-9.]*,[0-9]{1,2}$"), F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
              .when(raw.rlike(r"^-?[0-9]{1,3}([.][0-9]{3}){2,}$"), F.replace(raw, F.lit("."), F.lit("")))
              .otherwise(F.replace(raw, F.lit(","), F.lit(""))))
    return plain.try_cast("decimal(18,2)")


#: What may be counted: a number before one of these is no amount.
COUNT_UNITS = ("item", "items", "pc", "pcs", "piece", "pieces", "unit", "units", "line", "lines", "page", "pages", "hour", "hours",
               "day", "days", "box", "boxes", "pallet", "pallets", "package", "packages", "document", "documents", "file", "files",
               "kg", "km", "m", "ea")
CURRENCY_WORDS = ("try", "tl", "usd", "eur", "gbp", "jpy", "euro", "euros", "dollar", "dollars", "lira", "pound", "pounds", "yen")


def _amount_parts(pat: str):
    return lambda x: F.struct(F.regexp_extract(x, pat, 1).alias("b"), F.regexp_extract(x, pat, 2).alias("v"),
                              F.lower(F.regexp_extract(x, pat, 3)).alias("a"))


def _best_amount(amounts: Column) -> Column:
    marked = F.filter(amounts, lambda x: (x["b"] != "") | x["a"].isin(*CURRENCY_WORDS, *(s for s, _ in CURRENCY_SYMBOLS))
                      | x["v"].rlike(r"[.,][0-9]{1,2}$"))
    return F.coalesce(F.get(marked, F.lit(0))["v"], F.get(amounts, F.lit(0))["v"])


def amount_after(text, labels, low: Column | None = None) -> Column:
    """Decimal amount after the first of ``labels`` (in that order) that has
    one on its line. A rate between label and value is passed over; a value
    that ``%`` or a count unit follows is no amount. Of several values of a
    label the first with a currency or decimals is taken, else the first."""
    t = _c(text)
    found = []
    for label in labels:
        pat = (r"\b(?i:" + label.replace(" ", r"[ \t]+") + r")[ \t]*(?:[0-9]+(?:[.,][0-9]+)?[ \t]*%)?[ \t]*[:.]?[ \t]*"
               r"([$€£¥₺]|[A-Z]{3}\b)?[ \t]*(-?[0-9](?:[0-9.,]*[0-9])?)[ \t]*(%|[$€£¥₺]|\p{L}+)?")
        # the text is searched once; the groups are taken from what was found
        places = F.transform(F.regexp_extract_all(t, F.lit(pat), F.lit(0)), _amount_parts(pat))
        amounts = F.filter(places, lambda x: ~x["a"].isin("%", *COUNT_UNITS))
        found.append(gated(t, [label.split()[0]], _let(amounts, _best_amount), low))
    return parse_amount(F.coalesce(*found))


def percentage(text, label: str) -> Column:
    """The rate (per cent) that follows ``label``, with ``rate`` or ``amount`` between or not."""
    raw = F.regexp_extract(_c(text), r"(?i)\b" + label + r"\s*(?:rate|amount)?\s*[:(]?\s*([0-9]{1,3}(?:[.,][0-9]{1,2})?)\s*%", 1)
    return F.replace(F.nullif(raw, F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(9,2)")  # a cast of '' costs an exception


#: The title of a document: its first lines that aren't blank.
TITLE = r"^(?:\s*[^\n]+(?:\n|$)){0,5}"


def title(text) -> Column:
    return F.regexp_extract(_c(text), TITLE, 0)


def invoice_type(text, cur: Column) -> Column:
    """Keyword priority RETURN > FREELANCE > RECEIPT > NOTARY > FOREIGN_CURRENCY > IMPORT > STANDARD;
    the freelance, receipt and notary keywords count in the title."""
    t = _c(text)
    head = title(t)
    return (F.when(t.rlike(_kw(vocab.RETURN_KEYWORDS)), "RETURN")
             .when(head.rlike("(?i)" + vocab.FREELANCE_KEYWORD.replace(" ", r"\s+")), "FREELANCE_INVOICE")
             .when(head.rlike(r"(?i)\b" + vocab.RECEIPT_KEYWORD + r"\b"), "RECEIPT")
             .when(head.contains(vocab.NOTARY_KEYWORD), "NOTARY_E_RECEIPT")
             .when((cur != "") & (cur != vocab.HOME_CURRENCY), "FOREIGN_CURRENCY")
             .when(t.rlike(r"(?i)\bimport"), "IMPORT")
             .otherwise("STANDARD"))


def extract_details(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Doctype, invoiceType, PO / vendor / tax numbers, amounts, rates,
    currency, bank ids, buyer, line items."""
    t = F.col(text_col)
    df = df.withColumn("__low", F.lower(t))
    low = F.col("__low")
    po = F.regexp_extract(t, "(" + vocab.PO_NUMBER_IN_TEXT + ")", 1)
    cur = currency(t)
    out = df.withColumns({
        "purchaseOrderNumber": po,
        "currency": cur,
        "vendorNumber": F.regexp_extract(
            t, r"(?i)\b(?:vendor\s*(?:no\.?|number|id)|supplier\s*id)\s*[:#]?\s*([A-Za-z0-9\-]+)", 1),
        "totalInvoiceAmount": amount_after(t, ("grand total", "total amount", "amount due", "total"), low),
        "taxAmount": amount_after(t, ("tax amount", "tax"), low),
        "Bank_Account_Number": F.regexp_extract(t, r"(?i)\b(?:account\s*(?:no\.?|number)?)\s*[:#]?\s*([0-9]{9,18})\b", 1),
        "Global_Bank_Identifier": F.regexp_extract(t, r"(?i)\b(?:swift|bic)\s*[:#]?\s*([A-Za-z0-9]{11}|[A-Za-z0-9]{8})\b", 1),
        "vatTaxAmount": amount_after(t, ("vat amount", "vat total", "vat"), low),
        "totalNetAmount": amount_after(t, ("net amount", "net total", "subtotal"), low),
        "taxIdentification": F.regexp_extract(t, r"(?i)\btax\s*(?:id|no\.?|number)\s*[:#]?\s*([0-9]{10,11})\b", 1),
        "receiverVATID": F.regexp_extract(
            t, r"(?i)\b(?:buyer|customer|receiver)\s*vat\s*(?:id|no\.?)?\s*[:#]?\s*([A-Za-z0-9]{8,14})\b", 1),
        "taxPercentage": percentage(t, "tax"),
        "vatPercentage": percentage(t, "vat"),
        "withholdingPercentage": percentage(t, "withholding"),
        "Bank_Key": F.regexp_extract(t, r"(?i)\bbank\s*(?:key|code)\s*[:#]?\s*([A-Za-z0-9]{3,15})\b", 1),
        "buyerName": F.trim(F.regexp_extract(t, r"(?im)^\s*(?:buyer|bill to|customer)\s*:\s*(\S[^\n]*)$", 1)),
    })
    items = line_items(t, low, *(F.col(f"{k}Percentage") for k in ("tax", "vat", "withholding")))
    out = out.withColumns({
        "invoiceType": invoice_type(t, F.col("currency")),
        "invoiceLineItems": F.transform(items, lambda x: F.struct(*(x[f].alias(f) for f in ITEM_FIELDS)))})
    has_invoice = t.rlike("(?i)invoice")
    not_return = F.col("invoiceType") != "RETURN"
    return out.withColumn("doctype", F.when(has_invoice & (po != "") & not_return, "POI")
                          .when(has_invoice & (po == "") & not_return, "NPI").otherwise("N/A")).drop("__low")


BASELINE_FIELDS = ["invoiceNumber", "invoiceDate"]
DETAIL_FIELDS = ["doctype", "invoiceType", "purchaseOrderNumber", "vendorNumber", "currency",
                 "totalInvoiceAmount", "taxAmount", "Bank_Account_Number", "Global_Bank_Identifier", "vatTaxAmount",
                 "totalNetAmount", "taxIdentification", "receiverVATID", "taxPercentage", "vatPercentage",
                 "withholdingPercentage", "Bank_Key", "buyerName", "invoiceLineItems"]


def extract_line_items(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each line item found in the text."""
    t = F.col(text_col)
    rates = {f"__{k}": percentage(t, k) for k in ("tax", "vat", "withholding")}
    df = df.withColumns({"__low": F.lower(t), **rates})  # columns, as an item's expressions are computed for each item
    items = line_items(t, F.col("__low"), *map(F.col, rates))
    return df.select(key, F.inline(items))


def merge_extractions(baseline: DataFrame, details: DataFrame, key: str = "doc_id") -> DataFrame:
    """``{**baseline, **details}`` per document as a full-outer join.

    Shared field names take the details value when the details record has
    the field (non-null, even ''), else the baseline value; a document
    present on one side only keeps that side's fields.
    """
    b_cols = [c for c in baseline.columns if c != key]
    d_cols = [c for c in details.columns if c != key]
    b = baseline.select(key, *[F.col(c).alias(f"_b_{c}") for c in b_cols])
    d = details.select(key, *[F.col(c).alias(f"_d_{c}") for c in d_cols])
    j = b.join(d, key, "full_outer")
    cols = []
    for c in dict.fromkeys(b_cols + d_cols):
        if c in d_cols and c in b_cols:
            cols.append(F.coalesce(F.col(f"_d_{c}"), F.col(f"_b_{c}")).alias(c))
        elif c in d_cols:
            cols.append(F.col(f"_d_{c}").alias(c))
        else:
            cols.append(F.col(f"_b_{c}").alias(c))
    return j.select(key, *cols)


def money(x, scale: int = 2, precision: int = 18) -> Column:
    """Double -> decimal rounded half-up on the binary value's cents (the same
    in every IEEE engine, unlike rounding through a decimal string)."""
    f = 10 ** scale
    cents = F.floor(_c(x) * F.lit(float(f)) + F.lit(0.5)).cast("decimal(38,0)")
    return (cents / F.lit(f)).cast(f"decimal({precision},{scale})")


def normalize_party_name(name) -> Column:
    """Upper case, punctuation to spaces, single spaces."""
    n = F.regexp_replace(F.upper(_c(name)), r"[^\p{L}\p{N}]+", " ")
    return F.trim(n)


def buyer_match(df: DataFrame, buyers: DataFrame, name_col: str = "buyer_text",
                buyer_col: str = "buyer_name") -> DataFrame:
    """Map a free-text buyer to the closed buyer list (a parameter table).

    Equi-join on the normalised name; the buyer table is deduplicated per
    key first. AQE broadcasts it only when its measured size is under the
    broadcast threshold, otherwise a sort-merge join is used.
    """
    keyed = (buyers.select(normalize_party_name(F.col(buyer_col)).alias("_k"), F.col(buyer_col).alias("buyerName"))
             .groupBy("_k").agg(F.min("buyerName").alias("buyerName")))
    return (df.withColumn("_k", normalize_party_name(F.col(name_col)))
            .join(keyed, "_k", "left")
            .withColumn("buyerName", F.coalesce(F.col("buyerName"), F.lit("")))
            .drop("_k"))


# ---------------------------------------------------------------------------------------------
# structured output (model JSON) -> typed rows
# ---------------------------------------------------------------------------------------------
def details_json_schema() -> dict:
    """The details record as a JSON schema (function-call ``parameters`` form).
    ``N/A`` is a document type too: the instructions name it."""
    item = {"type": "object", "properties": {k: {"type": t} for k, t in vocab.LINE_ITEM_FIELD_TYPES}, "required": list(vocab.LINE_ITEM_REQUIRED)}
    item["properties"]["category"]["enum"] = list(vocab.LINE_ITEM_CATEGORIES)
    props = {k: {"type": t} for k, t in vocab.DETAILS_FIELD_TYPES}
    props["doctype"]["enum"] = [*vocab.DOCTYPES, "N/A"]
    props["invoiceType"]["enum"] = list(vocab.INVOICE_TYPES)
    props["purchaseOrderNumber"]["pattern"] = vocab.PO_NUMBER_PATTERN
    props["invoiceLineItems"] = {"type": "array", "items": item}
    return {"type": "object", "properties": props, "required": list(vocab.DETAILS_REQUIRED)}


def baseline_json_schema() -> dict:
    """The baseline record as a JSON schema."""
    return {"type": "object", "properties": {k: {"type": "string"} for k in vocab.BASELINE_REQUIRED},
            "required": list(vocab.BASELINE_REQUIRED)}


def _spark_types():
    from paperlane.operators.injected import structured_output_schema

    details = structured_output_schema(details_json_schema())
    return details, details["invoiceLineItems"].dataType.elementType


# L3: Spark types derived from the structured-output schema
DETAILS_TYPE, LINE_ITEM_TYPE = _spark_types()


def parse_details(df: DataFrame, json_col: str = "details_json") -> DataFrame:
    """JSON -> typed struct ``d`` (a wrong-typed field becomes null, the
    rest is kept) plus the VARIANT form ``v`` for type checks."""
    return df.withColumns({"d": F.from_json(F.col(json_col), DETAILS_TYPE),
                           "v": F.try_parse_json(F.col(json_col))})


def flatten_line_items(df: DataFrame, key: str = "doc_id", json_col: str = "details_json") -> DataFrame:
    """One row per line item (``explode_outer``: a document without items
    keeps one row of nulls); amounts as ``decimal(18,2)``."""
    p = df.select(key, F.from_json(F.col(json_col), DETAILS_TYPE).alias("d"))
    x = p.select(key, F.explode_outer("d.invoiceLineItems").alias("li"))
    money_cols = ["quantity", "unitPrice", "netAmount", "taxAmount", "vatAmount"]
    pct = ["taxPercentage", "vatPercentage", "withholdingPercentage"]
    return x.select(key, F.col("li.lineNumber").alias("lineNumber"), F.col("li.category").alias("category"),
                    F.col("li.unitOfMeasure").alias("unitOfMeasure"),
                    *[money(F.col(f"li.{c}")).alias(c) for c in money_cols],
                    *[money(F.col(f"li.{c}"), 2, 9).alias(c) for c in pct])


def validate_extraction(df: DataFrame, json_col: str = "details_json", schema: dict | None = None) -> DataFrame:
    """The rule violations of each JSON record ('' when clean), by the
    details schema or another (:mod:`paperlane.operators.schema`)."""
    found = df.withColumn("_v", violations(F.col(json_col), schema or details_json_schema()))
    return found.withColumns({"n_violations": F.size("_v"), "violations": F.array_join("_v", ",")}).drop("_v")
