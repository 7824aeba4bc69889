"""DuckDB oracle SQL for every registered query.

The fixture views of ``paperlane.sources.fixtures`` are restated here as
CTEs over the driver's pre-registered views; each query string is
``WITH <needed fixtures> <query>``. Column names equal the Spark query's.
"""
from __future__ import annotations

from paperlane import langdata, vocab

AS_OF_LOG = "TIMESTAMP '2024-01-30 12:00:00'"
# Rules restated from their description, not imported from the code under test.
FUNCTION_WORDS = {
    "en": "the of and to is that it for on was with as be are by this at from or he she they we have not but which",
    "fr": "et les du sur une pour qui au est par dans avec pas elle aux ou ce il nous vous sont mais",
    "de": "der die und den von sich zu das mit auf ist im für dem ein nicht als eine er auch wird sind oder",
    "es": "el los se del y las por no con su para una al lo como más pero sus ya",
    "tr": "ve bir bu için ile olarak daha çok gibi değil olan ama kadar sonra ise göre tarafından şey biz onlar",
}
FUNCTION_WORDS = {k: v.split() for k, v in FUNCTION_WORDS.items()}
LANGS = tuple(FUNCTION_WORDS)
EXTRACTED_FIELDS = ("invoiceNumber", "invoiceDate", "doctype", "invoiceType", "purchaseOrderNumber", "vendorNumber",
                    "currency", "totalInvoiceAmount", "taxAmount", "Bank_Account_Number", "Global_Bank_Identifier", "vatTaxAmount",
                    "totalNetAmount", "taxIdentification", "receiverVATID", "taxPercentage", "vatPercentage",
                    "withholdingPercentage", "Bank_Key", "buyerName")
DATE_VALUE = r"(?i)\b(?:invoice|billing|issue)?\s*date\s*[:.]?\s*([0-9]{1,4}[-/][0-9A-Za-z]{1,3}[-/][0-9]{1,4})"
VENDOR_LINE = r"(?im)^\s*(?:vendor|supplier|seller|from)\s*[:#]\s*(\S.*?)\s*$"
AMOUNT_LABELS = ("grand total", "total amount", "amount due", "balance due", "total")
CURRENCY_SYMBOLS = (("$", "USD"), ("€", "EUR"), ("£", "GBP"), ("¥", "JPY"), ("₺", "TRY"))
CATEGORY_BY_PTYPE = (
    ("ECONOMY", "OTHER_SERVICES"), ("SMALL", "PRINTING_PUBLISHING"), ("MEDIUM", "MAINTENANCE_TECHNICAL"),
    ("PROMO", "ADVERTISING"), ("STANDARD", "INDUSTRIAL_OTHER_DELIVERIES"), ("LARGE", "TRANSPORT_FREIGHT"))
SUBJECT_SUCCESS = "RE: {subject} — Invoice(s) Received Successfully"
SUBJECT_PARTIAL = "RE: {subject} — Action Required: Some Attachments Could Not Be Processed"
SUBJECT_FAILURE = "RE: {subject} — Action Required: Invoice(s) Could Not Be Processed"


def label_regex(label: str) -> str:
    """Label, optional full stop, optional ``:`` or ``#``, then a value that holds a digit."""
    core = label.rstrip(".").replace(".", r"\.").replace(" ", r"\s*")
    return r"(?i)\b" + core + r"\.?\s*[:#]?\s*([A-Za-z0-9/\-]*[0-9][A-Za-z0-9/\-]*)"


AS_OF_BLOB = "TIMESTAMP '2024-01-10 12:00:00'"


def _case(expr: str, values, default=None) -> str:
    parts = []
    for i, v in enumerate(values):
        parts.append(f"WHEN {i} THEN {'NULL' if v is None else _q(v)}")
    tail = f" ELSE {_q(default)}" if default is not None else ""
    return f"CASE {expr} % {len(values)} " + " ".join(parts) + tail + " END"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STEP_CASE = ("CASE event_id % 13 " + " ".join(f"WHEN {i} THEN {_q(s)}" for i, s in enumerate(vocab.STEP_NAMES))
             + " ELSE 'unknown_step' END")

FIXTURES: dict[str, str] = {}

FIXTURES["process_log"] = f"""
process_log AS (
  SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id,
         CASE user_id % 3 WHEN 0 THEN 'EmailScanner' WHEN 1 THEN 'OCRPipeline' ELSE 'DocTranslator' END AS workflow_name,
         {STEP_CASE} AS step_name,
         props AS step_value,
         CAST(1 + CAST(floor(value) AS INTEGER) % 5 AS INTEGER) AS item_count,
         CASE WHEN ({STEP_CASE}) LIKE '%\\_failed' ESCAPE '\\' THEN 'Failed' ELSE 'Completed' END AS status,
         ts AS logged_at,
         CASE WHEN ({STEP_CASE}) LIKE '%\\_failed' ESCAPE '\\' THEN event_type END AS detail
  FROM events)"""

_DOC_NAME = ("'source/' || CASE WHEN d.doc_id % 4 = 0 THEN 'doc-' ELSE 'doc_' END || CAST(d.doc_id AS VARCHAR) "
             "|| '_' || d.lang || CASE WHEN d.doc_id % 7 = 0 THEN '.PDF' WHEN d.doc_id % 11 = 0 THEN '.txt' "
             "ELSE '.pdf' END")

FIXTURES["source_blobs"] = f"""
source_blobs AS (
  SELECT d.doc_id, 'raw-invoices' AS container, {_DOC_NAME} AS name, e.ts AS last_modified, d.n_chars AS size
  FROM documents d JOIN events e ON e.event_id = d.doc_id * 5)"""


def _as_of(sql: str) -> str:
    """The same with the source listing as it was at the anchor."""
    join = "JOIN events e ON e.event_id = d.doc_id * 5)"
    return sql.replace(join, join[:-1] + f" WHERE e.ts <= {AS_OF_BLOB})")


# stem of 'source/<base>': base has exactly one dot in the fixture names
FIXTURES["target_blobs"] = """
target_blobs AS (
  SELECT doc_id, 'ocr-invoices' AS container,
         translate(regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\\.[^.]+$', '')
                   || CASE WHEN doc_id % 2 = 0 THEN '_ocr.pdf' ELSE '_enhanced_ocr.pdf' END, ' -', '__') AS name,
         last_modified, size
  FROM source_blobs WHERE doc_id % 3 <> 0)"""

FIXTURES["messages"] = """
messages AS (
  SELECT o.o_orderkey AS id,
         CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE 'Order ' || CAST(o.o_orderkey AS VARCHAR) END AS subject,
         CASE WHEN o.o_orderkey % 8 = 0 THEN NULL ELSE c.c_name END AS from_name,
         replace(lower(c.c_name), '#', '.') || '@example.com' AS from_address,
         o.o_orderdate AS received_at,
         o.o_orderstatus <> 'P' AS has_attachments
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

FIXTURES["attachments"] = """
attachments AS (
  SELECT l_orderkey AS message_id,
         CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS att_id,
         'att_' || CAST(l_linenumber AS VARCHAR) || '.pdf' AS name,
         CASE l_partkey % 6 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'Application/PDF; name=x'
              WHEN 2 THEN 'image/png' WHEN 3 THEN 'image/tiff' WHEN 4 THEN 'application/msword' ELSE NULL END AS content_type,
         CAST(floor(l_quantity) AS BIGINT) * 10 AS size,
         CASE WHEN l_suppkey % 9 = 1 THEN NULL ELSE l_suppkey % 9 = 0 END AS is_inline,
         l_returnflag <> 'R' AS is_valid,
         CASE WHEN l_returnflag <> 'R' THEN 'Valid invoice.' ELSE 'Rejected: ' || l_linestatus END AS reason,
         l_shipdate AS written_at,
         l_extendedprice AS tiebreak,
         l_partkey AS part_key,
         l_linenumber AS line_no
  FROM lineitem)"""

FIXTURES["ocr_text"] = f"""
ocr_text AS (
  SELECT d.doc_id, {_DOC_NAME} AS filename, d.text, d.lang FROM documents d)"""

FIXTURES["order_vendor"] = """
order_vendor AS (
  SELECT l.l_orderkey, l.vendor_key, s.s_name AS vendor_name
  FROM (SELECT l_orderkey, min(l_suppkey) AS vendor_key FROM lineitem GROUP BY l_orderkey) l
  LEFT JOIN supplier s ON l.vendor_key = s.s_suppkey)"""

FIXTURES["invoice_text"] = """
invoice_text AS (
  SELECT o.o_orderkey AS doc_id,
         concat_ws(chr(10),
           CASE WHEN o.o_orderkey % 9 = 0 THEN 'DELIVERY NOTE' WHEN o.o_orderkey % 11 = 0 THEN 'CREDIT NOTE' ELSE 'INVOICE' END,
           CASE WHEN o.o_orderkey % 13 <> 0 THEN CASE o.o_orderkey % 5 WHEN 1 THEN 'Invoice Number: ' WHEN 2 THEN 'Invoice # '
                WHEN 3 THEN 'Document Number: ' WHEN 4 THEN 'Reference Number: ' ELSE 'Invoice No: ' END || 'INV' || CAST(o.o_orderkey AS VARCHAR) END,
           CASE WHEN o.o_orderkey % 29 = 0 THEN 'Invoice Date: 31-31-2024' ELSE
           'Invoice Date: ' || CASE o.o_orderkey % 4 WHEN 0 THEN strftime(o.o_orderdate, '%d-%m-%Y')
                                   WHEN 1 THEN strftime(o.o_orderdate, '%d/%m/%Y')
                                   WHEN 2 THEN strftime(o.o_orderdate, '%Y-%m-%d')
                                   ELSE upper(strftime(o.o_orderdate, '%d-%b-%Y')) END END,
           CASE WHEN o.o_orderkey % 31 = 0 THEN 'e-Serbest Meslek Makbuzu' WHEN o.o_orderkey % 37 = 0 THEN 'Dekont'
                WHEN o.o_orderkey % 41 = 0 THEN 'Import goods' WHEN o.o_orderkey % 47 = 0 THEN 'NOTERLÎK E-MAKBUZU' END,
           CASE WHEN v.vendor_name IS NOT NULL THEN 'Vendor: ' || v.vendor_name END,
           CASE WHEN o.o_orderkey % 2 = 0 THEN 'PO: 45' || lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0') END,
           'Currency: ' || CASE o.o_orderkey % 4 WHEN 0 THEN 'TRY' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'JPY' END,
           CASE WHEN o.o_orderkey % 6 = 1 THEN 'Total: 5 items' END,
           CASE WHEN o.o_orderkey % 3 = 0 THEN 'Grand Total: ' ELSE 'Total: ' END ||
             CASE o.o_orderkey % 5 WHEN 0 THEN replace(CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
               WHEN 1 THEN format('{:,.2f}', CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DOUBLE))
               ELSE CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END,
           CASE WHEN o.o_orderkey % 4 <> 3 THEN 'Net amount: ' || CAST(o.o_orderkey * 91 // 100 AS VARCHAR) || '.' || lpad(CAST(o.o_orderkey * 91 % 100 AS VARCHAR), 2, '0') END,
           CASE WHEN o.o_orderkey % 4 = 0 THEN 'Tax ' || CAST(o.o_orderkey % 9 + 1 AS VARCHAR) || '%: ' || CAST(o.o_orderkey * 7 // 100 AS VARCHAR) || '.' || lpad(CAST(o.o_orderkey * 7 % 100 AS VARCHAR), 2, '0') END,
           CASE WHEN o.o_orderkey % 4 = 1 THEN 'VAT (' || CAST(o.o_orderkey % 20 + 1 AS VARCHAR) || ',5%)' || chr(10) || 'VAT amount: ' || CAST(o.o_orderkey * 13 // 100 AS VARCHAR) || '.' || lpad(CAST(o.o_orderkey * 13 % 100 AS VARCHAR), 2, '0') END,
           CASE WHEN o.o_orderkey % 8 = 2 THEN 'Withholding rate: ' || CAST(o.o_orderkey % 3 + 2 AS VARCHAR) || '%' END,
           CASE WHEN o.o_orderkey % 3 = 1 THEN 'Vendor No: V-' || CAST(o.o_orderkey * 3 AS VARCHAR) END,
           CASE WHEN o.o_orderkey % 3 = 2 THEN 'Account No: ' || lpad(CAST(o.o_orderkey * 17 AS VARCHAR), 12, '1') || chr(10) || 'SWIFT: BNKA'
             || lpad(CAST(o.o_orderkey % 10000 AS VARCHAR), 4, '0') || chr(10) || 'Bank key: BK' || CAST(o.o_orderkey AS VARCHAR) END,
           CASE WHEN o.o_orderkey % 7 = 0 THEN 'Tax ID: ' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '2') || chr(10) || 'Buyer VAT ID: TR'
             || lpad(CAST(o.o_orderkey AS VARCHAR), 9, '3') || chr(10) || 'Buyer: Buyer ' || CAST(o.o_orderkey % 100 AS VARCHAR) END) AS text
  FROM orders o LEFT JOIN order_vendor v ON o.o_orderkey = v.l_orderkey)"""

_STYLED = """CASE {k} % 5 WHEN 0 THEN replace(CAST(CAST({c} / 100.0 AS DECIMAL(18,2)) AS VARCHAR), '.', ',') WHEN 1 THEN format('{{:,.2f}}', {c} / 100.0)
    WHEN 2 THEN translate(format('{{:,.2f}}', {c} / 100.0), ',.', '.,') ELSE CAST(CAST({c} / 100.0 AS DECIMAL(18,2)) AS VARCHAR) END"""
FIXTURES["itemised_invoice_text"] = f"""
item_lines AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey, q, price, words NULLS FIRST) AS n FROM (
    SELECT l_orderkey AS k, l_linenumber, l_partkey, l_suppkey, CAST(floor(l_quantity) AS BIGINT) AS q, CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS price,
           CASE p_type WHEN 'ECONOMY' THEN 'Office cleaning service' WHEN 'SMALL' THEN 'Printing of brochures' WHEN 'MEDIUM' THEN 'Machine maintenance'
             WHEN 'PROMO' THEN 'Advertising campaign' WHEN 'STANDARD' THEN 'Steel rods 12 mm' WHEN 'LARGE' THEN 'Freight to plant' END AS words
    FROM lineitem JOIN part ON l_partkey = p_partkey)),
item_tables AS (
  SELECT k, CASE k % 7 WHEN 3 THEN 'No  Description  Qty  Unit  Unit price  Net amount' WHEN 5 THEN 'No  Description  Quantity  VAT %  Net amount'
              ELSE 'No  Description  Qty  Unit  Unit price  VAT %  Net amount' END || chr(10) || string_agg(line, chr(10) ORDER BY n) || chr(10) || 'Payment within 30 days' AS t
  FROM (SELECT k, n, CAST(n AS VARCHAR) || '  ' || coalesce(words, 'Consulting') || CASE WHEN (k + n) % 4 = 0 THEN chr(10) || '    as ordered' ELSE '' END || ' ' || CAST(q AS VARCHAR)
          || CASE WHEN k % 7 = 5 THEN '' ELSE ' ' || CASE l_partkey % 3 WHEN 0 THEN 'EA' WHEN 1 THEN 'HUR' ELSE 'kg' END || ' ' || {_STYLED.format(k='k', c='price')} END
          || CASE WHEN k % 7 = 3 THEN '' ELSE ' ' || CAST(l_partkey % 20 + 1 AS VARCHAR) || '%' END || ' ' || {_STYLED.format(k='k', c='(q * price)')}
          || CASE WHEN (k + n) % 4 = 1 THEN chr(10) || '    as agreed' ELSE '' END AS line FROM item_lines) GROUP BY k),
itemised_invoice_text AS (
  SELECT doc_id, concat_ws(chr(10), i.text, CASE WHEN doc_id % 4 = 0 THEN 'VAT (8%)' || chr(10) || 'VAT amount: ' || CAST(doc_id * 11 // 100 AS VARCHAR) || '.' || lpad(CAST(doc_id * 11 % 100 AS VARCHAR), 2, '0') END, t.t) AS text
  FROM invoice_text i LEFT JOIN item_tables t ON t.k = i.doc_id)"""

FIXTURES["ocr_pairs"] = f"""
ocr_pairs AS (
  SELECT d.doc_id, {_DOC_NAME} AS name, text AS original_text,
         CASE WHEN doc_id % 2 = 0 THEN regexp_replace(text, '[.]', ' ', 'g') ELSE text END AS ocr_text
  FROM documents d)"""

FIXTURE_DEPS = {
    "target_blobs": ["source_blobs"],
    "invoice_text": ["order_vendor"],
    "itemised_invoice_text": ["invoice_text"],
}


def with_fixtures(names, body: str) -> str:
    order: list[str] = []

    def add(n):
        for d in FIXTURE_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(FIXTURES[n].strip() for n in order) + "\n" + body.strip()


# ---------------------------------------------------------------------------------------------
# lineage (A6, A7, C7, E1, E2, E7, E8, F5, J5)
# ---------------------------------------------------------------------------------------------
PERIOD_SQL = {
    "today": "CAST(logged_at AS DATE) = DATE '2024-01-30'",
    "yesterday": "CAST(logged_at AS DATE) = DATE '2024-01-29'",
    "last_7_days": f"logged_at >= {AS_OF_LOG} - INTERVAL 7 DAY",
    "last_30_days": f"logged_at >= {AS_OF_LOG} - INTERVAL 30 DAY",
    "overall": "1=1",
}


def _summary_sql(period: str, extra_cols: str = "") -> str:
    metrics = ",\n  ".join(
        f"CAST(COALESCE(SUM(item_count) FILTER (WHERE step_name = {_q(step)}), 0) AS BIGINT) AS {key}"
        for key, step in vocab.SUMMARY_METRICS)
    return with_fixtures(["process_log"], f"""
SELECT {_q(period)} AS period,
  {metrics}{extra_cols}
FROM process_log WHERE {PERIOD_SQL[period]}""")


def lineage_sql() -> dict[str, str]:
    out = {}
    for p in vocab.VALID_PERIODS:
        out[f"lineage_summary_{p}"] = _summary_sql(p)
        out[f"lineage_counts_{p}"] = with_fixtures(["process_log"], f"""
SELECT step_name, CAST(SUM(item_count) AS BIGINT) AS total
FROM process_log WHERE {PERIOD_SQL[p]} GROUP BY step_name""")
    out["lineage_response"] = _summary_sql(
        "last_7_days", ",\n  'TR' AS filter_country_code, CAST(NULL AS VARCHAR) AS filter_source_lang")
    out["scan_process_log"] = with_fixtures(["process_log"], f"""
SELECT * FROM process_log WHERE {PERIOD_SQL['yesterday']}""")
    out["preview_process_log"] = with_fixtures(["process_log"], """
SELECT * FROM process_log ORDER BY logged_at DESC, run_id, step_name, step_value LIMIT 5""")
    out["workflow_step_counts"] = with_fixtures(["process_log"], f"""
SELECT workflow_name, step_name, CAST(SUM(item_count) AS BIGINT) AS total, COUNT(*) AS n_rows
FROM process_log WHERE {PERIOD_SQL['last_30_days']} GROUP BY ROLLUP (workflow_name, step_name)""")
    out["sealed_workflow_totals"] = with_fixtures(["process_log"], """
SELECT workflow_name, step_name, CAST(SUM(item_count) AS BIGINT) AS total, COUNT(*) AS n_rows
FROM process_log WHERE CAST(logged_at AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY workflow_name, step_name""")
    out["run_drilldown"] = with_fixtures(["process_log"], """
SELECT * FROM process_log WHERE run_id = 'run-7'""")
    out["latest_step_per_run"] = with_fixtures(["process_log"], """
SELECT run_id, s.logged_at, s.workflow_name, s.step_name, s.step_value, s.item_count, s.status FROM (
  SELECT run_id, max({'logged_at': logged_at, 'step_name': step_name, 'step_value': step_value,
                      'item_count': item_count, 'status': status, 'workflow_name': workflow_name}) AS s
  FROM process_log GROUP BY run_id)""")
    return out




# ---------------------------------------------------------------------------------------------
# naming
# ---------------------------------------------------------------------------------------------
FIXTURES["blob_names"] = """
blob_names AS (
  SELECT 'doc' AS origin, doc_id AS item_id, filename AS name, lang FROM ocr_text
  UNION ALL
  SELECT 'page', page_id,
         CASE WHEN page_id % 5 = 0 THEN './' || p WHEN page_id % 7 = 0 THEN replace(p, '/', '//') ELSE p END,
         nullif(regexp_extract(p, '^([a-z]{2})/', 1), '')
  FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1) AS p FROM pages))"""
FIXTURE_DEPS["blob_names"] = ["ocr_text"]


def path_ctes(src: str, name: str = "name", out: str = "paths") -> str:
    """CTEs adding _p (normalised), _base, _dir, _suf, _stem, _clean, _lang."""
    norm = (f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({name}, '/{{2,}}', '/', 'g'), "
            f"'^(\\./)+', ''), '/(\\./)+', '/', 'g'), '(.)/+$', '\\1')")
    return f""",
{out}_0 AS (SELECT *, {norm} AS _p FROM {src}),
{out}_1 AS (SELECT *, regexp_extract(_p, '([^/]*)$', 1) AS _base, regexp_extract(_p, '^(.*/)', 1) AS _dir FROM {out}_0),
{out}_2 AS (SELECT *, regexp_extract(_base, '^.+(\\.[^.]+)$', 1) AS _suf FROM {out}_1),
{out}_3 AS (SELECT *, CASE WHEN _suf = '' THEN _base ELSE substr(_base, 1, length(_base) - length(_suf)) END AS _stem FROM {out}_2),
{out} AS (SELECT *, regexp_replace(_stem, '_([a-zA-Z]{{2}})$', '') AS _clean,
                 lower(nullif(regexp_extract(_stem, '_([a-zA-Z]{{2}})$', 1), '')) AS _lang FROM {out}_3)"""


def _names_sql(select: str) -> str:
    return with_fixtures(["blob_names"], "") .replace("WITH ", "WITH ", 1) + path_ctes("blob_names") + \
        f"\nSELECT origin, item_id, name, {select} FROM paths"


def _map_case(expr: str, pairs, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {_q(k)} THEN {_q(v)}" for k, v in pairs) + f" ELSE {_q(default)} END"


def naming_sql() -> dict[str, str]:
    out = {
        "path_stem_suffix": _names_sql("_base AS base, _dir AS dir, _stem AS stem, lower(_suf) AS suffix"),
        "extract_source_lang": _names_sql("_lang AS source_lang"),
        "clean_stem": _names_sql("_clean AS clean_stem"),
        "translated_blob_name": _names_sql("_dir || _clean || '_en' || _suf AS translated_name"),
        "json_blob_name": _names_sql("_dir || _clean || '_en.json' AS json_name"),
        "raw_invoice_blob_name": _names_sql("_dir || _clean || '_' || coalesce(lang, 'xx') || _suf AS raw_name"),
        "normalize_blob_name": _names_sql("translate(name, ' -', '__') AS normalized"),
        "ocr_output_name": _names_sql(
            "translate(_stem || CASE WHEN item_id % 2 = 1 THEN '_enhanced_ocr.pdf' ELSE '_ocr.pdf' END, ' -', '__')"
            " AS ocr_name"),
        "effective_lang": _names_sql("coalesce(_lang, 'de') AS lang_used"),
        "mime_lookup": _names_sql(
            _map_case("lower(_suf)", vocab.ATTACHMENT_CONTENT_TYPES, vocab.DEFAULT_CONTENT_TYPE) + " AS attachment_type, "
            + _map_case("lower(_suf)", vocab.DOCUMENT_CONTENT_TYPES, vocab.DEFAULT_CONTENT_TYPE) + " AS document_type"),
    }
    tb = FIXTURES["target_blobs"].replace("WHERE doc_id % 3 <> 0", "WHERE doc_id % 3 <> 0").replace(
        "WHERE e.ts <= ", "WHERE e.ts <= ")
    out["strip_ocr_suffix"] = (
        "WITH " + FIXTURES["source_blobs"].strip() + ",\n"
        + tb.strip() + path_ctes("target_blobs")
        + "\nSELECT doc_id, name, regexp_replace(lower(_stem), '(_enhanced)?_ocr$', '') AS stem_key FROM paths")
    out["normalize_mime"] = with_fixtures(["attachments"], """
SELECT message_id, att_id, content_type,
       trim(split_part(lower(coalesce(content_type, '')), ';', 1)) AS mime FROM attachments""")
    return out


# ---------------------------------------------------------------------------------------------
# listing
# ---------------------------------------------------------------------------------------------
FIXTURES["translated_blobs"] = """
translated_blobs AS (
  SELECT 'translated-invoices' AS container, _dir || _clean || '_en' || _suf AS name, last_modified
  FROM src_paths WHERE doc_id % 5 <> 0
  UNION ALL
  SELECT 'translated-invoices', _dir || _clean || '_en.json', last_modified
  FROM src_paths WHERE doc_id % 5 <> 0 AND doc_id % 3 <> 0)"""

FIXTURES["blob_writes"] = """
blob_writes AS (
  SELECT CASE WHEN is_valid THEN 'raw-invoices' ELSE 'invalid-invoices' END AS container,
         CAST(message_id AS VARCHAR) || '/' || name AS name, written_at, tiebreak, size, att_id, message_id
  FROM attachments)"""
FIXTURE_DEPS["blob_writes"] = ["attachments"]

L_COLS = "container, name, last_modified, size"
SRC_STEM = "lower(CASE WHEN _suf = '' THEN _base ELSE substr(_base, 1, length(_base) - length(_suf)) END)"


def _today(t: str) -> str:
    return (f"SELECT * FROM {t} WHERE CAST(last_modified AS DATE) = DATE '2024-01-10' "
            f"AND lower(name) LIKE '%.pdf'")


def _reconcile_body(normalize: bool) -> str:
    key = "translate(_skey, ' -', '__')" if normalize else "_skey"
    return f""",
src_today AS ({_today('source_blobs')}),
tgt_today AS ({_today('target_blobs')}){path_ctes('src_today', out='sp')}{path_ctes('tgt_today', out='tp')},
src_keys AS (SELECT *, {SRC_STEM} AS _skey FROM sp),
tgt_keys AS (SELECT DISTINCT regexp_replace(lower(_stem), '(_enhanced)?_ocr$', '') AS k FROM tp),
recon AS (SELECT {L_COLS} FROM src_keys s WHERE NOT EXISTS (SELECT 1 FROM tgt_keys t WHERE t.k = {key}))"""


def listing_sql() -> dict[str, str]:
    out = {}
    base = with_fixtures(["source_blobs"], "")
    out["scan_blob_listing"] = base + f"\nSELECT {L_COLS} FROM source_blobs"
    out["lookback_filter"] = _as_of(base) + f"\nSELECT {L_COLS} FROM source_blobs WHERE last_modified >= {AS_OF_BLOB} - INTERVAL 12 HOUR"
    out["pdf_filter"] = base + f"\nSELECT {L_COLS} FROM source_blobs WHERE lower(name) LIKE '%.pdf'"
    out["same_utc_day_filter"] = _as_of(base) + f"\nSELECT {L_COLS} FROM source_blobs WHERE CAST(last_modified AS DATE) = DATE '2024-01-10'"
    tb = _as_of(with_fixtures(["target_blobs"], ""))
    for norm, key in ((False, "reconcile_unprocessed"), (True, "reconcile_unprocessed_normalized")):
        out[key] = tb + _reconcile_body(norm) + "\nSELECT * FROM recon"
    out["reconcile_with_manifest"] = out["reconcile_unprocessed"]
    for hours, key in ((12, "ocr_worklist"), (0, "ocr_worklist_reconcile")):
        out[key] = tb + _reconcile_body(False) + f""",
prim AS (SELECT {L_COLS}, 'lookback' AS path FROM source_blobs
         WHERE last_modified >= {AS_OF_BLOB} - INTERVAL {hours} HOUR AND lower(name) LIKE '%.pdf')
SELECT * FROM prim UNION ALL SELECT *, 'reconcile' AS path FROM recon WHERE NOT EXISTS (SELECT 1 FROM prim)"""
    src_paths = path_ctes("source_blobs", out="src_paths")
    skip_base = with_fixtures(["source_blobs"], "") + src_paths + "," + FIXTURES["translated_blobs"]
    out["skip_if_exists"] = skip_base + """,
s AS (SELECT name, _dir || _clean || '_en' || _suf AS target_name FROM src_paths)
SELECT name, target_name, CASE WHEN target_name IN (SELECT name FROM translated_blobs) THEN 'skipped' ELSE 'todo' END AS status
FROM s"""
    out["skip_if_exists_both_outputs"] = skip_base + """,
s AS (SELECT name, _dir || _clean || '_en' || _suf AS target_name, _dir || _clean || '_en.json' AS target_json FROM src_paths)
SELECT name, target_name, target_json,
       CASE WHEN target_name IN (SELECT name FROM translated_blobs) AND target_json IN (SELECT name FROM translated_blobs)
            THEN 'skipped' ELSE 'todo' END AS status
FROM s"""
    sb_all = FIXTURES["source_blobs"].strip()
    out["dedup_listing"] = "WITH " + sb_all + f""",
pages AS (
  SELECT {L_COLS} FROM source_blobs
  UNION ALL
  SELECT {L_COLS} FROM source_blobs WHERE last_modified <= TIMESTAMP '2024-01-10 06:00:00')
SELECT container, name, max(last_modified) AS last_modified, arg_max(size, last_modified) AS size
FROM (SELECT DISTINCT * FROM pages) GROUP BY container, name"""
    out["latest_write_per_blob"] = with_fixtures(["blob_writes"], """
SELECT container, name, w.written_at, w.tiebreak, w.size, w.att_id, w.message_id FROM (
  SELECT container, name, max({'written_at': written_at, 'tiebreak': tiebreak, 'size': size, 'att_id': att_id,
                               'message_id': message_id}) AS w
  FROM blob_writes GROUP BY container, name)""")
    out["target_name_collisions"] = with_fixtures(["attachments"], "") + """,
t AS (
  SELECT message_id, att_id, name,
         CASE WHEN is_valid THEN 'raw-invoices/' || regexp_replace(regexp_extract(name, '^(.*)\\.[^.]+$', 1), '_([a-zA-Z]{2})$', '') || '_en' || regexp_extract(name, '^.+(\\.[^.]+)$', 1)
              ELSE 'invalid-invoices/' || name END AS target_name
  FROM (SELECT message_id, att_id, is_valid, CASE WHEN message_id % 3 = 0 THEN message_id || '-' || att_id || '-' || name
                                                  ELSE name END AS name FROM attachments)),
c AS (SELECT target_name, count(*) AS n_sources FROM t GROUP BY target_name HAVING count(*) > 1)
SELECT t.message_id, t.att_id, t.name, t.target_name, c.n_sources FROM t JOIN c USING (target_name)"""
    return out




# ---------------------------------------------------------------------------------------------
# mail
# ---------------------------------------------------------------------------------------------
DENY = ", ".join(_q(x) for x in vocab.SKIP_ATTACHMENT_TYPES)
ALLOW = ", ".join(_q(x) for x in vocab.SUPPORTED_ATTACHMENT_TYPES)
MIME = "trim(split_part(lower(coalesce(content_type, '')), ';', 1))"
USABLE = f"NOT coalesce(is_inline, false) AND {MIME} NOT IN ({DENY}) AND coalesce(size, 0) >= 100"
WIN_ALL = "received_at >= TIMESTAMP '1994-08-02 00:00:00' AND has_attachments"
WIN_30 = "received_at >= TIMESTAMP '2001-07-02 00:00:00' AND has_attachments"
SENDER = ("coalesce(subject, '(no subject)') AS subject, coalesce(from_address, '') AS sender_email, "
          "coalesce(from_name, split_part(coalesce(from_address, ''), '@', 1)) AS sender_name")


def mail_sql() -> dict[str, str]:
    out = {}
    m = with_fixtures(["messages"], "")
    a = with_fixtures(["attachments"], "")
    ma = with_fixtures(["messages", "attachments"], "")
    stand_in = ma + f""",
outcomes AS (SELECT * FROM attachments WHERE {USABLE}
             AND message_id IN (SELECT id FROM messages WHERE {WIN_ALL}))"""
    out["scan_messages"] = m + f"\nSELECT id, subject, from_name, from_address, received_at, has_attachments FROM messages WHERE {WIN_30}"
    out["message_window_filter"] = m + f"\nSELECT id, received_at FROM messages WHERE {WIN_ALL}"
    out["usable_attachment_filter"] = a + f"\nSELECT message_id, att_id, content_type, size FROM attachments WHERE {USABLE}"
    out["supported_mime_filter"] = a + (f"\nSELECT message_id, att_id, content_type FROM attachments "
                                        f"WHERE {USABLE} AND {MIME} IN ({ALLOW})")
    out["scan_attachments"] = ma + (f"\nSELECT message_id, att_id, name, content_type, size FROM attachments "
                                    f"WHERE {USABLE} AND message_id IN (SELECT id FROM messages WHERE {WIN_30})")
    out["decode_attachment_payload"] = a + """
SELECT message_id, att_id,
       CAST(octet_length(from_base64(coalesce(CASE WHEN content_type IS NOT NULL THEN to_base64(encode(reason)) END, ''))) AS INTEGER) AS n_bytes,
       decode(from_base64(coalesce(CASE WHEN content_type IS NOT NULL THEN to_base64(encode(reason)) END, ''))) AS payload_text
FROM attachments"""
    out["message_attachments"] = ma + f"""
SELECT a.message_id, a.att_id, m.subject, m.sender_email, m.sender_name
FROM attachments a JOIN (SELECT id, {SENDER} FROM messages WHERE {WIN_ALL}) m ON a.message_id = m.id
WHERE {USABLE.replace('is_inline', 'a.is_inline').replace('size', 'a.size')}"""
    out["sender_name_default"] = m + ("\nSELECT id, coalesce(from_address, '') AS sender_email, "
                                      "coalesce(from_name, split_part(coalesce(from_address, ''), '@', 1)) AS sender_name "
                                      "FROM messages")
    out["subject_filename_defaults"] = ma + """
SELECT a.message_id, a.att_id,
       coalesce(CASE WHEN a.size >= 100 THEN a.name END, 'attachment_' || a.att_id) AS filename,
       coalesce(m.subject, '(no subject)') AS subject
FROM attachments a JOIN messages m ON a.message_id = m.id"""
    out["skip_message_without_usable_attachments"] = ma + (
        f"\nSELECT id FROM messages WHERE {WIN_ALL} AND id IN (SELECT message_id FROM attachments WHERE {USABLE})")
    out["message_rollup"] = stand_in + """
SELECT message_id,
       CAST(sum(CASE WHEN is_valid THEN 1 ELSE 0 END) AS BIGINT) AS valid_count,
       CAST(sum(CASE WHEN is_valid THEN 0 ELSE 1 END) AS BIGINT) AS invalid_count,
       count(*) > 0 AND sum(CASE WHEN is_valid THEN 0 ELSE 1 END) = 0 AS all_valid,
       count(*) > 0 AND sum(CASE WHEN is_valid THEN 1 ELSE 0 END) = 0 AS all_invalid
FROM outcomes GROUP BY message_id"""
    out["scan_summary"] = stand_in + f"""
SELECT (SELECT count(*) FROM messages WHERE {WIN_ALL}) AS messages_scanned,
       count(DISTINCT message_id) AS messages_with_attachments,
       count(*) AS total_attachments,
       CAST(coalesce(sum(CASE WHEN is_valid THEN 1 ELSE 0 END), 0) AS BIGINT) AS valid_invoices,
       CAST(coalesce(sum(CASE WHEN is_valid THEN 0 ELSE 1 END), 0) AS BIGINT) AS invalid_invoices
FROM outcomes"""
    out["run_exit_status"] = stand_in + "\nSELECT coalesce(max(CASE WHEN NOT is_valid THEN 1 ELSE 0 END), 0) AS exit_code FROM outcomes"
    out["split_valid_invalid"] = stand_in + """
SELECT message_id, att_id, is_valid, CASE WHEN is_valid THEN 'valid' ELSE 'invalid' END AS half FROM outcomes"""
    ct = _map_case("lower(regexp_extract(name, '^.+(\\.[^.]+)$', 1))", vocab.ATTACHMENT_CONTENT_TYPES,
                   vocab.DEFAULT_CONTENT_TYPE)
    out["route_by_outcome"] = stand_in + f"""
SELECT message_id, att_id,
       CASE WHEN content_type IS NULL THEN NULL WHEN is_valid THEN 'raw-invoices' ELSE 'invalid-invoices' END AS container,
       CASE WHEN content_type IS NULL THEN NULL
            WHEN is_valid THEN regexp_replace(regexp_extract(name, '^(.*)\\.[^.]+$', 1), '_([a-zA-Z]{{2}})$', '') || '_en'
                               || regexp_extract(name, '^.+(\\.[^.]+)$', 1)
            ELSE name END AS blob_name,
       {ct} AS content_type
FROM outcomes WHERE content_type IS NOT NULL"""
    return out




# ---------------------------------------------------------------------------------------------
# text
# ---------------------------------------------------------------------------------------------
def _chunks_cte(size: int) -> str:
    return f""",
chunks AS (
  SELECT doc_id, CAST(i + 1 AS INTEGER) AS chunk_idx, substr(text, CAST(i * {size} + 1 AS BIGINT), {size}) AS chunk
  FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / {size}.0) AS BIGINT))) AS i FROM ocr_text))"""


def _lang_ctes(src: str, text: str) -> str:
    """``dl``: the rows of ``src`` with detected, hits, total_hits, score, lang_code. Function words of the whole text; else the
    script of most letters; else, in up to eight Latin words, three-letter sequences weighed by counts of the samples."""
    hits = ",\n".join(
        f"       len(list_filter(tok, lambda t: list_contains([{', '.join(_q(w) for w in FUNCTION_WORDS[l])}], t))) AS h_{l}"
        for l in LANGS)
    best = "CASE " + " ".join(
        "WHEN " + " AND ".join([f"h_{l} >= h_{o}" for o in LANGS[i + 1:]] + [f"h_{l} > h_{o}" for o in LANGS[:i]])
        + f" THEN '{l}'" for i, l in enumerate(LANGS[:-1])) + f" ELSE '{LANGS[-1]}' END"
    total = " + ".join(f"h_{l}" for l in LANGS)
    top = "greatest(" + ", ".join(f"h_{l}" for l in LANGS) + ")"

    def count(chars: str) -> str:
        return f"length(regexp_replace(low, '[^{chars}]', '', 'g'))"

    groups = {k: "".join(rf"\p{{{x}}}" for x in xs) for k, xs in langdata.SCRIPTS.items()}
    counts = ", ".join(f"{count(c)} AS n_{k}" for k, c in groups.items())
    most = "greatest(" + ", ".join(f"n_{k}" for k in groups) + ")"
    script = f"""CASE WHEN n_cjk = mx THEN CASE WHEN {count(r'\p{Hiragana}\p{Katakana}')} * 5 >= n_cjk THEN 'ja' ELSE 'zh' END WHEN n_ko = mx THEN 'ko'
      WHEN n_cyrillic = mx THEN CASE WHEN {count(langdata.SERBIAN)} > 0 THEN 'sr' WHEN {count(langdata.UKRAINIAN)} > {count(langdata.RUSSIAN)} THEN 'uk'
        WHEN {count(langdata.BULGARIAN)} * 100 >= n_cyrillic AND {count(langdata.RUSSIAN)} = 0 THEN 'bg' ELSE 'ru' END
      WHEN n_arabic = mx THEN CASE WHEN {count(langdata.URDU)} > 0 THEN 'ur' WHEN {count(langdata.PERSIAN)} > 0 THEN 'fa' ELSE 'ar' END
      WHEN n_el = mx THEN 'el' WHEN n_he = mx THEN 'he' WHEN n_th = mx THEN 'th' ELSE 'hi' END"""
    samples = ", ".join(f"('{l}', {_q(t)})" for l, t in langdata.SAMPLES.items())
    grams = "unnest(list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3)))"
    return f""",
tk AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, lower(coalesce({text}, '')) AS low, regexp_extract_all(lower({text}), '\\p{{L}}+') AS tok FROM {src}),
hh AS (SELECT *, coalesce(len(tok), 0) AS n_tok,
{hits}
       FROM tk),
hw AS (SELECT *, coalesce({top}, 0) AS top, coalesce({total}, 0) AS total, CASE WHEN ({total}) > 0 THEN {best} END AS w_lang,
  CASE WHEN ({total}) > 0 THEN {top} / ({total}) ELSE 0.0 END AS w_score FROM hh),
enough AS (SELECT *, top >= 2 AND 50 * top >= n_tok AND w_score >= 0.5 AS sure, regexp_matches(low, '[{"".join(groups.values())}]') AS beyond FROM hw),
sc0 AS (SELECT rid, low, {counts}, {count(r'\p{Latin}')} AS n_latin FROM enough WHERE beyond AND NOT sure),
sc1 AS (SELECT *, {most} AS mx, n_latin + {" + ".join(f"n_{k}" for k in groups)} AS every FROM sc0),
sc AS (SELECT rid, CASE WHEN mx >= 2 THEN {script} END AS s_lang, CASE WHEN every > 0 THEN mx / every ELSE 0.0 END AS s_score FROM sc1),
sample_grams AS (SELECT lang, g, count(*) AS c FROM (SELECT lang, {grams} AS g FROM (SELECT lang, unnest(regexp_extract_all(lower(t), '\\p{{L}}+')) AS w
  FROM (VALUES {samples}) AS v(lang, t))) GROUP BY lang, g),
sample_sums AS (SELECT lang, sum(c) AS n, (SELECT count(DISTINCT g) FROM sample_grams) AS kinds FROM sample_grams GROUP BY lang),
short_grams AS (SELECT rid, {grams} AS g FROM (SELECT rid, unnest(tok) AS w FROM enough WHERE NOT sure AND NOT beyond AND n_tok BETWEEN 1 AND 8)),
weighed AS (SELECT rid, s.lang, sum(CAST(floor(1000 * ln((coalesce(c, 0) + 1) / (n + kinds))) AS BIGINT)) AS w
  FROM short_grams x CROSS JOIN sample_sums s LEFT JOIN sample_grams p ON p.lang = s.lang AND p.g = x.g GROUP BY rid, s.lang),
pf AS (SELECT rid, l[1].lang AS p_lang, (l[1].w - l[2].w) / (l[1].w - l[2].w + 1000.0) AS p_score
  FROM (SELECT rid, list({{'w': w, 'lang': lang}} ORDER BY w DESC, lang DESC) AS l FROM weighed GROUP BY rid)),
found AS (SELECT enough.*, CASE WHEN sure THEN 'w' WHEN s_lang IS NOT NULL AND s_score >= 0.5 THEN 's' WHEN p_score >= 0.5 THEN 'p' END AS by_what, s_lang, s_score, p_lang, p_score
  FROM enough LEFT JOIN sc USING (rid) LEFT JOIN pf USING (rid)),
dl AS (SELECT * EXCLUDE (rid, low, tok, {", ".join(f"h_{l}" for l in LANGS)}, top, total, w_lang, w_score, sure, beyond, by_what, s_lang, s_score, p_lang, p_score),
  CASE WHEN NOT regexp_matches(low, '\\S') THEN NULL WHEN by_what = 's' THEN s_lang WHEN by_what = 'p' THEN p_lang ELSE w_lang END AS detected,
  CAST(top AS INTEGER) AS hits, CAST(total AS INTEGER) AS total_hits, CAST(CASE by_what WHEN 's' THEN s_score WHEN 'p' THEN p_score ELSE w_score END AS DOUBLE) AS score,
  CASE WHEN by_what IS NULL OR NOT regexp_matches(low, '\\S') THEN 'xx' WHEN by_what = 's' THEN s_lang WHEN by_what = 'p' THEN p_lang ELSE w_lang END AS lang_code FROM found)"""


def _lang_sql() -> str:
    return with_fixtures(["ocr_text"], "") + _lang_ctes("ocr_text", "text")


NUM_RE = "\\b\\d{1,3}(?:[ ,]\\d{3})*(?:\\.\\d+)?\\b"


def _num_sql(col: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all(coalesce({col}, ''), '{NUM_RE}'), lambda x: translate(x, ' ,', '')))"


def text_sql() -> dict[str, str]:
    out = {}
    ot = with_fixtures(["ocr_text"], "")
    out["text_prefix"] = ot + "\nSELECT doc_id, substr(text, 1, 500) AS prefix_500, substr(text, 1, 4000) AS prefix_4000 FROM ocr_text"
    out["chunk_text"] = ot + _chunks_cte(9000) + "\nSELECT doc_id, chunk_idx, chunk FROM chunks"
    out["chunk_index"] = ot + _chunks_cte(1000) + "\nSELECT doc_id, chunk_idx, CAST(length(chunk) AS INTEGER) AS chunk_len FROM chunks"
    out["reassemble_chunks"] = ot + _chunks_cte(2000) + """
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_chunks, string_agg('[EN]' || chunk, chr(10) ORDER BY chunk_idx) AS translated_text
FROM chunks GROUP BY doc_id"""
    tr_all = "array_to_string(list_transform(range(0, CAST(ceil(length(text) / 9000.0) AS BIGINT)), lambda i: '[EN]' || substr(text, CAST(i * 9000 + 1 AS BIGINT), 9000)), chr(10))"
    nchunks = "CAST(ceil(length(text) / 9000.0) AS INTEGER)"
    out["translate_documents"] = ot + f"""
SELECT doc_id, {nchunks} AS n_chunks, {tr_all} AS translated_text, CAST(NULL AS VARCHAR) AS translation_error FROM ocr_text"""
    out["translate_documents_distributed"] = out["translate_documents"]
    # fallback: 'es' fails then auto works; under auto a chunk without letters fails
    out["translate_with_fallback"] = ot + f""",
d AS (SELECT doc_id, lang, CASE WHEN doc_id % 10 = 3 THEN regexp_replace(text, '\\p{{L}}', '', 'g') ELSE text END AS text FROM ocr_text),
c AS (SELECT doc_id, lang, CAST(i + 1 AS INTEGER) AS idx, substr(text, CAST(i * 9000 + 1 AS BIGINT), 9000) AS chunk
      FROM (SELECT doc_id, lang, text, unnest(range(0, CAST(ceil(length(text) / 9000.0) AS BIGINT))) AS i FROM d)),
r AS (SELECT doc_id, idx, '[EN]' || chunk AS t,
             CASE WHEN lang = 'es' AND NOT regexp_matches(chunk, '\\p{{L}}') THEN 'language detection failed' END AS e FROM c),
g AS (SELECT doc_id, CAST(count(*) AS INTEGER) AS n_chunks,
             min(idx) FILTER (WHERE e IS NOT NULL) AS first_bad,
             string_agg(t, chr(10) ORDER BY idx) AS txt FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.n_chunks, 0) AS n_chunks,
       CASE WHEN g.doc_id IS NULL THEN '' WHEN g.first_bad IS NULL THEN g.txt END AS translated_text,
       CASE WHEN g.first_bad IS NOT NULL THEN 'language detection failed' END AS translation_error
FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""
    ls = _lang_sql()
    out["detect_language"] = ls + "\nSELECT doc_id, detected, hits, total_hits, score, lang_code FROM dl"
    letters = ["абвгдежзийклмнопрстуфхцчшщ", "あいうえおかきくけこさしすせそたちつてとなにぬねのは", "一二三四五六七八九十百千万上下左右中大小日月年火水木",
               "ابتثجحخدذرزسشصضطظعغفقكلمنه", "가나다라마바사아자차카타파하거너더러머버서어저처커터"]
    cases = " ".join(f"WHEN {i} THEN translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', '{x}')" for i, x in enumerate(letters))
    out["detect_language_scripts"] = with_fixtures(["ocr_text"], "") + f""",
scripts AS (SELECT doc_id, CASE doc_id % 6 {cases} ELSE text END AS text FROM ocr_text)""" + _lang_ctes("scripts", "text") + """
SELECT doc_id, detected, score, lang_code FROM dl"""
    prof = with_fixtures(["ocr_text"], "") + """,
pw AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS w FROM ocr_text),
pg AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3))) AS gram FROM pw),
pc AS (SELECT lang, gram, count(*) AS n FROM pg WHERE doc_id % 3 <> 1 AND lang IS NOT NULL GROUP BY lang, gram),
pt AS (SELECT lang, CAST(sum(n) AS BIGINT) AS total, count(*) AS kinds FROM pc GROUP BY lang),
pk AS (SELECT lang, gram, n FROM pc QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) <= 2000 UNION ALL SELECT lang, NULL, 0 FROM pt),
profiles AS (SELECT lang, gram, CAST(floor(ln((n + 1) / (total + kinds)) * 1000) AS BIGINT) AS weight FROM pk JOIN pt USING (lang))"""
    out["language_profiles"] = prof + "\nSELECT lang, gram, weight FROM profiles"
    out["language_profile_accuracy"] = prof + """,
held AS (SELECT doc_id, gram, count(*) AS n FROM pg WHERE doc_id % 3 = 1 GROUP BY doc_id, gram),
sums AS (SELECT doc_id, z.lang, sum(n * coalesce(p.weight, z.weight)) AS s FROM held CROSS JOIN (SELECT lang, weight FROM profiles WHERE gram IS NULL) z
  LEFT JOIN profiles p ON p.lang = z.lang AND p.gram = held.gram GROUP BY doc_id, z.lang),
best AS (SELECT doc_id, lang AS detected FROM sums QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) = 1)
SELECT lang, count(*) AS n_docs, count(*) FILTER (detected = lang) AS n_correct
FROM ocr_text LEFT JOIN best USING (doc_id) WHERE doc_id % 3 = 1 GROUP BY lang"""
    out["language_accuracy"] = ls + """
SELECT lang, count(*) AS n_docs, CAST(sum(CASE WHEN lang_code = lang THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       CAST(sum(CASE WHEN lang_code = 'xx' THEN 1 ELSE 0 END) AS BIGINT) AS n_unsure
FROM dl GROUP BY lang"""
    out["accept_lang"] = ls + """,
rp AS (SELECT doc_id, score, CASE WHEN doc_id % 3 = 0 THEN detected || '-Latn' ELSE detected END AS reported FROM dl)
SELECT doc_id, reported, score,
       CASE WHEN score >= 0.5 AND length(reported) = 2 THEN lower(reported)
            WHEN score >= 0.5 AND contains(reported, '-') AND length(split_part(reported, '-', 1)) = 2
            THEN lower(split_part(reported, '-', 1)) END AS accepted
FROM rp"""
    out["needs_translation"] = ls + "\nSELECT doc_id, lang_code, lang_code NOT IN ('en', 'xx') AS needs_translation FROM dl"
    out["non_empty_guard"] = ot + """
SELECT doc_id, t IS NULL OR regexp_replace(t, '\\s+', '', 'g') = '' AS is_blank
FROM (SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN regexp_replace(text, '\\S', '', 'g') ELSE text END AS t FROM ocr_text)"""
    out["extract_numbers"] = ot + f"""
SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '{NUM_RE}')) AS INTEGER) AS n_numbers,
       array_to_string(regexp_extract_all(coalesce(text, ''), '{NUM_RE}'), '|') AS numbers FROM ocr_text"""
    out["normalize_numbers"] = ot + f"""
SELECT doc_id, CAST(len({_num_sql('text')}) AS INTEGER) AS n_distinct,
       array_to_string(list_sort({_num_sql('text')}), '|') AS numbers FROM ocr_text"""
    op = with_fixtures(["ocr_pairs"], "") + f""",
nums AS (SELECT doc_id, name, {_num_sql('original_text')} AS a, {_num_sql('ocr_text')} AS b FROM ocr_pairs),
chk AS (SELECT doc_id, name, CAST(len(a) AS INTEGER) AS n_original,
               CAST(len(list_filter(a, lambda x: NOT list_contains(b, x))) AS INTEGER) AS n_missing,
               CASE WHEN len(a) > 0 THEN len(list_filter(a, lambda x: NOT list_contains(b, x))) / len(a) END AS missing_ratio
        FROM nums),
flag AS (SELECT *, coalesce(missing_ratio >= 0.2, false) AS amounts_missing FROM chk)"""
    out["missing_amount_ratio"] = op + "\nSELECT doc_id, n_original, n_missing, missing_ratio, amounts_missing FROM flag"
    out["missing_amounts"] = op + "\nSELECT doc_id, unnest(list_filter(a, lambda x: NOT list_contains(b, x))) AS number FROM nums"
    paths = op + """,
pth AS (SELECT doc_id, name, amounts_missing, CASE WHEN amounts_missing THEN 'enhanced' ELSE 'normal' END AS path,
               translate(regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\\.[^.]+$', '')
                         || CASE WHEN amounts_missing THEN '_enhanced_ocr.pdf' ELSE '_ocr.pdf' END, ' -', '__') AS output_name
        FROM flag)"""
    out["amount_integrity_check"] = paths + "\nSELECT * FROM pth"
    out["union_paths"] = paths + "\nSELECT path, count(*) AS n_docs FROM pth GROUP BY path"
    return out




# ---------------------------------------------------------------------------------------------
# extraction / classification / notifications
# ---------------------------------------------------------------------------------------------
def _rx(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _inv_no(t: str) -> str:
    pats = [label_regex(l) for l in vocab.INVOICE_NUMBER_LABELS]
    pats.append(r"(?i)\binvoice\s*no\s*[:#]\s*([A-Za-z0-9/\-]*[0-9][A-Za-z0-9/\-]*)")
    found = "coalesce(" + ", ".join(f"nullif(regexp_extract({t}, {_rx(p)}, 1), '')" for p in pats) + ")"
    return (f"CASE WHEN {found} IS NULL OR regexp_matches({found}, {_rx(vocab.PO_NUMBER_PATTERN)}) "
            f"THEN '' ELSE {found} END")


def _norm_date(v: str) -> str:
    return (f"coalesce(strftime(coalesce(try_strptime({v}, '%d-%m-%Y'), try_strptime({v}, '%d/%m/%Y'), "
            f"try_strptime({v}, '%Y-%m-%d'), try_strptime({v}, '%d-%b-%Y')), '%Y%m%d'), '')")


def _inv_date(t: str) -> str:
    return _norm_date(f"regexp_extract({t}, {_rx(DATE_VALUE)}, 1)")


COUNT_UNITS = ("item items pc pcs piece pieces unit units line lines page pages hour hours day days box boxes pallet pallets "
               "package packages document documents file files kg km m ea").split()
CURRENCY_WORDS = "try tl usd eur gbp jpy euro euros dollar dollars lira pound pounds yen".split()


def _amount(t: str, labels) -> str:
    """Label by label: of the values on the label's line that neither ``%`` nor a count unit follows, the first
    with a currency or decimals, else the first."""
    found = []
    for label in labels:
        pat = (r"\b(?i:" + label.replace(" ", r"[ \t]+") + r")[ \t]*(?:[0-9]+(?:[.,][0-9]+)?[ \t]*%)?[ \t]*[:.]?[ \t]*"
               r"([$€£¥₺]|[A-Z]{3}\b)?[ \t]*(-?[0-9](?:[0-9.,]*[0-9])?)[ \t]*(%|[$€£¥₺]|\p{L}+)?")
        b, v, w = (f"regexp_extract_all({t}, {_rx(pat)}, {g})" for g in (1, 2, 3))
        no = ", ".join(_q(x) for x in ["%", *COUNT_UNITS])
        yes = ", ".join(_q(x) for x in [*CURRENCY_WORDS, *(c for c, _ in CURRENCY_SYMBOLS)])
        ok = f"lower(coalesce({w}[i], '')) NOT IN ({no})"
        marked = f"(coalesce({b}[i], '') <> '' OR lower(coalesce({w}[i], '')) IN ({yes}) OR regexp_matches({v}[i], '[.,][0-9]{{1,2}}$'))"

        def first(cond: str) -> str:
            return (f"list_extract(list_filter(list_transform(range(1, len({v}) + 1), lambda i: CASE WHEN {cond} THEN {v}[i] END), "
                    "lambda x: x IS NOT NULL), 1)")

        found += [first(f"{ok} AND {marked}"), first(ok)]
    raw = "coalesce(" + ", ".join(found) + ")"
    return (f"TRY_CAST(CASE WHEN regexp_full_match({raw}, '-?[0-9.]*,[0-9]{{1,2}}') THEN replace(replace({raw}, '.', ''), ',', '.') "
            f"WHEN regexp_full_match({raw}, '-?[0-9]{{1,3}}([.][0-9]{{3}}){{2,}}') THEN replace({raw}, '.', '') "
            f"ELSE replace({raw}, ',', '') END AS DECIMAL(18,2))")


def _currency(t: str) -> str:
    code = f"regexp_extract({t}, {_rx(r'(?i)\bcurrency\s*[:.]?\s*([A-Za-z]{3})\b')}, 1)"
    sym = "CASE " + " ".join(f"WHEN contains({t}, {_q(s)}) THEN {_q(c)}" for s, c in CURRENCY_SYMBOLS) + " ELSE '' END"
    return f"CASE WHEN {code} <> '' THEN upper({code}) ELSE {sym} END"


def _kw_rx(words) -> str:
    return r"(?i)\b(?:" + "|".join(w.replace(" ", r"\s+") for w in words) + r")\b"


def _title(t: str) -> str:
    """The first five lines that aren't blank."""
    return f"regexp_extract({t}, {_rx(r'^(?:' + chr(92) + r's*[^' + chr(92) + r'n]+(?:' + chr(92) + r'n|$)){0,5}')})"


def _title_kind(t: str) -> str:
    head = _title(t)
    kinds = " ".join(
        f"WHEN regexp_matches({head}, {_rx(r'(?im)^[ \t]*(?:\p{L}+[ \t]+)?' + k.replace(' ', r'[ \t]+') + r's?[ \t]*$')}) THEN {_q(k)}"
        for k in vocab.NON_INVOICE_KINDS)
    return f"CASE WHEN regexp_matches({head}, {_rx(r'(?i)^\s*[^\n]*\binvoice\b')}) THEN NULL {kinds} END"


def _inv_type(t: str, cur: str) -> str:
    head = _title(t)
    return (f"CASE WHEN regexp_matches({t}, {_rx(_kw_rx(vocab.RETURN_KEYWORDS))}) THEN 'RETURN' "
            f"WHEN regexp_matches({head}, {_rx('(?i)' + vocab.FREELANCE_KEYWORD.replace(' ', chr(92) + 's+'))}) THEN 'FREELANCE_INVOICE' "
            f"WHEN regexp_matches({head}, {_rx(r'(?i)\b' + vocab.RECEIPT_KEYWORD + r'\b')}) THEN 'RECEIPT' "
            f"WHEN contains({head}, {_q(vocab.NOTARY_KEYWORD)}) THEN 'NOTARY_E_RECEIPT' "
            f"WHEN {cur} <> '' AND {cur} <> 'TRY' THEN 'FOREIGN_CURRENCY' "
            f"WHEN regexp_matches({t}, {_rx(r'(?i)\bimport')}) THEN 'IMPORT' ELSE 'STANDARD' END")


def _percent(t: str, label: str) -> str:
    p = r"(?i)\b" + label + r"\s*(?:rate|amount)?\s*[:(]?\s*([0-9]{1,3}(?:[.,][0-9]{1,2})?)\s*%"
    return f"TRY_CAST(replace(regexp_extract({t}, {_rx(p)}, 1), ',', '.') AS DECIMAL(9,2))"


NEW_TEXT = ("taxIdentification", "receiverVATID", "Bank_Key", "buyerName")
NEW_NUMBERS = ("vatTaxAmount", "totalNetAmount", "taxPercentage", "vatPercentage", "withholdingPercentage")


def _details_cte(src: str = "invoice_text") -> str:
    po = f"regexp_extract(text, {_rx('(' + vocab.PO_NUMBER_IN_TEXT + ')')}, 1)"
    return f""",
det0 AS (
  SELECT doc_id, text, {po} AS purchaseOrderNumber, {_currency('text')} AS currency,
         regexp_extract(text, {_rx(r'(?i)\b(?:vendor\s*(?:no\.?|number|id)|supplier\s*id)\s*[:#]?\s*([A-Za-z0-9\-]+)')}, 1) AS vendorNumber,
         {_amount('text', ('grand total', 'total amount', 'amount due', 'total'))} AS totalInvoiceAmount,
         {_amount('text', ('tax amount', 'tax'))} AS taxAmount,
         regexp_extract(text, {_rx(r'(?i)\b(?:account\s*(?:no\.?|number)?)\s*[:#]?\s*([0-9]{9,18})\b')}, 1) AS Bank_Account_Number,
         regexp_extract(text, {_rx(r'(?i)\b(?:swift|bic)\s*[:#]?\s*([A-Za-z0-9]{11}|[A-Za-z0-9]{8})\b')}, 1) AS Global_Bank_Identifier,
         {_amount('text', ('vat amount', 'vat total', 'vat'))} AS vatTaxAmount,
         {_amount('text', ('net amount', 'net total', 'subtotal'))} AS totalNetAmount,
         regexp_extract(text, {_rx(r'(?i)\btax\s*(?:id|no\.?|number)\s*[:#]?\s*([0-9]{10,11})\b')}, 1) AS taxIdentification,
         regexp_extract(text, {_rx(r'(?i)\b(?:buyer|customer|receiver)\s*vat\s*(?:id|no\.?)?\s*[:#]?\s*([A-Za-z0-9]{8,14})\b')}, 1) AS receiverVATID,
         {_percent('text', 'tax')} AS taxPercentage, {_percent('text', 'vat')} AS vatPercentage,
         {_percent('text', 'withholding')} AS withholdingPercentage,
         regexp_extract(text, {_rx(r'(?i)\bbank\s*(?:key|code)\s*[:#]?\s*([A-Za-z0-9]{3,15})\b')}, 1) AS Bank_Key,
         trim(regexp_extract(text, {_rx(r'(?im)^\s*(?:buyer|bill to|customer)\s*:\s*(\S[^\n]*)$')}, 1)) AS buyerName
  FROM {src}),
det1 AS (SELECT *, {_inv_type('text', 'currency')} AS invoiceType FROM det0),
det AS (SELECT *, CASE WHEN regexp_matches(text, '(?i)invoice') AND purchaseOrderNumber <> '' AND invoiceType <> 'RETURN' THEN 'POI'
                       WHEN regexp_matches(text, '(?i)invoice') AND purchaseOrderNumber = '' AND invoiceType <> 'RETURN' THEN 'NPI'
                       ELSE 'N/A' END AS doctype FROM det1)"""


ITEM_KEYWORDS = """
CONSTRUCTION_ENGINEERING construction engineering architecture excavation concrete
CONSTRUCTION_CONSULTING feasibility surveying planning
CONSTRUCTION_INSPECTION inspection supervision
CLEANING_FACILITY cleaning janitorial hygiene facility gardening
PERSONNEL_LABOR labor labour workforce staffing
PERSONNEL_GENERAL payroll recruitment personnel
PERSONNEL_TRANSPORT shuttle commuter passenger
TRANSPORT_FREIGHT freight shipping cargo haulage transport delivery
PROFESSIONAL_CATERING catering meal meals canteen
PROFESSIONAL_INTERMEDIARY brokerage commission intermediary agency
ADVERTISING advertising advertisement campaign marketing media
MAINTENANCE_TECHNICAL maintenance repair calibration servicing spare
PRINTING_PUBLISHING printing brochures publishing booklet print
MANUFACTURING_TEXTILE textile fabric sewing uniform uniforms
HEALTHCARE_PPP hospital clinical medical healthcare
METALS_STANDARD copper aluminium zinc lead brass
METALS_SCRAP scrap
METALS_RECYCLED recycled ingots
AGRI_RAW wheat cotton wool hides
AGRI_FORESTRY timber wood lumber pallets
INDUSTRIAL_IRON_STEEL steel iron rebar rods
INDUSTRIAL_OTHER_DELIVERIES machinery equipment pump valve filter"""
ITEM_COLUMNS = ("lineNumber", "description", "category", "quantity", "unitOfMeasure", "unitPrice", "netAmount", "taxAmount",
                "taxPercentage", "vatAmount", "vatPercentage", "withholdingPercentage")


def _items_cte(src: str) -> str:
    """Line items of ``src (doc_id, text)``: lines are classified, a recursion line by line builds records (a header opens a
    table, a total closes it, a rising number opens a record, lines go to an incomplete record, up to four lines), records are
    read from their end, in the decimal style in which quantity times price gives the amount."""
    num, money, unit = r"-?[0-9](?:[0-9.,]*[0-9])?", r"-?[0-9][0-9.,]*[.,][0-9]{2}", r"(?: ?(\p{L}{1,4}))?"
    rate, line, rest = r"(?: ([0-9]{1,2}(?:[.,][0-9]{1,2})?) ?%)?", r"^([0-9]{1,3})[.)]? (.+?)", r"((?: [^0-9]+)?)$"
    full, short, lump = (_rx(x) for x in (f"{line} ({num}){unit} ({num}){rate} ({num}){rest}", f"{line} ({num}){unit}{rate} ({money}){rest}",
                                          f"{line}{rate} ({money}){rest}"))
    word = r"(?:(?:no|nr|line|pos|item|description|goods|service|product|qty|quantity|unit|of|measure|price|rate|vat|kdv|tax|net|total|amount)s?[.:%#]*|[%#|])"
    only = _rx(rf"(?i)^\s*(?:{word}\s+)*{word}\s*$")
    total = _rx(r"(?i)^\s*(?:sub\s?total|grand total|total|net total|net amount|vat amount|tax amount|amount due|balance due|vat|tax)\b")

    def done(t: str, flags: str) -> str:
        return (f"CASE WHEN contains({flags}, 'q') THEN contains({flags}, 'p') AND regexp_matches({t}, {full}) OR regexp_matches({t}, {short}) "
                f"ELSE regexp_matches({t}, {lump}) END")

    def g(a: int, b: int, c: int) -> str:
        one = lambda shape, n: f"regexp_extract(rec, {shape}, {n})" if n else "''"
        return f"CASE WHEN NOT hq THEN {one(lump, c)} WHEN f THEN {one(full, a)} WHEN s THEN {one(short, b)} ELSE '' END"

    def number(x: str, comma: bool) -> str:
        style = r"^-?(?:[0-9]{1,3}(?:\.[0-9]{3})+|[0-9]+)(?:,[0-9]+)?$" if comma else r"^-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?$"
        plain = f"replace(replace({x}, '.', ''), ',', '.')" if comma else f"replace({x}, ',', '')"
        return f"CASE WHEN regexp_matches({x}, {_rx(style)}) THEN TRY_CAST({plain} AS DECIMAL(18,4)) END"

    def reading(c: str) -> str:
        return (f"q{c} IS NOT NULL AND (price = '' OR p{c} IS NOT NULL) AND (amount = '' OR a{c} IS NOT NULL) AS fits{c}, "
                f"abs(q{c} * p{c} - a{c}) <= greatest(0.02, abs(a{c}) * 0.001) AS agrees{c}")

    words = ", ".join(f"({i}, '{row.split()[0]}', '{w}')" for i, row in enumerate(ITEM_KEYWORDS.strip().split("\n")) for w in row.split()[1:])
    pick = "CASE WHEN fits1 AND coalesce(agrees1, false) THEN 1 WHEN fits2 AND coalesce(agrees2, false) THEN 2 WHEN fits1 THEN 1 ELSE 2 END"
    return f""",
ir AS (SELECT doc_id, {_percent('text', 'tax')} AS r_tax, {_percent('text', 'vat')} AS r_vat, {_percent('text', 'withholding')} AS r_wh FROM {src}),
il0 AS (SELECT doc_id, unnest(ls) AS raw, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {src})),
il1 AS (SELECT *, trim(regexp_replace(regexp_replace(raw, {_rx(r'[$€£¥₺]|' + chr(92) + r'b(?:TRY|TL|USD|EUR|GBP|JPY)' + chr(92) + 'b')}, ' ', 'g'), '\\s+', ' ', 'g')) AS t,
  regexp_matches(raw, '[0-9]') AS digits, regexp_matches(raw, '(?i)\\b(?:description|item|goods|service|product)s?\\b') AS hd,
  regexp_matches(raw, '(?i)\\b(?:qty|quantity)\\b') AS hq, regexp_matches(raw, '(?i)\\b(?:price|rate)\\b') AS hp,
  regexp_matches(raw, '(?i)\\b(?:amount|net|total)\\b') AS ha FROM il0),
il2 AS MATERIALIZED (SELECT doc_id, i, t, CASE WHEN NOT digits AND (hd::INT + hq::INT + hp::INT + ha::INT >= 3
      OR hd::INT + hq::INT + hp::INT + ha::INT >= 2 AND regexp_matches(raw, {only})) THEN 'header'
    WHEN regexp_matches(raw, {total}) THEN 'total' WHEN regexp_matches(t, '^[0-9]{{1,3}}[.)]? \\S*\\p{{L}}') THEN 'item' ELSE 'other' END AS kind,
  CASE WHEN hq THEN 'q' ELSE '' END || CASE WHEN hp THEN 'p' ELSE '' END || CASE WHEN ha THEN 'a' ELSE '' END || CASE WHEN regexp_matches(raw, '(?i)\\b(?:vat|kdv)\\b') THEN 'v'
    WHEN regexp_matches(raw, '(?i)\\btax\\b') THEN 't' ELSE '' END AS cols,
  coalesce(TRY_CAST(regexp_extract(t, '^([0-9]{{1,3}})', 1) AS INTEGER), 0) AS num, regexp_matches(raw, '^\\s+\\S') AND NOT digits AS trails FROM il1),
st(doc_id, i, open, fresh, last, flags, complete, span, n, rec, rflags) AS (
  SELECT doc_id, 0::BIGINT, false, false, 0, '', true, 0, 0, '', '' FROM (SELECT DISTINCT doc_id FROM il2 WHERE kind = 'header')
  UNION ALL
  SELECT doc_id, i, CASE act WHEN 'H' THEN true WHEN 'T' THEN false ELSE open END, CASE act WHEN 'H' THEN true WHEN 'N' THEN fresh ELSE false END,
    CASE act WHEN 'T' THEN 0 WHEN 'B' THEN num ELSE last END, CASE act WHEN 'H' THEN cols ELSE flags END,
    CASE act WHEN 'H' THEN true WHEN 'T' THEN true WHEN 'B' THEN {done('t', 'flags')} WHEN 'G' THEN complete OR {done("(rec || ' ' || t)", 'flags')} ELSE complete END,
    CASE act WHEN 'H' THEN 0 WHEN 'T' THEN 0 WHEN 'B' THEN 1 WHEN 'G' THEN span + 1 ELSE span END, CASE act WHEN 'B' THEN n + 1 ELSE n END,
    CASE act WHEN 'B' THEN t WHEN 'G' THEN rec || ' ' || t ELSE rec END, CASE act WHEN 'B' THEN flags ELSE rflags END
  FROM (SELECT st.* EXCLUDE (i), l.i, l.t, l.num, l.cols,
          CASE WHEN kind = 'header' THEN 'H' WHEN NOT open THEN 'N' WHEN kind = 'total' THEN 'T'
            WHEN kind = 'item' AND (num > last AND num <= last + 10 OR fresh AND num = 1) THEN 'B'
            WHEN n > 0 AND NOT fresh AND t <> '' AND span < 4 AND (NOT complete OR trails) THEN 'G' ELSE 'N' END AS act
        FROM st JOIN il2 l ON l.doc_id = st.doc_id AND l.i = st.i + 1)),
ic0 AS (SELECT doc_id, n, arg_max(rec, i) AS rec, arg_max(rflags, i) AS flags FROM st WHERE n > 0 GROUP BY doc_id, n),
ic1 AS (SELECT *, contains(flags, 'q') AS hq, contains(flags, 'a') AS ha, contains(flags, 'p') AND regexp_matches(rec, {full}) AS f, regexp_matches(rec, {short}) AS s FROM ic0),
ic2 AS (SELECT *, {g(1, 1, 1)} AS line, trim(({g(2, 2, 2)}) || ({g(8, 7, 5)})) AS description, CASE WHEN NOT hq THEN '1' ELSE {g(3, 3, 0)} END AS quantity,
  upper({g(4, 4, 0)}) AS unit, CASE WHEN hq AND NOT f AND NOT ha THEN {g(7, 6, 4)} ELSE {g(5, 0, 0)} END AS price, {g(6, 5, 3)} AS rate,
  CASE WHEN hq AND NOT f AND NOT ha THEN '' ELSE {g(7, 6, 4)} END AS amount FROM ic1),
ic3 AS (SELECT *, {number('quantity', False)} AS q1, {number('price', False)} AS p1, {number('amount', False)} AS a1, {number('quantity', True)} AS q2,
  {number('price', True)} AS p2, {number('amount', True)} AS a2 FROM ic2 WHERE line <> ''),
ic4 AS (SELECT *, {reading('1')}, {reading('2')} FROM ic3),
ic5 AS (SELECT *, {pick} AS w FROM ic4),
ic6 AS (SELECT *, CASE w WHEN 1 THEN q1 ELSE q2 END AS q, CASE w WHEN 1 THEN p1 ELSE p2 END AS p, CASE w WHEN 1 THEN a1 ELSE a2 END AS a,
  CASE w WHEN 1 THEN agrees1 ELSE agrees2 END AS agrees FROM ic5),
kw(k, category, word) AS (VALUES {words}),
cats AS (SELECT doc_id, n, arg_max(category, c * 100 - k) AS category FROM (
  SELECT doc_id, n, kw.category, kw.k, count(*) AS c FROM (SELECT doc_id, n, unnest(regexp_split_to_array(lower(description), '[^a-z]+')) AS word FROM ic6)
  JOIN kw USING (word) GROUP BY ALL) GROUP BY doc_id, n),
ic7 AS (SELECT ic6.*, coalesce(category, 'OTHER_SERVICES') AS category, CAST(coalesce(a, q * p) AS DECIMAL(18,2)) AS net,
  coalesce(CASE WHEN contains(flags, 'v') THEN TRY_CAST(replace(rate, ',', '.') AS DECIMAL(9,2)) END, r_vat, 0) AS vat,
  coalesce(CASE WHEN contains(flags, 't') THEN TRY_CAST(replace(rate, ',', '.') AS DECIMAL(9,2)) END, r_tax) AS tax, coalesce(r_wh, 0) AS wh
  FROM ic6 LEFT JOIN cats USING (doc_id, n) JOIN ir USING (doc_id) WHERE q IS NOT NULL AND (p IS NOT NULL OR a IS NOT NULL)),
items AS (SELECT doc_id, n, line AS lineNumber, description, category, CAST(q AS DECIMAL(18,3)) AS quantity, unit AS unitOfMeasure,
  coalesce(p, CASE WHEN q <> 0 THEN CAST(round(CAST(a AS DOUBLE) / CAST(q AS DOUBLE), 4) AS DECIMAL(18,4)) END) AS unitPrice, net AS netAmount,
  CAST(net * tax * 0.01 AS DECIMAL(18,2)) AS taxAmount, CAST(tax AS DECIMAL(9,2)) AS taxPercentage, CAST(net * vat * 0.01 AS DECIMAL(18,2)) AS vatAmount,
  CAST(vat AS DECIMAL(9,2)) AS vatPercentage, CAST(wh AS DECIMAL(9,2)) AS withholdingPercentage, agrees FROM ic7)"""


FIXTURES["extraction_json"] = """
extraction_json AS (
  SELECT o.o_orderkey AS doc_id,
         CASE WHEN o.o_orderkey % 19 = 0 THEN 'XXX' WHEN o.o_orderkey % 2 = 0 THEN 'POI' ELSE 'NPI' END AS doctype,
         CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE CASE o.o_orderkey % 4 WHEN 0 THEN 'TRY' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'JPY' END END AS currency,
         o.o_totalprice AS total, o.o_orderkey % 23 = 0 AS total_is_string,
         coalesce(li.n_items, 0) AS n_items
  FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n_items FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) li
       ON o.o_orderkey = li.l_orderkey)"""

CATEGORY_CASE = None


def extract_sql() -> dict[str, str]:
    out = {}
    it = with_fixtures(["invoice_text"], "")
    out["extract_baseline"] = it + f"\nSELECT doc_id, {_inv_no('text')} AS invoiceNumber, {_inv_date('text')} AS invoiceDate FROM invoice_text"
    out["normalize_invoice_date"] = it + f"""
SELECT doc_id, raw_date, {_norm_date('raw_date')} AS invoiceDate
FROM (SELECT doc_id, regexp_extract(text, {_rx(DATE_VALUE)}, 1) AS raw_date FROM invoice_text)"""
    po_ok = f"coalesce(regexp_matches(po, {_rx(vocab.PO_NUMBER_PATTERN)}), false)"
    out["valid_po_number"] = it + f"""
SELECT doc_id, po, {po_ok} AS po_valid, alt_po, coalesce(regexp_matches(alt_po, {_rx(vocab.PO_NUMBER_PATTERN)}), false) AS alt_valid
FROM (SELECT doc_id, regexp_extract(text, 'PO:\\s*([0-9]+)', 1) AS po, '66' || lpad(CAST(doc_id % 1000 AS VARCHAR), 7, '0') AS alt_po FROM invoice_text)"""
    out["bank_swift_checks"] = f"""
SELECT c_custkey, account, coalesce(regexp_matches(account, {_rx(vocab.BANK_ACCOUNT_PATTERN)}), false) AS account_valid,
       bic, coalesce(regexp_matches(bic, {_rx(vocab.SWIFT_BIC_PATTERN)}), false) AS bic_valid
FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) || '0000000' AS account,
             substr(upper(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')), 1,
                    CASE WHEN c_custkey % 5 = 0 THEN 10 WHEN c_custkey % 2 = 0 THEN 11 ELSE 8 END) AS bic
      FROM customer)"""
    d = it + _details_cte()
    out["extract_details_doctype"] = d + "\nSELECT doc_id, purchaseOrderNumber, doctype FROM det"
    out["extract_details_invoice_type"] = d + "\nSELECT doc_id, currency, invoiceType FROM det"
    out["extract_details_amounts_ids"] = d + ("\nSELECT doc_id, vendorNumber, totalInvoiceAmount, taxAmount, currency, "
                                              "Bank_Account_Number, Global_Bank_Identifier, " + ", ".join(NEW_TEXT + NEW_NUMBERS) + " FROM det")
    out["extract_line_items"] = with_fixtures(["itemised_invoice_text"], "").replace("WITH ", "WITH RECURSIVE ", 1) + _items_cte(
        "itemised_invoice_text") + f"\nSELECT doc_id, {', '.join(ITEM_COLUMNS)}, agrees FROM items"
    cat = "CASE " + " ".join(f"WHEN p_type = {_q(a)} THEN {_q(b)}" for a, b in CATEGORY_BY_PTYPE) + " ELSE 'OTHER_SERVICES' END"
    out["flatten_line_items"] = f"""
WITH li AS (
  SELECT l_orderkey AS doc_id, CAST(l_linenumber AS VARCHAR) AS lineNumber, {cat} AS category, 'EA' AS unitOfMeasure,
         l_quantity AS quantity, p_retailprice AS unitPrice, l_extendedprice * (1.0 - l_discount) AS net, l_tax
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT o.o_orderkey AS doc_id, li.lineNumber, li.category, li.unitOfMeasure,
       CAST(CAST(floor((li.quantity) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(18,2)) AS quantity, CAST(CAST(floor((li.unitPrice) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(18,2)) AS unitPrice,
       CAST(CAST(floor((li.net) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(18,2)) AS netAmount, CAST(CAST(floor((li.net * li.l_tax) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(18,2)) AS taxAmount,
       CAST(CAST(floor((li.net * li.l_tax) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(18,2)) AS vatAmount,
       CAST(CAST(floor((li.l_tax * 100) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(9,2)) AS taxPercentage, CAST(CAST(floor((li.l_tax * 100) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(9,2)) AS vatPercentage,
       CASE WHEN li.doc_id IS NULL THEN NULL ELSE CAST(0 AS DECIMAL(9,2)) END AS withholdingPercentage
FROM orders o LEFT JOIN li ON o.o_orderkey = li.doc_id"""
    ej = with_fixtures(["extraction_json"], "")
    out["validate_extraction"] = ej + """,
v AS (SELECT doc_id, list_filter([
        CASE WHEN currency IS NULL THEN 'missing:currency' END,
        CASE WHEN total_is_string THEN 'not_number:totalInvoiceAmount' END,
        CASE WHEN doctype NOT IN ('POI', 'NPI', 'N/A') THEN 'enum:doctype' END], lambda x: x IS NOT NULL) AS vs
      FROM extraction_json)
SELECT doc_id, CAST(len(vs) AS INTEGER) AS n_violations, array_to_string(list_sort(vs), ',') AS violations FROM v"""
    out["validate_baseline"] = it + """,
v AS (SELECT doc_id, CASE WHEN doc_id % 17 = 0 OR doc_id % 19 = 0 THEN ['not_object:$'] ELSE list_filter([
        CASE WHEN doc_id % 6 = 0 THEN 'missing:invoiceDate' END, CASE WHEN doc_id % 10 = 3 THEN 'not_string:invoiceNumber' END], lambda x: x IS NOT NULL) END AS vs
      FROM invoice_text)
SELECT doc_id, CAST(len(vs) AS INTEGER) AS n_violations, array_to_string(vs, ',') AS violations FROM v"""
    out["json_roundtrip"] = ej + """
SELECT doc_id, doctype, currency,
       CASE WHEN total_is_string THEN NULL ELSE CAST(CAST(floor((total) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(18,2)) END AS totalInvoiceAmount,
       CAST(n_items AS INTEGER) AS n_items FROM extraction_json"""
    out["merge_extractions"] = with_fixtures(["invoice_text", "extraction_json"], "") + f"""
SELECT coalesce(b.doc_id, e.doc_id) AS doc_id, b.invoiceNumber, b.invoiceDate, coalesce(e.currency, b.currency) AS currency,
       e.doctype
FROM (SELECT doc_id, {_inv_no('text')} AS invoiceNumber, {_inv_date('text')} AS invoiceDate, {_currency('text')} AS currency
      FROM invoice_text) b
FULL OUTER JOIN extraction_json e ON b.doc_id = e.doc_id"""
    norm = "trim(regexp_replace(upper({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    out["buyer_match"] = f"""
WITH inv AS (SELECT o.o_orderkey AS doc_id, lower(replace(c.c_name, '#', ' # ')) AS buyer_text
             FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
b AS (SELECT {norm.format(x='c_name')} AS k, min(c_name) AS buyerName FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1)
SELECT doc_id, coalesce(b.buyerName, '') AS buyerName FROM inv LEFT JOIN b ON {norm.format(x='inv.buyer_text')} = b.k"""
    return out


def _classify_cte(src: str) -> str:
    kind = "CASE " + " ".join(
        f"WHEN regexp_matches(p, {_rx(r'(?i)\b' + k.replace(' ', chr(92) + 's+') + r'\b')}) THEN {_q(k)}"
        for k in vocab.NON_INVOICE_KINDS) + " END"
    return f""",
c0 AS (SELECT doc_id, text AS p FROM {src}),
c1 AS (SELECT doc_id, {_inv_no('p')} AS detected_invoice_number, regexp_extract(p, {_rx(VENDOR_LINE)}, 1) AS detected_vendor,
              {_inv_date('p')} <> '' AS has_date, ({_amount('p', AMOUNT_LABELS)}) IS NOT NULL AS has_amount,
              {_title_kind('p')} AS title_kind, coalesce({_title_kind('p')}, {kind}) AS doc_kind,
              regexp_matches(p, '(?i)\\binvoice\\b') AS mentions_invoice FROM c0),
c2 AS (SELECT *, detected_invoice_number <> '' AND has_date AND detected_vendor <> '' AND has_amount AND title_kind IS NULL AS is_invoice,
              list_filter([CASE WHEN detected_invoice_number = '' THEN 'invoice number' END,
                           CASE WHEN NOT has_date THEN 'invoice date' END,
                           CASE WHEN detected_vendor = '' THEN 'vendor' END,
                           CASE WHEN NOT has_amount THEN 'amount payable' END], lambda x: x IS NOT NULL) AS missing FROM c1),
cls AS (SELECT doc_id, is_invoice,
               CASE WHEN is_invoice AND mentions_invoice THEN 'high' WHEN is_invoice THEN 'medium'
                    WHEN doc_kind IS NOT NULL THEN 'high' ELSE 'low' END AS confidence,
               CASE WHEN is_invoice THEN 'Invoice number, date, vendor and amount found.'
                    WHEN doc_kind IS NOT NULL THEN 'Document is a ' || doc_kind || ', not an invoice.' ||
                         CASE WHEN len(missing) > 0 THEN ' Missing: ' || array_to_string(missing, ', ') || '.' ELSE '' END
                    ELSE 'Not an invoice.' ||
                         CASE WHEN len(missing) > 0 THEN ' Missing: ' || array_to_string(missing, ', ') || '.' ELSE '' END
               END AS reason, doc_kind, detected_vendor, detected_invoice_number FROM c2)"""


def classify_sql() -> dict[str, str]:
    out = {}
    out["classify_invoice"] = with_fixtures(["invoice_text"], "") + _classify_cte("invoice_text") + """
SELECT doc_id, is_invoice, confidence, reason, doc_kind, detected_vendor, detected_invoice_number FROM cls"""
    out["classify_documents"] = with_fixtures(["ocr_text", "invoice_text"], "") + """,
mixed AS (SELECT o.doc_id, CASE WHEN o.doc_id % 2 = 0 THEN coalesce(i.text, o.text) ELSE o.text END AS text
          FROM ocr_text o LEFT JOIN invoice_text i USING (doc_id))""" + _classify_cte("mixed") + """
SELECT doc_id, is_invoice, confidence, reason FROM cls"""
    out["classification_defaults"] = with_fixtures(["invoice_text"], "") + _classify_cte("invoice_text") + f"""
SELECT doc_id,
       CASE WHEN doc_id % 11 = 0 THEN false WHEN doc_id % 5 = 0 AND doc_id % 7 <> 0 THEN false ELSE is_invoice END AS is_invoice,
       CASE WHEN doc_id % 11 = 0 THEN 'low' ELSE confidence END AS confidence,
       CASE WHEN doc_id % 11 = 0 THEN {_q(vocab.CLASSIFIER_FAILED_REASON)}
            WHEN doc_id % 7 = 0 THEN {_q(vocab.NO_REASON)} ELSE reason END AS reason
FROM cls"""
    return out


def _esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def notify_sql() -> dict[str, str]:
    base = with_fixtures(["messages", "attachments"], "") + f""",
outcomes AS (SELECT message_id, att_id, name AS filename, reason, is_valid FROM attachments WHERE {USABLE}
             AND message_id IN (SELECT id FROM messages WHERE {WIN_ALL})),
frag AS (SELECT message_id, att_id, is_valid,
                CASE WHEN is_valid THEN '<li>' || {_esc('filename')} || '</li>'
                     ELSE '<tr><td>' || {_esc('filename')} || '</td><td>' || {_esc('reason')} || '</td></tr>' END AS h
         FROM outcomes),
rt AS (SELECT message_id,
              CAST(sum(CASE WHEN is_valid THEN 1 ELSE 0 END) AS BIGINT) AS valid_count,
              CAST(sum(CASE WHEN is_valid THEN 0 ELSE 1 END) AS BIGINT) AS invalid_count,
              coalesce(string_agg(h, '' ORDER BY att_id, h) FILTER (WHERE NOT is_valid), '') AS rejected_rows,
              coalesce(string_agg(h, '' ORDER BY att_id, h) FILTER (WHERE is_valid), '') AS valid_items
       FROM frag GROUP BY message_id)"""
    out = {"rejection_table": base + "\nSELECT * FROM rt"}

    def subj(fmt):
        head, tail = fmt.split("{subject}")
        return f"{_q(head)} || m.subject || {_q(tail)}"

    day = _q('01 August 2001')
    name = _esc("m.sender_name")
    table = ("'<table><thead><tr><th>Attachment</th><th>Reason</th></tr></thead><tbody>' || rt.rejected_rows || "
             "'</tbody></table>'")
    success = (f"'<p>Dear ' || {name} || ',</p><p>All <strong>' || CAST(rt.valid_count AS VARCHAR) || "
               f"'</strong> attachment(s) of your email dated <strong>' || {day} || "
               "'</strong> were received and registered for payment.</p>'")
    partial = (f"'<p>Dear ' || {name} || ',</p><p>We reviewed the attachments of your email dated <strong>' || {day} || "
               "'</strong>.</p><p>✅ Processed (' || CAST(rt.valid_count AS VARCHAR) || '):</p><ul>' || rt.valid_items || "
               "'</ul><p>⚠️ Needs your attention (' || CAST(rt.invalid_count AS VARCHAR) || '):</p>' || " + table)
    failure = (f"'<p>Dear ' || {name} || ',</p><p>None of the attachments of your email dated <strong>' || {day} || "
               "'</strong> could be accepted as an invoice.</p>' || " + table +
               " || '<p>Please resubmit each invoice with its number, date, vendor details and amount due.</p>'")
    kind = ("CASE WHEN rt.valid_count + rt.invalid_count > 0 AND rt.invalid_count = 0 THEN 'success' "
            "WHEN rt.valid_count + rt.invalid_count > 0 AND rt.valid_count = 0 THEN 'full_failure' ELSE 'partial_failure' END")
    out["compose_notifications"] = base + f""",
m AS (SELECT id AS message_id, coalesce(subject, '(no subject)') AS subject,
             coalesce(from_name, split_part(coalesce(from_address, ''), '@', 1)) AS sender_name
      FROM messages WHERE {WIN_ALL}),
k AS (SELECT rt.*, m.subject, m.sender_name, {kind} AS kind FROM rt JOIN m USING (message_id))
SELECT message_id, kind, valid_count, invalid_count,
       CASE kind WHEN 'success' THEN {subj(SUBJECT_SUCCESS).replace('m.subject', 'subject')}
                 WHEN 'full_failure' THEN {subj(SUBJECT_FAILURE).replace('m.subject', 'subject')}
                 ELSE {subj(SUBJECT_PARTIAL).replace('m.subject', 'subject')} END AS subject,
       '<html><body>' || CASE kind WHEN 'success' THEN {success.replace('m.sender_name', 'sender_name').replace('rt.', '')}
                                   WHEN 'full_failure' THEN {failure.replace('m.sender_name', 'sender_name').replace('rt.', '')}
                                   ELSE {partial.replace('m.sender_name', 'sender_name').replace('rt.', '')} END
       || '<p>Accounts Payable Team</p></body></html>' AS body_html
FROM k"""
    out["long_date_format"] = with_fixtures(["messages"], "") + "\nSELECT id, strftime(received_at, '%d %B %Y') AS received_long FROM messages"
    return out




# ---------------------------------------------------------------------------------------------
# streaming batch twins
# ---------------------------------------------------------------------------------------------
def streaming_sql() -> dict[str, str]:
    out = {}
    pl = with_fixtures(["process_log"], "")
    out["stream_lineage_counts"] = pl + """
SELECT time_bucket(INTERVAL 30 MINUTE, logged_at) AS window_start,
       time_bucket(INTERVAL 30 MINUTE, logged_at) + INTERVAL 30 MINUTE AS window_end,
       step_name, CAST(sum(item_count) AS BIGINT) AS total, count(*) AS n_rows
FROM process_log GROUP BY ALL"""
    out["stream_run_sessions"] = pl + """,
g AS (SELECT run_id, logged_at, item_count,
             CASE WHEN lag(logged_at) OVER (PARTITION BY run_id ORDER BY logged_at) IS NULL
                    OR logged_at >= lag(logged_at) OVER (PARTITION BY run_id ORDER BY logged_at) + INTERVAL 30 MINUTE
                  THEN 1 ELSE 0 END AS new_s FROM process_log),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY run_id ORDER BY logged_at ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT run_id, min(logged_at) AS session_start, max(logged_at) + INTERVAL 30 MINUTE AS session_end,
       count(*) AS n_events, CAST(sum(item_count) AS BIGINT) AS items
FROM s GROUP BY run_id, sid"""
    sb = with_fixtures(["source_blobs"], "")
    out["stream_new_documents"] = sb + f"""
SELECT DISTINCT container, name, last_modified FROM (
  SELECT container, name, last_modified FROM source_blobs
  UNION ALL SELECT container, name, last_modified FROM source_blobs WHERE last_modified <= TIMESTAMP '2024-01-10 06:00:00'
  UNION ALL SELECT container, name, last_modified + INTERVAL 1 DAY FROM source_blobs WHERE size % 10 = 0)"""
    out["stream_skip_processed"] = (sb + path_ctes("source_blobs", out="src_paths") + "," + FIXTURES["translated_blobs"]
                                    + """
SELECT name FROM src_paths WHERE _dir || _clean || '_en' || _suf NOT IN (SELECT name FROM translated_blobs)""")
    out["stream_first_of_target"] = (sb + path_ctes("source_blobs", out="src_paths") + "," + FIXTURES["translated_blobs"] + """,
several AS (SELECT name, last_modified FROM source_blobs UNION ALL
  SELECT regexp_replace(name, '_[a-z]{2}([.])', '_xx\\1'), last_modified - INTERVAL 1 HOUR FROM source_blobs WHERE size % 3 = 0)"""
                                     + path_ctes("several", out="sv") + """
SELECT f.name, f.last_modified FROM (SELECT _dir || _clean || '_en' || _suf AS target, min({'last_modified': last_modified, 'name': name}) AS f FROM sv GROUP BY 1)
WHERE target NOT IN (SELECT name FROM translated_blobs)""")
    allsrc = FIXTURES["source_blobs"].strip()
    out["stream_late_reconcile"] = "WITH " + allsrc + f"""
SELECT name, last_modified FROM source_blobs WHERE last_modified > {AS_OF_BLOB}"""
    return out




def injected_sql() -> dict[str, str]:
    return {"injected_document_function": with_fixtures(["ocr_text"], "") + """
SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, CAST(NULL AS VARCHAR) AS error,
       CAST(1 AS INTEGER) AS attempts FROM ocr_text""", "call_policy": with_fixtures(["ocr_text"], "") + """
SELECT doc_id, CASE WHEN doc_id % 10 <> 7 THEN CAST(length(coalesce(text, '')) AS BIGINT) END AS n_chars,
       CASE WHEN doc_id % 10 = 7 THEN 'ValueError: document refused' END AS error FROM ocr_text""",
            "concurrent_calls": with_fixtures(["ocr_text"], "") + """
SELECT doc_id, CASE WHEN doc_id % 10 <> 7 THEN CAST(length(coalesce(text, '')) AS BIGINT) END AS n_chars,
       CASE WHEN doc_id % 10 = 7 THEN 'ValueError: document refused' END AS error,
       CAST(CASE WHEN doc_id % 10 = 7 THEN 2 ELSE 1 END AS INTEGER) AS attempts FROM ocr_text"""}




def pipeline_sql() -> dict[str, str]:
    out = {}
    out["overwrite_by_key"] = with_fixtures(["blob_writes"], """
SELECT container, name, w.written_at, w.att_id FROM (
  SELECT container, name, max({'written_at': written_at, 'tiebreak': tiebreak, 'size': size, 'att_id': att_id,
                               'message_id': message_id}) AS w
  FROM blob_writes GROUP BY container, name)""")
    # translate batch: todo rows whose OCR text is blank fail; the test translator never fails
    base = (with_fixtures(["source_blobs"], "") + path_ctes("source_blobs", out="src_paths") + ","
            + FIXTURES["translated_blobs"] + """,
s AS (SELECT name, _dir || _clean || '_en' || _suf AS target_name FROM src_paths),
r AS (SELECT name, NOT (target_name NOT IN (SELECT name FROM translated_blobs) AND contains(name, '_13')) AS success
      FROM s)""")
    out["failed_results"] = base + "\nSELECT name, 'OCR returned no text' AS error FROM r WHERE NOT success"
    out["batch_summary"] = base + """
SELECT count(*) AS total, count(*) FILTER (WHERE success) AS succeeded, count(*) FILTER (WHERE NOT success) AS failed,
       format('total={:d} succeeded={:d} failed={:d}', count(*), count(*) FILTER (WHERE success),
              count(*) FILTER (WHERE NOT success)) AS summary FROM r"""
    out["translate_exit_status"] = base + "\nSELECT coalesce(max(CASE WHEN NOT success THEN 1 ELSE 0 END), 0) AS exit_code FROM r"
    return out




def _ocr_outcomes_sql(force: bool) -> str:
    tb = _as_of(with_fixtures(["target_blobs"], ""))
    body = tb + _reconcile_body(False) + f""",
prim AS (SELECT doc_id, {L_COLS}, 'lookback' AS path FROM source_blobs
         WHERE last_modified >= {AS_OF_BLOB} - INTERVAL 24 HOUR AND lower(name) LIKE '%.pdf'),
wl AS (SELECT * FROM prim UNION ALL
       SELECT s.doc_id, r.*, 'reconcile' FROM recon r JOIN source_blobs s USING (name) WHERE NOT EXISTS (SELECT 1 FROM prim)),
tx AS (SELECT doc_id, text AS original_text,
              CASE WHEN doc_id % 13 = 0 THEN '  ' WHEN doc_id % 2 = 0 THEN regexp_replace(text, '[.]', ' ', 'g') ELSE text END AS ocr_text
       FROM documents),
j AS (SELECT wl.*, tx.original_text, tx.ocr_text FROM wl LEFT JOIN tx USING (doc_id)),
n AS (SELECT *, {_num_sql('original_text')} AS a, {_num_sql('ocr_text')} AS b FROM j),
c AS (SELECT *, {'CAST(NULL AS BOOLEAN)' if force else "coalesce(CASE WHEN len(a) > 0 THEN len(list_filter(a, lambda x: NOT list_contains(b, x))) / len(a) END >= 0.2, false)"} AS amounts_missing,
             ocr_text IS NULL OR NOT regexp_matches(ocr_text, '\\S') AS failed FROM n),
e AS (SELECT *, {'true' if force else 'amounts_missing'} AS enhanced FROM c)
{path_ctes('e', out='op')}
"""
    return body


def ocr_pipeline_sql() -> dict[str, str]:
    out = {}
    sel = """SELECT doc_id, container, name, path AS worklist, amounts_missing,
       CASE WHEN enhanced THEN 'enhanced' ELSE 'normal' END AS ocr_path,
       CASE WHEN NOT failed THEN translate(_stem || CASE WHEN enhanced THEN '_enhanced_ocr.pdf' ELSE '_ocr.pdf' END, ' -', '__') END AS output_name,
       CASE WHEN failed THEN translate(name, ' -', '__') END AS failed_name,
       CASE WHEN failed THEN 'OCR returned no text' END AS error
FROM op"""
    out["ocr_batch_outcomes"] = _ocr_outcomes_sql(False) + sel
    forced = _ocr_outcomes_sql(True) + ",\noc AS (" + sel + ")"
    out["dead_letter"] = forced + "\nSELECT doc_id, name, failed_name, error FROM oc WHERE error IS NOT NULL"
    out["ocr_batch_containers"] = forced.replace("SELECT doc_id, container, name, path", "SELECT original_text, ocr_text, doc_id, container, name, path") + """
SELECT CASE WHEN error IS NULL THEN 'ocr-invoices' ELSE 'failed-invoices' END AS container, coalesce(output_name, failed_name) AS blob_name, doc_id, error,
       CAST(octet_length(encode(CASE WHEN error IS NULL THEN ocr_text ELSE original_text END)) AS BIGINT) AS n_bytes,
       sha256(CASE WHEN error IS NULL THEN ocr_text ELSE original_text END) AS content_sha256
FROM oc"""
    out["ocr_batch_log"] = forced + """
SELECT 'ocr-20240110-120000-000000' AS run_id, 'OCRPipeline' AS workflow_name,
       CASE WHEN error IS NULL THEN 'ocr_completed' ELSE 'ocr_failed' END AS step_name, name AS step_value,
       1 AS item_count, CASE WHEN error IS NULL THEN 'Completed' ELSE 'Failed' END AS status,
       TIMESTAMP '2024-01-10 12:00:00' AS logged_at,
       CASE WHEN error IS NULL THEN 'Output: ' || output_name ELSE error END AS detail
FROM oc
UNION ALL
SELECT 'ocr-20240110-120000-000000', 'OCRPipeline', 'workflow_completed', NULL, 1, 'Completed',
       TIMESTAMP '2024-01-10 12:00:00', 'Processed ' || CAST(count(*) AS VARCHAR) || ' file(s).' FROM oc"""
    return out




def _email_scan_cte() -> str:
    kind = "CASE " + " ".join(
        f"WHEN regexp_matches(p, {_rx(r'(?i)\b' + k.replace(' ', chr(92) + 's+') + r'\b')}) THEN {_q(k)}"
        for k in vocab.NON_INVOICE_KINDS) + " END"
    tr_expr = ("array_to_string(list_transform(range(0, CAST(ceil(length(ocr_text) / 9000.0) AS BIGINT)), "
               "lambda i: '[EN]' || substr(ocr_text, CAST(i * 9000 + 1 AS BIGINT), 9000)), chr(10))")
    return with_fixtures(["messages", "attachments", "invoice_text"], "") + f""",
win AS (SELECT * FROM messages WHERE {WIN_ALL}),
ua AS (SELECT * EXCLUDE (is_valid, reason) FROM attachments WHERE {USABLE} AND message_id IN (SELECT id FROM win)),
at0 AS (SELECT ua.*, coalesce(CASE WHEN ua.line_no % 2 = 1 THEN it.text ELSE d.text END, '') AS ocr_text
        FROM ua LEFT JOIN invoice_text it ON it.doc_id = ua.message_id LEFT JOIN documents d ON d.doc_id = ua.part_key),
at1 AS (SELECT *, coalesce(name, 'attachment_' || att_id) AS filename, NOT regexp_matches(ocr_text, '\\S') AS is_empty FROM at0){_lang_ctes('at1', 'ocr_text')},
at4 AS (SELECT * REPLACE (CASE WHEN is_empty THEN NULL ELSE lang_code END AS lang_code) FROM dl),
at5 AS (SELECT *, CASE WHEN coalesce(lang_code, 'xx') NOT IN ('en', 'xx') THEN {tr_expr} ELSE ocr_text END AS translated_text
        FROM at4),
at6 AS (SELECT *, translated_text AS p FROM at5),
at7 AS (SELECT *, {_inv_no('p')} AS detected_invoice_number, regexp_extract(p, {_rx(VENDOR_LINE)}, 1) AS detected_vendor,
               {_inv_date('p')} <> '' AS has_date, ({_amount('p', AMOUNT_LABELS)}) IS NOT NULL AS has_amount,
               {_title_kind('p')} AS title_kind, coalesce({_title_kind('p')}, {kind}) AS doc_kind FROM at6),
at8 AS (SELECT *, detected_invoice_number <> '' AND has_date AND detected_vendor <> '' AND has_amount AND title_kind IS NULL AS is_invoice,
               list_filter([CASE WHEN detected_invoice_number = '' THEN 'invoice number' END,
                            CASE WHEN NOT has_date THEN 'invoice date' END,
                            CASE WHEN detected_vendor = '' THEN 'vendor' END,
                            CASE WHEN NOT has_amount THEN 'amount payable' END], lambda x: x IS NOT NULL) AS missing FROM at7),
at9 AS (SELECT *, NOT is_empty AND is_invoice AS is_valid,
               CASE WHEN is_empty THEN {_q(vocab.EMPTY_TEXT_REASON)}
                    WHEN is_invoice THEN 'Invoice number, date, vendor and amount found.'
                    WHEN doc_kind IS NOT NULL THEN 'Document is a ' || doc_kind || ', not an invoice.' ||
                         CASE WHEN len(missing) > 0 THEN ' Missing: ' || array_to_string(missing, ', ') || '.' ELSE '' END
                    ELSE 'Not an invoice.' ||
                         CASE WHEN len(missing) > 0 THEN ' Missing: ' || array_to_string(missing, ', ') || '.' ELSE '' END
               END AS reason FROM at8)
{path_ctes('at9', out='atp')},
outcomes AS MATERIALIZED (
  SELECT message_id, att_id, filename, is_valid,
         CASE WHEN is_empty THEN NULL WHEN is_valid THEN 'raw-invoices' ELSE 'invalid-invoices' END AS container,
         CASE WHEN is_empty THEN NULL WHEN is_valid THEN _dir || _clean || '_' || lang_code || _suf ELSE filename END AS blob_name,
         lang_code, reason, is_empty
  FROM atp)"""


def email_scan_sql() -> dict[str, str]:
    base = _email_scan_cte()
    out = {"email_scan_outcomes": base + "\nSELECT * FROM outcomes"}
    types = _map_case("lower(regexp_extract(filename, '^.+([.][^.]+)$', 1))", vocab.ATTACHMENT_CONTENT_TYPES, vocab.DEFAULT_CONTENT_TYPE)
    out["email_scan_containers"] = base + f"""
SELECT container, blob_name, message_id, att_id, {types} AS content_type, sha256(ocr_text) AS content_sha256
FROM outcomes JOIN at0 USING (message_id, att_id) WHERE container IS NOT NULL"""
    out["email_scan_summary"] = base + f"""
SELECT (SELECT count(*) FROM win) AS messages_scanned, count(DISTINCT message_id) AS messages_with_attachments,
       count(*) AS total_attachments,
       CAST(coalesce(sum(CASE WHEN is_valid THEN 1 ELSE 0 END), 0) AS BIGINT) AS valid_invoices,
       CAST(coalesce(sum(CASE WHEN is_valid THEN 0 ELSE 1 END), 0) AS BIGINT) AS invalid_invoices
FROM outcomes"""
    out["email_scan_notifications"] = base + """,
rt AS (SELECT message_id, CAST(sum(CASE WHEN is_valid THEN 1 ELSE 0 END) AS BIGINT) AS valid_count,
              CAST(sum(CASE WHEN is_valid THEN 0 ELSE 1 END) AS BIGINT) AS invalid_count FROM outcomes GROUP BY message_id),
m AS (SELECT id AS message_id, coalesce(subject, '(no subject)') AS subject FROM messages)
SELECT rt.message_id,
       CASE WHEN valid_count + invalid_count > 0 AND invalid_count = 0 THEN 'success'
            WHEN valid_count + invalid_count > 0 AND valid_count = 0 THEN 'full_failure' ELSE 'partial_failure' END AS kind,
       valid_count, invalid_count,
       CASE WHEN valid_count + invalid_count > 0 AND invalid_count = 0 THEN 'RE: ' || m.subject || ' — Invoice(s) Received Successfully'
            WHEN valid_count + invalid_count > 0 AND valid_count = 0 THEN 'RE: ' || m.subject || ' — Action Required: Invoice(s) Could Not Be Processed'
            ELSE 'RE: ' || m.subject || ' — Action Required: Some Attachments Could Not Be Processed' END AS subject
FROM rt JOIN m USING (message_id)"""
    return out




def batch_results_sql() -> dict[str, str]:
    out = {}
    scan = _email_scan_cte()
    rid = "'email-20010801-000000-000000'"
    ts = "TIMESTAMP '2001-08-01 00:00:00'"
    out["append_process_log"] = scan + f"""
SELECT {rid} AS run_id, 'EmailScanner' AS workflow_name, 'email_received' AS step_name,
       CAST(message_id AS VARCHAR) AS step_value, 1 AS item_count, 'Completed' AS status, {ts} AS logged_at,
       CAST(NULL AS VARCHAR) AS detail
FROM (SELECT DISTINCT message_id FROM outcomes)
UNION ALL
SELECT {rid}, 'EmailScanner', 'attachment_processed', filename, 1, 'Completed', {ts}, NULL FROM outcomes
UNION ALL
SELECT {rid}, 'EmailScanner', CASE WHEN is_valid THEN 'attachment_validation_passed' ELSE 'attachment_validation_failed' END,
       filename, 1, CASE WHEN is_valid THEN 'Completed' ELSE 'Failed' END, {ts}, reason FROM outcomes
UNION ALL
SELECT {rid}, 'EmailScanner', 'workflow_completed', NULL, 1, 'Completed', {ts},
       'messages=' || CAST((SELECT count(*) FROM win) AS VARCHAR) || ' valid=' ||
       CAST(coalesce(sum(CASE WHEN is_valid THEN 1 ELSE 0 END), 0) AS VARCHAR) || ' invalid=' ||
       CAST(coalesce(sum(CASE WHEN is_valid THEN 0 ELSE 1 END), 0) AS VARCHAR)
FROM outcomes"""
    tr_expr = ("array_to_string(list_transform(range(0, CAST(ceil(length(text) / 9000.0) AS BIGINT)), "
               "lambda i: '[EN]' || substr(text, CAST(i * 9000 + 1 AS BIGINT), 9000)), chr(10))")
    base = (with_fixtures(["source_blobs", "ocr_text", "itemised_invoice_text"], "").replace("WITH ", "WITH RECURSIVE ", 1)
            + path_ctes("source_blobs", out="src_paths") + ","
            + FIXTURES["translated_blobs"] + f""",
s AS (SELECT name, _dir || _clean || '_en' || _suf AS target_name, _dir || _clean || '_en.json' AS json_name FROM src_paths),
pay AS (SELECT filename AS name, CASE WHEN contains(filename, '_13') THEN ' ' WHEN ocr_text.doc_id % 2 = 0 THEN
          coalesce(iv.text, ocr_text.text) ELSE ocr_text.text END AS text
        FROM ocr_text LEFT JOIN itemised_invoice_text iv ON iv.doc_id = ocr_text.doc_id),
todo AS (SELECT s.*, pay.text FROM s LEFT JOIN pay USING (name) WHERE target_name NOT IN (SELECT name FROM translated_blobs)),
tt AS (SELECT name AS doc_id, name, target_name, json_name,
              CASE WHEN text IS NULL THEN 'Downloaded blob is empty'
                   WHEN NOT regexp_matches(text, '\\S') THEN 'OCR returned no text' END AS error,
              {tr_expr} AS text FROM todo)""" + _details_cte("tt") + f""",
res AS (
  SELECT tt.name, tt.error IS NULL AS success, CASE WHEN tt.error IS NULL THEN tt.target_name END AS translated_blob,
         CASE WHEN tt.error IS NULL THEN tt.json_name END AS json_blob, tt.error, false AS skipped,
         CASE WHEN tt.error IS NULL THEN {_inv_no('tt.text')} END AS invoiceNumber,
         CASE WHEN tt.error IS NULL THEN {_inv_date('tt.text')} END AS invoiceDate,
         CASE WHEN tt.error IS NULL THEN det.doctype END AS doctype,
         CASE WHEN tt.error IS NULL THEN det.invoiceType END AS invoiceType,
         CASE WHEN tt.error IS NULL THEN det.currency END AS currency
  FROM tt JOIN det ON det.doc_id = tt.doc_id
  UNION ALL
  SELECT name, true, target_name, json_name, NULL, true, NULL, NULL, NULL, NULL, NULL
  FROM s WHERE target_name IN (SELECT name FROM translated_blobs))""")
    out["translate_batch_results"] = base + "\nSELECT * FROM res"
    t_id, t_at = "'translation-20240110-120000-000000'", "TIMESTAMP '2024-01-10 12:00:00'"
    out["translate_batch_log"] = base + f"""
SELECT {t_id} AS run_id, 'DocTranslator' AS workflow_name,
       CASE WHEN success THEN 'translation_completed' ELSE 'translation_failed' END AS step_name, name AS step_value,
       1 AS item_count, CASE WHEN success THEN 'Completed' ELSE 'Failed' END AS status, {t_at} AS logged_at,
       CASE WHEN success THEN translated_blob ELSE error END AS detail FROM res WHERE NOT skipped
UNION ALL
SELECT {t_id}, 'DocTranslator', 'extraction_completed', name, 1, 'Completed', {t_at}, json_blob FROM res
WHERE success AND NOT skipped
UNION ALL
SELECT {t_id}, 'DocTranslator', 'workflow_completed', NULL, 1, 'Completed', {t_at},
       format('total={{:d}} succeeded={{:d}} failed={{:d}}', count(*), count(*) FILTER (WHERE success),
              count(*) FILTER (WHERE NOT success)) FROM res"""
    parts = {f: f"'\"{f}\":' || to_json({f})" for f in (
        "invoiceNumber", "invoiceDate", "purchaseOrderNumber", "currency", "vendorNumber", "Bank_Account_Number",
        "Global_Bank_Identifier", "invoiceType", "doctype", *NEW_TEXT)}
    parts |= {f: f"'\"{f}\":' || CAST({f} AS VARCHAR)" for f in ("totalInvoiceAmount", "taxAmount", *NEW_NUMBERS)}
    of_item = {c: f"'\"{c}\":' || to_json({c})" if c in ("lineNumber", "description", "category", "unitOfMeasure") else f"'\"{c}\":' || CAST({c} AS VARCHAR)"
               for c in ITEM_COLUMNS}
    full = base.replace("det.currency END AS currency\n", "det.currency END AS currency,\n" + ", ".join(
        f"det.{f}" for f in ("purchaseOrderNumber", "vendorNumber", "totalInvoiceAmount", "taxAmount", "Bank_Account_Number",
                             "Global_Bank_Identifier", *NEW_TEXT, *NEW_NUMBERS)) + "\n").replace(
        "NULL, true, NULL, NULL, NULL, NULL, NULL\n", "NULL, true" + ", NULL" * 20 + "\n")
    out["write_extraction_json"] = full + _items_cte("tt") + f""",
lists AS (SELECT doc_id AS name, string_agg('{{' || concat_ws(',', {", ".join(of_item.values())}) || '}}', ',' ORDER BY n) AS items FROM items GROUP BY doc_id)
SELECT json_blob AS name, '{{' || concat_ws(',', {", ".join(parts[f] for f in EXTRACTED_FIELDS)}, '"invoiceLineItems":[' || coalesce(items, '') || ']') || '}}' AS json
FROM res LEFT JOIN lists USING (name) WHERE success AND NOT skipped"""
    required = ("taxAmount", "taxPercentage", "totalInvoiceAmount", "vatPercentage", "vatTaxAmount")  # sorted; texts are '' where unknown
    out["validate_batch"] = full + f""",
v AS (SELECT name, list_filter([{", ".join(f"CASE WHEN {f} IS NULL THEN 'missing:{f}' END" for f in required)}], lambda x: x IS NOT NULL) AS vs
      FROM res WHERE success AND NOT skipped)
SELECT name, CAST(len(vs) AS INTEGER) AS n_violations, array_to_string(vs, ',') AS violations FROM v"""
    return out




def inventory_sql() -> dict[str, str]:
    out = {}
    ot = with_fixtures(["ocr_text"], "")
    out["scan_documents"] = ot + """
SELECT filename AS name, CAST(coalesce(octet_length(encode(text)), 0) AS INTEGER) AS n_bytes,
       coalesce(octet_length(encode(text)), 0) = 0 AS is_empty, coalesce(text, '') AS text FROM ocr_text"""
    pl = with_fixtures(["process_log"], "")
    out["period_filter"] = pl + "\n" + "\nUNION ALL\n".join(
        f"SELECT {_q(p)} AS period, count(*) AS n_rows FROM process_log WHERE {PERIOD_SQL[p]}" for p in vocab.VALID_PERIODS)
    out["response_filter_echo"] = _summary_sql(
        "overall", ",\n  'TR' AS filter_country_code, 'tr' AS filter_source_lang")
    ma = with_fixtures(["messages", "attachments"], "")
    out["outcome_join"] = ma + f""",
outcomes AS (SELECT * FROM attachments WHERE {USABLE} AND message_id IN (SELECT id FROM messages WHERE {WIN_ALL})),
r AS (SELECT message_id,
             CAST(sum(CASE WHEN is_valid THEN 1 ELSE 0 END) AS BIGINT) AS valid_count,
             CAST(sum(CASE WHEN is_valid THEN 0 ELSE 1 END) AS BIGINT) AS invalid_count FROM outcomes GROUP BY message_id)
SELECT r.message_id, valid_count, invalid_count,
       valid_count + invalid_count > 0 AND invalid_count = 0 AS all_valid,
       valid_count + invalid_count > 0 AND valid_count = 0 AS all_invalid,
       coalesce(m.subject, '(no subject)') AS subject, coalesce(m.from_address, '') AS sender_email,
       coalesce(m.from_name, split_part(coalesce(m.from_address, ''), '@', 1)) AS sender_name
FROM r JOIN messages m ON m.id = r.message_id"""
    out["order_messages_newest_first"] = with_fixtures(["messages"], "") + f"\nSELECT id, received_at FROM messages WHERE {WIN_ALL}"
    out["run_id_format"] = pl + "\nSELECT run_id, step_name, logged_at, 'ocr-' || strftime(logged_at, '%Y%m%d-%H%M%S-%f') AS new_run_id FROM process_log"
    out["parse_lookback_param"] = """
SELECT event_id, raw, CASE WHEN TRY_CAST(nullif(trim(raw), '') AS DOUBLE) IS NULL THEN 0.5
                           ELSE TRY_CAST(nullif(trim(raw), '') AS DOUBLE) END AS lookback_hours
FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN 'abc'
                            ELSE regexp_extract(props, '(\\d+)', 1) || '.' || CAST(event_id % 10 AS VARCHAR) END AS raw
      FROM events)"""
    out["summary_strings"] = ma + f""",
outcomes AS (SELECT * FROM attachments WHERE {USABLE} AND message_id IN (SELECT id FROM messages WHERE {WIN_ALL}))
SELECT 'messages=' || CAST((SELECT count(*) FROM messages WHERE {WIN_ALL}) AS VARCHAR)
       || ' valid=' || CAST(sum(CASE WHEN is_valid THEN 1 ELSE 0 END) AS VARCHAR)
       || ' invalid=' || CAST(sum(CASE WHEN is_valid THEN 0 ELSE 1 END) AS VARCHAR) AS scan_line,
       'Processed ' || CAST(count(*) AS VARCHAR) || ' file(s).' AS files_line
FROM outcomes"""
    out["stream_route"] = (with_fixtures(["source_blobs"], "") + path_ctes("source_blobs", out="src_paths") + ","
                           + FIXTURES["translated_blobs"] + """
SELECT DISTINCT container, name FROM src_paths WHERE _dir || _clean || '_en' || _suf NOT IN (SELECT name FROM translated_blobs)""")
    return out




def l3_sql() -> dict[str, str]:
    return {"structured_output_schema": """
SELECT o.o_orderkey AS doc_id,
       CASE WHEN o.o_orderkey % 19 = 0 THEN 'XXX' WHEN o.o_orderkey % 2 = 0 THEN 'POI' ELSE 'NPI' END AS doctype,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE CASE o.o_orderkey % 4 WHEN 0 THEN 'TRY' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'JPY' END END AS currency,
       CASE WHEN o.o_orderkey % 2 = 0 THEN '45' || lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0') ELSE '' END AS purchaseOrderNumber,
       CAST(CAST(floor((floor(o.o_totalprice * 0.18 * 100 + 0.5) / 100) * 100.0 + 0.5) AS DECIMAL(38,0)) / 100 AS DECIMAL(18,2)) AS vatTaxAmount,
       CAST(coalesce(li.n_items, 0) AS INTEGER) AS n_items
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n_items FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) li
     ON o.o_orderkey = li.l_orderkey"""}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(lineage_sql())
    out.update(naming_sql())
    out.update(listing_sql())
    out.update(mail_sql())
    out.update(text_sql())
    out.update(extract_sql())
    out.update(classify_sql())
    out.update(notify_sql())
    out.update(streaming_sql())
    out.update(injected_sql())
    out.update(pipeline_sql())
    out.update(ocr_pipeline_sql())
    out.update(email_scan_sql())
    out.update(batch_results_sql())
    out.update(inventory_sql())
    out.update(l3_sql())
    return out
