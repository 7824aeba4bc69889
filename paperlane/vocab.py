"""Fixed values that must equal the reference's for right results.

FIXED VALUES — vocabularies, lookup tables and patterns as written in the
reference's code, in their natural order. Do not edit for style.
"""
from __future__ import annotations

# --- process-log step names (reference order) ---------------------------------
STEP_NAMES = (
    "email_received",
    "attachment_processed",
    "attachment_validation_passed",
    "attachment_validation_failed",
    "ocr_completed",
    "ocr_failed",
    "translation_completed",
    "translation_failed",
    "extraction_completed",
    "extraction_failed",
    "workflow_completed",
    "workflow_failed",
)

# --- workflow names -------------------------------------------------------------
WORKFLOW_NAMES = ("EmailScanner", "OCRPipeline", "DocTranslator", "SFTPUpload", "DailyReport")

# --- lineage summary: output key <- step name (two keys are renamed) ------------
SUMMARY_METRICS = (
    ("emails_received", "email_received"),
    ("attachments_processed", "attachment_processed"),
    ("attachment_validation_passed", "attachment_validation_passed"),
    ("attachment_validation_failed", "attachment_validation_failed"),
    ("ocr_completed", "ocr_completed"),
    ("ocr_failed", "ocr_failed"),
    ("translation_completed", "translation_completed"),
    ("translation_failed", "translation_failed"),
    ("extraction_completed", "extraction_completed"),
    ("extraction_failed", "extraction_failed"),
    ("workflow_completed", "workflow_completed"),
    ("workflow_failed", "workflow_failed"),
)

VALID_PERIODS = ("today", "yesterday", "last_7_days", "last_30_days", "overall")

# --- attachment MIME sets ---------------------------------------------------------
SUPPORTED_ATTACHMENT_TYPES = (
    "application/pdf",
    "application/msword",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/vnd.ms-excel",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "image/tiff",
    "image/tif",
)
SKIP_ATTACHMENT_TYPES = (
    "image/png",
    "image/jpeg",
    "image/jpg",
    "image/gif",
    "image/bmp",
    "image/webp",
    "image/svg+xml",
)
MIN_ATTACHMENT_SIZE = 100

# --- extension -> content type: attachment variant (6 entries) ------------------
ATTACHMENT_CONTENT_TYPES = (
    (".pdf", "application/pdf"),
    (".docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    (".doc", "application/msword"),
    (".xlsx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    (".tiff", "image/tiff"),
    (".tif", "image/tiff"),
)
# --- extension -> content type: translator variant (9 entries) ------------------
DOCUMENT_CONTENT_TYPES = (
    (".pdf", "application/pdf"),
    (".docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    (".doc", "application/msword"),
    (".xlsx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    (".png", "image/png"),
    (".jpg", "image/jpeg"),
    (".jpeg", "image/jpeg"),
    (".tiff", "image/tiff"),
    (".tif", "image/tiff"),
)
DEFAULT_CONTENT_TYPE = "application/octet-stream"

# --- naming patterns --------------------------------------------------------------
LANG_SUFFIX_PATTERN = r"_([a-zA-Z]{2})$"
OCR_SUFFIX_PATTERN = r"(_enhanced)?_ocr$"

# --- number pattern of the amount integrity check ---------------------------------
NUMBER_PATTERN = r"\b\d{1,3}(?:[ ,]\d{3})*(?:\.\d+)?\b"
AMOUNT_MISSING_THRESHOLD = 0.2

# --- translation ---------------------------------------------------------------------
TRANSLATION_CHUNK_SIZE = 9000
DETECTION_PREFIX = 500
CLASSIFICATION_PREFIX = 4000
LANG_MIN_SCORE = 0.5
UNKNOWN_LANG = "xx"

# --- attachment outcome texts ----------------------------------------------------------
EMPTY_TEXT_REASON = ("Document appears to be empty or contains no readable text "
                     "(possibly a scanned image without OCR layer).")
NO_REASON = "No reason provided."
CLASSIFIER_FAILED_REASON = "Classification failed — LLM did not return a structured response."
NO_SUBJECT = "(no subject)"

# --- container names (defaults) ----------------------------------------------------------
RAW_INVOICE_CONTAINER = "raw-invoices"
INVALID_INVOICE_CONTAINER = "invalid-invoices"
OCR_TARGET_CONTAINER = "ocr-invoices"
OCR_FAILED_CONTAINER = "failed-invoices"

# --- extraction: PO number, bank formats ----------------------------------------------------
PO_NUMBER_PATTERN = r"^(66|45)\d{8}$"
PO_NUMBER_IN_TEXT = r"\b(?:66|45)\d{8}\b"
BANK_ACCOUNT_PATTERN = r"^\d{9,18}$"
SWIFT_BIC_PATTERN = r"^[A-Za-z0-9]{8}([A-Za-z0-9]{3})?$"

# invoice-number labels named in the extraction instructions, priority order
INVOICE_NUMBER_LABELS = (
    "Invoice Number",
    "Invoice No.",
    "Invoice #",
    "Document Number",
    "Reference Number",
    "Request No.",
    "Billing No.",
)

DOCTYPES = ("POI", "NPI")
INVOICE_TYPES = (
    "STANDARD",
    "RETURN",
    "FOREIGN_CURRENCY",
    "OUTSIDE_SCOPE",
    "IMPORT",
    "FREELANCE_INVOICE",
    "RECEIPT",
    "NOTARY_E_RECEIPT",
)
RETURN_KEYWORDS = ("Return", "Credit Note", "CN", "Refund", "Reversal", "IADE")
FREELANCE_KEYWORD = "e-Serbest Meslek Makbuzu"
RECEIPT_KEYWORD = "Dekont"
NOTARY_KEYWORD = "NOTERLÎK E-MAKBUZU"
HOME_CURRENCY = "TRY"

LINE_ITEM_CATEGORIES = (
    "CONSTRUCTION_ENGINEERING",
    "CONSTRUCTION_CONSULTING",
    "CONSTRUCTION_INSPECTION",
    "CLEANING_FACILITY",
    "PERSONNEL_LABOR",
    "PERSONNEL_GENERAL",
    "PERSONNEL_TRANSPORT",
    "TRANSPORT_FREIGHT",
    "PROFESSIONAL_CATERING",
    "PROFESSIONAL_INTERMEDIARY",
    "ADVERTISING",
    "MAINTENANCE_TECHNICAL",
    "PRINTING_PUBLISHING",
    "MANUFACTURING_TEXTILE",
    "HEALTHCARE_PPP",
    "METALS_STANDARD",
    "METALS_SCRAP",
    "METALS_RECYCLED",
    "AGRI_RAW",
    "AGRI_FORESTRY",
    "INDUSTRIAL_IRON_STEEL",
    "INDUSTRIAL_OTHER_DELIVERIES",
    "OTHER_SERVICES",
)
DETAILS_REQUIRED = ("doctype", "taxAmount", "vatTaxAmount", "totalInvoiceAmount",
                    "invoiceLineItems", "taxPercentage", "vatPercentage", "currency")
LINE_ITEM_REQUIRED = ("lineNumber", "category", "quantity", "unitOfMeasure", "unitPrice",
                      "netAmount", "vatAmount", "vatPercentage", "withholdingPercentage")
BASELINE_REQUIRED = ("invoiceNumber", "invoiceDate")

# negative document kinds named by the classification instructions
NON_INVOICE_KINDS = (
    "delivery note",
    "packing slip",
    "packing list",
    "purchase order",
    "statement of account",
    "receipt",
    "brochure",
    "contract",
)

# --- structured-output contract of the details extraction: field -> JSON type ----------
DETAILS_FIELD_TYPES = (
    ("doctype", "string"),
    ("invoiceType", "string"),
    ("purchaseOrderNumber", "string"),
    ("vendorNumber", "string"),
    ("taxAmount", "number"),
    ("vatTaxAmount", "number"),
    ("totalNetAmount", "number"),
    ("totalInvoiceAmount", "number"),
    ("taxIdentification", "string"),
    ("receiverVATID", "string"),
    ("taxPercentage", "number"),
    ("vatPercentage", "number"),
    ("withholdingPercentage", "number"),
    ("Bank_Account_Number", "string"),
    ("Global_Bank_Identifier", "string"),
    ("Bank_Key", "string"),
    ("buyerName", "string"),
    ("currency", "string"),
)
LINE_ITEM_FIELD_TYPES = (
    ("lineNumber", "string"),
    ("description", "string"),
    ("category", "string"),
    ("quantity", "number"),
    ("unitOfMeasure", "string"),
    ("unitPrice", "number"),
    ("netAmount", "number"),
    ("taxAmount", "number"),
    ("taxPercentage", "number"),
    ("vatAmount", "number"),
    ("vatPercentage", "number"),
    ("withholdingPercentage", "number"),
)
