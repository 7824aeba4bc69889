"""Line items from an invoice's text.

A record parser over lines, as column expressions in the scan stage:

1. each line is classified by its token shapes: a table *header* (no digit and
   three of the four columns named, or two by a line of nothing but column
   words), a *total* (begins with a total's label), an *item* (begins with a line
   number and a word) or anything else;
2. ``aggregate`` folds the lines with a small state machine into records. A
   header opens a table, a total closes it. An item line opens a record if its
   number goes on from the last one. While a record has no amounts yet, further
   lines belong to it (wrapped descriptions); once it has, only an indented
   line without digits does;
3. a record is read from its end: quantity, unit, price, rate, amount. Numbers
   are read in both decimal styles and the reading where quantity times price
   gives the amount is taken;
4. the category is the one with most keywords in the description, ties to the
   one named first, none: ``OTHER_SERVICES``.

Columns that a table lacks are derived (amount of quantity and price, price of
amount and quantity); rates come from the line, else from the invoice, else 0.

A record spans at most :data:`SPAN` lines; numbers of one table rise, so the
records of a table are at most 999 and the fold is linear in the text.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.operators.schema import _let

#: The columns that a header may name.
HEADER_WORDS = {
    "description": r"(?i)\b(?:description|item|goods|service|product)s?\b",
    "quantity": r"(?i)\b(?:qty|quantity)\b",
    "price": r"(?i)\b(?:price|rate)\b",
    "amount": r"(?i)\b(?:amount|net|total)\b",
}
#: A header names so many of them, or two and nothing but column words.
HEADER_LEAST = 3
_WORD = r"(?:(?:no|nr|line|pos|item|description|goods|service|product|qty|quantity|unit|of|measure|price|rate|vat|kdv|tax|net|total|amount)s?[.:%#]*|[%#|])"
COLUMN_WORDS = rf"(?i)^\s*(?:{_WORD}\s+)*{_WORD}\s*$"
VAT_COLUMN = r"(?i)\b(?:vat|kdv)\b"
TAX_COLUMN = r"(?i)\btax\b"
TOTAL_LINE = r"(?i)^\s*(?:sub\s?total|grand total|total|net total|net amount|vat amount|tax amount|amount due|balance due|vat|tax)\b"
ITEM_LINE = r"^[0-9]{1,3}[.)]? \S*\p{L}"
CURRENCY_MARK = r"[$€£¥₺]|\b(?:TRY|TL|USD|EUR|GBP|JPY)\b"
#: How far a line number may be from the last one.
STEP = 10
SPAN = 4

NUMBER = r"-?[0-9](?:[0-9.,]*[0-9])?"
MONEY = r"-?[0-9][0-9.,]*[.,][0-9]{2}"
UNIT = r"(?: ?(\p{L}{1,4}))?"
RATE = r"(?: ([0-9]{1,2}(?:[.,][0-9]{1,2})?) ?%)?"
_LINE, _REST = r"^([0-9]{1,3})[.)]? (.+?)", r"((?: [^0-9]+)?)$"
#: Shapes of a whole record: number, description, quantity, unit, price, rate, amount, rest (where the header names a price) ...
FULL = f"{_LINE} ({NUMBER}){UNIT} ({NUMBER}){RATE} ({NUMBER}){_REST}"
#: ... with one of price and amount ...
SHORT = f"{_LINE} ({NUMBER}){UNIT}{RATE} ({MONEY}){_REST}"
#: ... and with an amount alone, where the header names no quantity.
LUMP = f"{_LINE}{RATE} ({MONEY}){_REST}"

POINT_STYLE = r"^-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?$"
COMMA_STYLE = r"^-?(?:[0-9]{1,3}(?:\.[0-9]{3})+|[0-9]+)(?:,[0-9]+)?$"

#: Words of a description that speak for a category.
CATEGORY_KEYWORDS = {
    "CONSTRUCTION_ENGINEERING": ("construction", "engineering", "architecture", "excavation", "concrete"),
    "CONSTRUCTION_CONSULTING": ("feasibility", "surveying", "planning"),
    "CONSTRUCTION_INSPECTION": ("inspection", "supervision"),
    "CLEANING_FACILITY": ("cleaning", "janitorial", "hygiene", "facility", "gardening"),
    "PERSONNEL_LABOR": ("labor", "labour", "workforce", "staffing"),
    "PERSONNEL_GENERAL": ("payroll", "recruitment", "personnel"),
    "PERSONNEL_TRANSPORT": ("shuttle", "commuter", "passenger"),
    "TRANSPORT_FREIGHT": ("freight", "shipping", "cargo", "haulage", "transport", "delivery"),
    "PROFESSIONAL_CATERING": ("catering", "meal", "meals", "canteen"),
    "PROFESSIONAL_INTERMEDIARY": ("brokerage", "commission", "intermediary", "agency"),
    "ADVERTISING": ("advertising", "advertisement", "campaign", "marketing", "media"),
    "MAINTENANCE_TECHNICAL": ("maintenance", "repair", "calibration", "servicing", "spare"),
    "PRINTING_PUBLISHING": ("printing", "brochures", "publishing", "booklet", "print"),
    "MANUFACTURING_TEXTILE": ("textile", "fabric", "sewing", "uniform", "uniforms"),
    "HEALTHCARE_PPP": ("hospital", "clinical", "medical", "healthcare"),
    "METALS_STANDARD": ("copper", "aluminium", "zinc", "lead", "brass"),
    "METALS_SCRAP": ("scrap",),
    "METALS_RECYCLED": ("recycled", "ingots"),
    "AGRI_RAW": ("wheat", "cotton", "wool", "hides"),
    "AGRI_FORESTRY": ("timber", "wood", "lumber", "pallets"),
    "INDUSTRIAL_IRON_STEEL": ("steel", "iron", "rebar", "rods"),
    "INDUSTRIAL_OTHER_DELIVERIES": ("machinery", "equipment", "pump", "valve", "filter"),
}
OTHER_CATEGORY = "OTHER_SERVICES"

ITEM_FIELDS = ("lineNumber", "description", "category", "quantity", "unitOfMeasure", "unitPrice", "netAmount", "taxAmount",
               "taxPercentage", "vatAmount", "vatPercentage", "withholdingPercentage")


def _is_header(raw: Column) -> Column:
    """Whether a line names the columns of a table; lines with digits, most of them, cost one search."""
    n = F.array_compact(F.array(*(F.when(raw.rlike(p), F.lit(1)) for p in HEADER_WORDS.values())))
    return ~raw.rlike("[0-9]") & _let(F.size(n), lambda n: (n >= HEADER_LEAST) | ((n >= 2) & raw.rlike(COLUMN_WORDS)))


def _from_first_header(lines: Column) -> Column:
    """The lines from the first header on; those before it are of no table and aren't measured."""
    def cut(x: Column) -> Column:
        first = F.array_position(F.transform(x, _is_header), F.lit(True)).cast("int")
        return _let(first, lambda at: F.when(at > 0, F.slice(x, at, F.size(x))).otherwise(F.array().cast("array<string>")))

    return _let(lines, cut)


def _measured(raw: Column) -> Column:
    """A line's text without currency marks, and what it is."""
    text = F.trim(F.regexp_replace(F.regexp_replace(raw, CURRENCY_MARK, " "), r"\s+", " "))
    return F.struct(raw.alias("raw"), text.alias("text"), raw.rlike("[0-9]").alias("digits"), _is_header(raw).alias("header"))


def _classified(line: Column) -> Column:
    """A measured line's kind and what the kind needs."""
    raw, text, header = line["raw"], line["text"], line["header"]
    kind = (F.when(header, "header").when(raw.rlike(TOTAL_LINE), "total").when(line["digits"] & text.rlike(ITEM_LINE), "item")
             .otherwise("other"))

    def names(column: str) -> Column:
        return raw.rlike(HEADER_WORDS[column])

    flags = F.when(header, F.concat(
        F.when(names("quantity"), "q").otherwise(""), F.when(names("price"), "p").otherwise(""), F.when(names("amount"), "a").otherwise(""),
        F.when(raw.rlike(VAT_COLUMN), "v").when(raw.rlike(TAX_COLUMN), "t").otherwise(""))).otherwise("")
    number = F.when(line["digits"], F.regexp_extract(text, "^([0-9]{1,3})", 1).try_cast("int"))
    return F.struct(text.alias("text"), kind.alias("kind"), flags.alias("flags"), F.coalesce(number, F.lit(0)).alias("number"),
                    (raw.rlike(r"^\s+\S") & ~line["digits"]).alias("trails"))


def _complete(text: Column, flags: Column) -> Column:
    return (F.when(flags.contains("q"), (flags.contains("p") & text.rlike(FULL)) | text.rlike(SHORT))
             .otherwise(text.rlike(LUMP)))


def _state(open_, fresh, last, flags, complete, span, records) -> Column:
    return F.struct(open_.alias("open"), fresh.alias("fresh"), last.alias("last"), flags.alias("flags"),
                    complete.alias("complete"), span.alias("span"), records.alias("records"))


def _step(s: Column, line: Column) -> Column:
    yes, no = F.lit(True), F.lit(False)
    records, text = s["records"], line["text"]
    opens = (line["kind"] == "item") & (((line["number"] > s["last"]) & (line["number"] <= s["last"] + STEP))
                                        | (s["fresh"] & (line["number"] == 1)))
    begun = _state(yes, no, line["number"], s["flags"], _complete(text, s["flags"]), F.lit(1),
                   F.concat(records, F.array(F.struct(text.alias("text"), s["flags"].alias("flags")))))
    goes_on = (F.size(records) > 0) & ~s["fresh"] & (text != "") & (s["span"] < SPAN) & (~s["complete"] | line["trails"])
    longer = F.concat(F.element_at(records, -1)["text"], F.lit(" "), text)
    gone_on = _state(yes, no, s["last"], s["flags"], s["complete"] | _complete(longer, s["flags"]), s["span"] + 1,
                     F.concat(F.slice(records, 1, F.size(records) - 1),
                              F.array(F.struct(longer.alias("text"), s["flags"].alias("flags")))))
    return (F.when(line["kind"] == "header", _state(yes, yes, s["last"], line["flags"], yes, F.lit(0), records))
             .when(~s["open"], s)
             .when(line["kind"] == "total", _state(no, no, F.lit(0), s["flags"], yes, F.lit(0), records))
             .when(opens, begun)
             .when(goes_on, gone_on)
             .otherwise(s))


def item_records(text: Column) -> Column:
    """``array<struct<text, flags>>``: the records of the tables of a text."""
    lines = F.transform(F.transform(_from_first_header(F.split(text, "\n")), _measured), _classified)
    start = _state(F.lit(False), F.lit(False), F.lit(0), F.lit(""), F.lit(True), F.lit(0),
                   F.array().cast("array<struct<text:string,flags:string>>"))
    return F.aggregate(lines, start, _step)["records"]


def may_have_table(low: Column) -> Column:
    """A byte search that spares texts without a header's first words."""
    words = ("description", "item", "goods", "service", "product", "qty", "quantity", "price", "rate")
    return reduce(lambda a, b: a | b, (low.contains(w) for w in words))


def has_items(text: Column) -> Column:
    """Whether a text has a line item with an amount."""
    return F.exists(item_records(text), lambda r: _complete(r["text"], r["flags"]))


def _cut(r: Column) -> Column:
    """The pieces of a record ('' where it lacks one): number, description,
    quantity, unit, price, rate, amount, rest. Null where it has no shape."""
    t, flags = r["text"], r["flags"]
    has_q = flags.contains("q")

    def by(shape: str, groups: tuple) -> Column:
        return F.split(F.regexp_replace(t, shape, "\x01".join(f"${g}" if g else "" for g in groups)), "\x01")

    return (F.when(~has_q & t.rlike(LUMP), by(LUMP, (1, 2, 0, 0, 0, 3, 4, 5)))
             .when(has_q & flags.contains("p") & t.rlike(FULL), by(FULL, (1, 2, 3, 4, 5, 6, 7, 8)))
             .when(has_q & t.rlike(SHORT), by(SHORT, (1, 2, 3, 4, 0, 5, 6, 7))))


def _pieces(r: Column) -> Column:
    x, flags = r["x"], r["flags"]
    alone = flags.contains("q") & (x[4] == "") & ~flags.contains("a")  # one number after the quantity, and it is a price
    return F.struct(
        x[0].alias("line"), F.trim(F.concat(x[1], x[7])).alias("description"),
        F.when(flags.contains("q"), x[2]).otherwise(F.lit("1")).alias("quantity"), F.upper(x[3]).alias("unit"),
        F.when(alone, x[6]).otherwise(x[4]).alias("price"), x[5].alias("rate"),
        F.when(alone, F.lit("")).otherwise(x[6]).alias("amount"), flags.alias("flags"))


def _reading(p: Column, comma: bool) -> Column:
    """The numbers of a record in one decimal style (null: not of that style)."""

    def number(x: Column) -> Column:
        plain = F.replace(F.replace(x, F.lit("."), F.lit("")), F.lit(","), F.lit(".")) if comma else F.replace(x, F.lit(","), F.lit(""))
        return F.when(x.rlike(COMMA_STYLE if comma else POINT_STYLE), plain.try_cast("decimal(18,4)"))

    def judged(n: Column) -> Column:
        q, price, amount = n["q"], n["price"], n["amount"]
        fits = (q.isNotNull() & ((p["price"] == "") | price.isNotNull()) & ((p["amount"] == "") | amount.isNotNull()))
        agrees = F.abs(q * price - amount) <= F.greatest(F.lit("0.02").cast("decimal(4,2)"),
                                                         F.abs(amount) * F.lit("0.001").cast("decimal(4,3)"))
        return F.struct(q.alias("q"), price.alias("price"), amount.alias("amount"), fits.alias("fits"), agrees.alias("agrees"))

    return _let(F.struct(number(p["quantity"]).alias("q"), number(p["price"]).alias("price"), number(p["amount"]).alias("amount")), judged)


def _read(p: Column) -> Column:
    def agreed(n: Column) -> Column:
        return n["fits"] & F.coalesce(n["agrees"], F.lit(False))

    def chosen(point: Column) -> Column:  # the other style is read only where this one doesn't agree
        other = _let(_reading(p, True), lambda comma: F.when(agreed(comma), comma).when(point["fits"], point).otherwise(comma))
        return F.when(agreed(point), point).otherwise(other)

    return F.struct(p.alias("p"), _let(_reading(p, False), chosen).alias("n"))


def category(description: Column) -> Column:
    """The category with most keywords among the words of a description."""
    number = {c: i for i, c in enumerate(vocab.LINE_ITEM_CATEGORIES)}
    table = F.create_map(*(F.lit(x) for c, words in CATEGORY_KEYWORDS.items() for w in words for x in (w, number[c])))
    hits = F.filter(F.transform(F.split(F.lower(description), "[^a-z]+"), lambda w: F.try_element_at(table, w)),
                    lambda h: h.isNotNull())

    def most(found: Column) -> Column:
        return F.array_max(F.transform(found, lambda h: F.struct(F.size(F.filter(found, lambda x: x == h)).alias("n"), (-h).alias("first"))))

    best = F.get(F.transform(F.array(hits), most), F.lit(0))  # the words are looked up once
    return F.coalesce(F.get(F.array(*map(F.lit, vocab.LINE_ITEM_CATEGORIES)), -best["first"]), F.lit(OTHER_CATEGORY))


def _item(x: Column, tax: Column, vat: Column, withholding: Column) -> Column:
    p, n = x["p"], x["n"]
    net = F.coalesce(n["amount"], n["q"] * n["price"]).cast("decimal(18,2)")
    price = F.coalesce(n["price"], F.when(n["q"] != 0, n["amount"] / n["q"])).cast("decimal(18,4)")
    rate = F.when(p["rate"] != "", F.replace(p["rate"], F.lit(","), F.lit(".")).try_cast("decimal(9,2)"))
    of_vat = F.coalesce(F.when(p["flags"].contains("v"), rate), vat, F.lit(0).cast("decimal(9,2)"))
    of_tax = F.coalesce(F.when(p["flags"].contains("t"), rate), tax)
    hundredth = F.lit("0.01").cast("decimal(3,2)")

    def made(y: Column) -> Column:
        def share(r: Column) -> Column:
            return (y["net"] * r * hundredth).cast("decimal(18,2)")

        return F.struct(
            p["line"].alias("lineNumber"), p["description"].alias("description"), category(p["description"]).alias("category"),
            n["q"].cast("decimal(18,3)").alias("quantity"), p["unit"].alias("unitOfMeasure"), price.alias("unitPrice"),
            y["net"].alias("netAmount"), share(y["tax"]).alias("taxAmount"), y["tax"].alias("taxPercentage"),
            share(y["vat"]).alias("vatAmount"), y["vat"].alias("vatPercentage"),
            F.coalesce(withholding, F.lit(0).cast("decimal(9,2)")).alias("withholdingPercentage"), n["agrees"].alias("agrees"))

    return _let(F.struct(net.alias("net"), of_vat.alias("vat"), of_tax.alias("tax")), made)


def line_items(text: Column, low: Column, tax: Column, vat: Column, withholding: Column) -> Column:
    """``array<struct>`` of the :data:`ITEM_FIELDS` and ``agrees``: whether
    quantity times price gives the amount (null where one of them is not in the
    text). ``low``: the text in lower case; ``tax``, ``vat``, ``withholding``:
    the invoice's rates."""
    has_table = may_have_table(low)
    cut = F.filter(F.transform(item_records(text), lambda r: F.struct(_cut(r).alias("x"), r["flags"].alias("flags"))),
                   lambda r: r["x"].isNotNull())
    read = F.filter(F.transform(F.transform(cut, _pieces), _read), lambda x: x["n"]["q"].isNotNull()
                    & (x["n"]["price"].isNotNull() | x["n"]["amount"].isNotNull()))
    items = F.transform(read, lambda x: _item(x, tax, vat, withholding))
    empty = F.array().cast("array<struct<lineNumber:string,description:string,category:string,quantity:decimal(18,3),"
                           "unitOfMeasure:string,unitPrice:decimal(18,4),netAmount:decimal(18,2),taxAmount:decimal(18,2),"
                           "taxPercentage:decimal(9,2),vatAmount:decimal(18,2),vatPercentage:decimal(9,2),"
                           "withholdingPercentage:decimal(9,2),agrees:boolean>>")
    return F.when(F.coalesce(has_table, F.lit(False)), items).otherwise(empty)
