"""Secret scan with an incremental blob ledger, in DataFrame functions only.

Every version of a document is content-addressed (SHA-256 of its text). The
ledger holds the (blob, rule, rule version) triples that have been scanned and
what was found; :meth:`BlobLedger.update` scans the unseen triples alone, one
representative document for each blob, and appends. Findings are joined back
to every document that holds the blob.

Matches of a rule are leftmost and non-overlapping. Their places come from the
pieces between them (``split``) and their own lengths (``regexp_extract_all``)
by a running sum over one row for each match.

Scale: blobs are chosen by a partial aggregate over (hash, id), so a text that
a third of the rows hold is one row for each map task; the scan's join with
the texts is on (hash, id), spread over the ids; texts are shuffled once and
scanned once, findings are small. The join back has one row for each blob on
one side, so Spark can split a hot blob's other side (AQE).

Defined cases: a null text is the empty text (its own blob); rows that repeat
an id and text are one version, rows that repeat an id with other texts are
versions of it; null ids are ids like any other; an empty table gives an empty
result; extra columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperlane.sources.files import Folder

from .common import id_and_text, new_folder, written


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those whose ``group`` has fewer than
    ``least`` characters are dropped."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1


#: The kinds of the query contract, in its order, then the method's own. A
#: run of {n,} is what is left of all runs once those under n are dropped.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
RULES = (*BASE_RULES,
         Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
         Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
         Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
         Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"))


def _addressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text, blob)``."""
    return id_and_text(docs, id_col, text_col, binary=False).withColumn(
        "blob", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _matches(rule: Rule, number: int):
    """Struct of one rule's matches: rule number, lengths of the pieces before
    them and of themselves, and whether each is long enough."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    own = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.struct(
        F.lit(number).alias("rule"),
        F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), F.length).alias("before"),
                     F.transform(own, F.length).alias("size"),
                     F.transform(value, lambda v: F.length(v) >= rule.least).alias("ok")).alias("found"))


def scan_texts(pending: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``pending``: ``(blob, text, todo)``, todo the numbers of the rules to
    run. Returns ``(blob, kind, version, start, end)``, no row twice."""
    each = F.array(*(F.when(F.array_contains("todo", n) & F.col("text").rlike(r.pattern), _matches(r, n))
                     for n, r in enumerate(rules)))
    rows = (pending.select("blob", F.explode(F.filter(each, lambda m: m.isNotNull())).alias("m"))
            .select("blob", "m.rule", F.posexplode("m.found").alias("i", "f"))
            .select("blob", "rule", "i", "f.*")
            .filter(F.col("size").isNotNull())  # the piece after the last match
            .repartition("blob").dropDuplicates(["blob", "rule", "i"]))
    order = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    names = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    end = F.sum(F.col("before") + F.col("size")).over(order)
    return (rows.withColumn("end", end).filter("ok")
            .select("blob", names[F.col("rule")].alias("r"), (F.col("end") - F.col("size")).alias("start"), "end")
            .select("blob", "r.kind", "r.version", "start", "end"))


class BlobLedger:
    """Scanned triples and findings, as Parquet files under one folder. Each
    update adds a generation and commits it by a marker file, written last: a
    ledger that is opened again (by another process) goes on after the committed
    generations, and what an update that was cut off has left counts for nothing.
    One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder, Folder(spark, folder)

    def _generations(self) -> list[int]:
        return sorted(int(n.removesuffix(".done")) for n in self.files.names("commits"))

    def _next(self) -> int:
        """Above all generations, also those that were not committed."""
        seen = [int(n) for what in ("findings", "scanned") for n in self.files.names(what)]
        return 1 + max([*seen, *self._generations()], default=-1)

    def _read(self, what: str) -> DataFrame | None:
        paths = [f"{self.folder}/{what}/{g}" for g in self._generations()]
        return self.spark.read.parquet(*paths) if paths else None

    def scanned(self) -> DataFrame | None:
        """``(blob, kinds)``: the ``kind:version`` scanned, per generation."""
        return self._read("scanned")

    def findings(self) -> DataFrame | None:
        return self._read("findings")

    def pending(self, ids: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """``(blob, doc_id, todo)``: for each blob with unseen rules one of its
        documents and those rules' numbers."""
        blobs = ids.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
        numbers = F.array(*(F.lit(n) for n in range(len(rules))))
        done = self.scanned()
        if done is None:
            return blobs.withColumn("todo", numbers)
        labels = F.array(*(F.lit(f"{r.kind}:{r.version}") for r in rules))
        done = done.select("blob", F.explode("kinds").alias("kind")).groupBy("blob").agg(
            F.collect_set("kind").alias("done"))  # bounded by the rules
        todo = F.filter(numbers, lambda n: ~F.array_contains(
            F.coalesce("done", F.array().cast("array<string>")), labels[n]))
        return (blobs.join(done, "blob", "left").select("blob", "doc_id", todo.alias("todo"))
                .filter(F.size("todo") > 0))

    def update(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
        """Scan what ``docs`` add; returns ``(doc_id, blob)`` of all their rows."""
        addressed = _addressed(docs, id_col, text_col)
        ids = written(addressed.select("doc_id", "blob"), "blobs")
        todo = written(self.pending(ids, rules).withColumnRenamed("doc_id", "at"), "pending")
        same = (addressed["blob"] == todo["blob"]) & addressed["doc_id"].eqNullSafe(todo["at"])
        texts = addressed.join(todo, same).select(todo["blob"], "text", "todo")
        generation = self._next()
        scan_texts(texts, rules).write.parquet(f"{self.folder}/findings/{generation}")
        labels = F.array(*(F.lit(f"{r.kind}:{r.version}") for r in rules))
        todo.select("blob", F.transform("todo", lambda n: labels[n]).alias("kinds")).write.parquet(
            f"{self.folder}/scanned/{generation}")
        self.files.create(f"commits/{generation}.done", "")
        return ids


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: BlobLedger | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, found``, the spans of the rules' present
    versions as structs ``(start, rule, end, kind)`` in order of start and rule
    (``rule``: its number)."""
    ledger = ledger or BlobLedger(docs.sparkSession, new_folder(docs.sparkSession, "secrets"))
    ids = ledger.update(docs, rules, id_col, text_col)
    numbers = F.create_map(*(x for n, r in enumerate(rules) for x in (F.lit(f"{r.kind}:{r.version}"), F.lit(n))))
    current = numbers[F.concat_ws(":", "kind", F.col("version").cast("string"))]
    spans = (ledger.findings().withColumn("rule", current).filter("rule is not null")
             .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "rule", "end", "kind"))).alias("found")))
    return ids.join(spans, "blob", "left").select("doc_id", "found")


def span_text(found):
    """``kind:start:end`` of an array of span structs, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
