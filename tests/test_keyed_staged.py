"""The keyed table's versions and the staged commit of several sinks: crashes,
repeats, writers that meet, compaction, payloads."""
import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from paperlane import vocab
from paperlane.operators.keyed import KeyedTable
from paperlane.plans import pipelines as pl
from paperlane.plans.staged import StagedRun
from paperlane.sources import fixtures as fx
from paperlane.sources.files import Folder

from .conftest import SF_SMALL

T = dt.datetime(2024, 1, 1)


def writes(spark, rows, extra=""):
    return spark.createDataFrame([("c", n, T + dt.timedelta(hours=h), 0.0, v, *x) for n, h, v, *x in rows],
                                 "container string, name string, written_at timestamp_ntz, tiebreak double, v long" + extra)


def state(df):
    return {r.name: r.v for r in df.collect()}


def new_table(spark, **kw):
    return KeyedTable(spark, tempfile.mkdtemp(prefix="keyed-"), **kw)


def test_a_crash_before_the_commit_leaves_the_old_state(spark, monkeypatch):
    t = new_table(spark)
    t.write(writes(spark, [("a", 0, 1), ("b", 0, 2)]), "r1")
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            t.write(writes(spark, [("a", 1, 9)]), "r2")
    assert state(t.read()) == {"a": 1, "b": 2} and len(t.files.names("segments")) == 2
    assert state(t.write(writes(spark, [("a", 1, 9)]), "r2")) == {"a": 9, "b": 2}
    assert len(t.vacuum(1)) == 2 and state(t.read()) == {"a": 9, "b": 2}  # the orphan and the first commit


def test_a_commit_that_was_cut_off_counts_for_nothing(spark):
    t = new_table(spark)
    t.write(writes(spark, [("a", 0, 1)]), "r1")
    t.files.create("commits/v0000000002.json", '{"version": 2, "segm')
    assert state(t.read()) == {"a": 1}
    assert state(t.write(writes(spark, [("a", 1, 2)]), "r2")) == {"a": 2} and t.snapshot()["version"] == 3


def test_writers_that_meet_both_count(spark, monkeypatch):
    t, other = new_table(spark), None
    t.write(writes(spark, [("a", 0, 1)]), "r1")
    other = KeyedTable(spark, t.path)
    real, once = KeyedTable._commit, []

    def meet(self, segments, schema):
        if self is t and not once:
            once.append(1)
            other.write(writes(spark, [("b", 0, 5)]), "r2")  # comes between reading and committing
        return real(self, segments, schema)

    monkeypatch.setattr(KeyedTable, "_commit", meet)
    names = lambda self: [n for n in real_names(self) if not (self is t and len(once) == 1 and n.endswith("2.json") and once.append(2) is None)]
    real_names = KeyedTable._version_names
    monkeypatch.setattr(KeyedTable, "_version_names", names)  # t still sees the old version when it commits
    assert state(t.write(writes(spark, [("c", 0, 7)]), "r3")) == {"a": 1, "b": 5, "c": 7}


def test_compaction_bounds_the_read(spark):
    t = new_table(spark, most_segments=4)
    for i in range(11):
        t.write(writes(spark, [("hot", i, i), (f"k{i}", 0, i)]), f"r{i}")
        assert len(t.snapshot()["segments"]) <= 4
    assert state(t.read()) == {"hot": 10, **{f"k{i}": i for i in range(11)}}
    assert t.compact() and not t.compact()
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan parquet") == 1
    folder = t.snapshot()["segments"][0]["folder"]
    assert spark.read.parquet(f"{t.path}/segments/{folder}").count() == 12  # the live rows
    first = min(json.loads(t.files.read(f"commits/{n}"))["version"] for n in t.files.names("commits"))
    assert state(t.read(first)) == {"hot": 0, "k0": 0}  # older versions stay until vacuum
    t.vacuum(1)
    assert t.files.names("segments") == [folder] and state(t.read())["hot"] == 10


def test_a_run_replaced_during_compaction_is_not_lost(spark, monkeypatch):
    t = new_table(spark)
    t.write(writes(spark, [("a", 0, 1)]), "r1")
    t.write(writes(spark, [("b", 0, 2)]), "r2")
    real = KeyedTable._new_segment

    def slow(self, rows, tag):
        made = real(self, rows, tag)
        if tag == "base":
            KeyedTable(spark, t.path).write(writes(spark, [("b", 0, 3)]), "r2")
        return made

    monkeypatch.setattr(KeyedTable, "_new_segment", slow)
    assert t.compact() is False and state(t.read()) == {"a": 1, "b": 3}


def test_new_columns_and_empty_runs(spark):
    t = new_table(spark)
    with pytest.raises(ValueError):
        t.read()
    t.write(writes(spark, []), "r0")
    assert t.read().count() == 0
    t.write(writes(spark, [("a", 0, 1)]), "r1")
    got = t.write(writes(spark, [("b", 0, 2, "x")], ", note string"), "r2")
    assert {r.name: (r.v, r.note) for r in got.collect()} == {"a": (1, None), "b": (2, "x")}


def test_folder(spark):
    f = Folder(spark, tempfile.mkdtemp(prefix="folder-") + "/new")
    assert f.names() == [] and not f.exists("a") and f.create("a", "é") and not f.create("a", "2")
    assert f.read("a") == "é" and f.names() == ["a"]


# --- staged runs ------------------------------------------------------------------------------
def inputs(spark):
    t = dt.datetime(2001, 7, 31)
    msgs = spark.createDataFrame([("m1", "s", "n", "a@b", t, True)], "id string, subject string, from_name string, "
                                 "from_address string, received_at timestamp_ntz, has_attachments boolean")
    inv = "INVOICE\nInvoice No: INV-77\nInvoice Date: 03-02-2024\nVendor: Acme Ltd\nGrand Total: 1,200.50\n"
    rows = [("m1", "a1", "good.pdf", inv, b"GOOD"), ("m1", "a2", "bad.docx", "just some words", b"BAD"), ("m1", "a3", "empty.pdf", " ", b"EMPTY")]
    atts = spark.createDataFrame([(m, a, n, "application/pdf", 5000, False, x, bytearray(c)) for m, a, n, x, c in rows],
                                 "message_id string, att_id string, name string, content_type string, size long, is_inline boolean, "
                                 "ocr_text string, content binary")
    return msgs, atts


def test_a_killed_scan_goes_on_where_it_stopped(spark, monkeypatch):
    msgs, atts = inputs(spark)
    out, as_of, calls = tempfile.mkdtemp(prefix="scan-"), dt.datetime(2001, 8, 1), []
    real = pl.email_scan_outcomes

    def counted(*a, **k):
        calls.append(1)
        return real(*a, **k)

    monkeypatch.setattr(pl, "email_scan_outcomes", counted)
    with monkeypatch.context() as m:
        m.setattr(pl, "email_scan_notifications", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            pl.run_email_scan(msgs, atts, 48, as_of, out)
    assert os.path.isdir(f"{out}/containers") and not os.path.isdir(f"{out}/log")
    for _ in range(2):  # resumed, then repeated
        paths = pl.run_email_scan(msgs, atts, 48, as_of, out)
    assert len(calls) == 1  # the expensive step ran once
    stored = {(r.container, r.blob_name, bytes(r.content)) for r in spark.read.parquet(paths["containers"]).collect()}
    assert stored == {(vocab.RAW_INVOICE_CONTAINER, "good_en.pdf", b"GOOD"), (vocab.INVALID_INVOICE_CONTAINER, "bad.docx", b"BAD")} or stored == {
        (vocab.RAW_INVOICE_CONTAINER, "good_xx.pdf", b"GOOD"), (vocab.INVALID_INVOICE_CONTAINER, "bad.docx", b"BAD")}
    assert spark.read.parquet(paths["log"]).where("step_name = 'attachment_processed'").count() == 3
    pl.run_email_scan(msgs, atts, 48, as_of + dt.timedelta(minutes=1), out)
    assert spark.read.parquet(paths["log"]).where("step_name = 'workflow_completed'").count() == 2
    assert len(calls) == 2


def test_a_payload_is_written_once(spark):
    msgs, atts = inputs(spark)
    payload = random.Random(1).randbytes(400_000)  # can't be compressed
    atts = atts.withColumn("content", F.when(F.col("att_id") == "a3", F.col("content")).otherwise(F.lit(payload)))
    out = tempfile.mkdtemp(prefix="scan-")
    paths = pl.run_email_scan(msgs, atts, 48, dt.datetime(2001, 8, 1), out)
    assert sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(out) for f in names) < 2.5 * len(payload)
    assert {r.att_id: bytes(r.content) for r in spark.read.parquet(paths["containers"]).collect()} == {"a1": payload, "a2": payload}
    rows = {r.att_id: r for r in spark.read.parquet(paths["outcomes"]).collect()}
    assert len(rows) == 3 and bytes(rows["a3"].content) == b"EMPTY" and rows["a3"].container is None
    assert spark.read.parquet(paths["summary"]).first().total_attachments == 3


def test_payloads_meet_their_attachments_after_the_messages_are_chosen(spark):
    plan = pl.email_scan_outcomes(fx.messages(spark, SF_SMALL), fx.attachments_with_text(spark, SF_SMALL, payload=True), 61368,
                                  fx.AS_OF_MAIL)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in plan]
    chosen = [i for i, x in enumerate(plan) if "Join LeftSemi" in x]
    assert len(chosen) == 2
    for i in chosen:  # no text is joined below, so none is shuffled by message
        right = next(j for j in range(i + 2, len(plan)) if depth[j] == depth[i + 1])
        assert not any("Join" in x for x in plan[i + 1:right])


def test_a_log_that_was_written_but_not_marked_is_not_doubled(spark, monkeypatch):
    msgs, atts = inputs(spark)
    out, as_of = tempfile.mkdtemp(prefix="scan-"), dt.datetime(2001, 8, 1)
    real = Folder.create

    def cut(self, name, text):
        if name == "log.done":
            raise RuntimeError("killed")
        return real(self, name, text)

    with monkeypatch.context() as m:
        m.setattr(Folder, "create", cut)
        with pytest.raises(RuntimeError):
            pl.run_email_scan(msgs, atts, 48, as_of, out)
    n = spark.read.parquet(f"{out}/log").count()
    pl.run_email_scan(msgs, atts, 48, as_of, out)
    assert spark.read.parquet(f"{out}/log").count() == n == 8


def test_failed_files_keep_their_bytes(spark):
    src = fx.source_blobs(spark, SF_SMALL, fx.AS_OF_BLOB)
    texts = src.select("doc_id", F.lit("10 20").alias("original_text"), F.when(F.col("doc_id") % 2 == 0, "").otherwise("10 20").alias("ocr_text"),
                       F.encode(F.concat(F.lit("pdf "), "name"), "UTF-8").alias("original"), F.encode(F.lit("ocr"), "UTF-8").alias("ocr_output"))
    out = tempfile.mkdtemp(prefix="ocr-")
    paths = pl.run_ocr_batch(src, fx.target_blobs(spark, SF_SMALL, fx.AS_OF_BLOB), texts, 24, fx.AS_OF_BLOB, out)
    rows = spark.read.parquet(paths["containers"]).collect()
    assert {r.container for r in rows} == {vocab.OCR_TARGET_CONTAINER, vocab.OCR_FAILED_CONTAINER}
    names = {r.doc_id: r.name for r in src.collect()}
    for r in rows:
        failed = r.container == vocab.OCR_FAILED_CONTAINER
        assert failed == (r.doc_id % 2 == 0) == (r.error is not None)
        assert bytes(r.content) == (f"pdf {names[r.doc_id]}".encode() if failed else b"ocr")
    assert spark.read.parquet(paths["log"]).count() == len(rows) + 1


def test_steps_run_once(spark):
    run, made = StagedRun(spark, tempfile.mkdtemp(prefix="run-"), "r1"), []
    for _ in range(2):
        run.step("x", lambda: made.append(1))
        assert run.write("t", lambda: spark.range(3)).count() == 3
    assert made == [1] and StagedRun(spark, run.path, "r1").done("t") and not StagedRun(spark, run.path, "r2").done("t")
