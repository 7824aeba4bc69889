import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from paperlane.operators import listing as ls
from paperlane.operators import sinks as sk
from paperlane.sources.tables import read_blob_files


def test_binary_file_listing_prunes_content(spark):
    root = tempfile.mkdtemp(prefix="paperlane-blobs-")
    os.makedirs(os.path.join(root, "sub"))
    for name, data in [("a.pdf", b"%PDF-1"), ("sub/b.PDF", b"%PDF-2"), ("c.txt", b"x"), ("empty.pdf", b"")]:
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)
    listing = read_blob_files(spark, root).select("container", "name", "last_modified", "size")
    assert "content" not in listing.columns
    names = {r.name for r in ls.pdf_filter(listing).collect()}
    # file sources skip zero-length files: listings come from an inventory table (see read_blob_files)
    assert names == {"a.pdf", "sub/b.PDF"}
    payload = read_blob_files(spark, root).where(F.col("size") > 0).select("name", F.length("content").alias("n"))
    assert {r.name: r.n for r in payload.collect()}["a.pdf"] == 6


def _writes(spark, rows):
    return spark.createDataFrame(rows, "container string, name string, written_at timestamp_ntz, tiebreak double, "
                                       "v long")


def test_overwrite_by_key_last_write_wins_and_dynamic_partitions(spark):
    out = tempfile.mkdtemp(prefix="paperlane-sink-")
    t = dt.datetime(2024, 1, 1)
    sk.overwrite_by_key(_writes(spark, [("raw", "x", t, 1.0, 1), ("raw", "x", t, 2.0, 2), ("raw", "z", t, 0.0, 5),
                                        ("bad", "y", t, 0.0, 3)]), out, "run-1")
    for _ in range(2):  # a repeated run replaces its own version
        now = sk.overwrite_by_key(_writes(spark, [("raw", "x", t + dt.timedelta(1), 0.0, 4)]), out, "run-2")
    want = {("raw", "x"): 4, ("raw", "z"): 5, ("bad", "y"): 3}  # what the second run does not name stays
    assert {(r.container, r.name): r.v for r in now.collect()} == want
    assert {(r.container, r.name): r.v for r in sk.read_by_key(spark, out).collect()} == want


def test_extraction_json_keeps_earlier_documents(spark):
    out = tempfile.mkdtemp(prefix="paperlane-sink-")
    schema = "json_blob string, invoiceNumber string, total double"
    sk.write_extraction_json(spark.createDataFrame([("a.json", "1", 1.5), ("b.json", None, None)], schema), out, "run-1")
    sk.write_extraction_json(spark.createDataFrame([("a.json", "2", 2.5)], schema), out, "run-2")
    got = {r.name: r.json for r in sk.read_extraction_json(spark, out).collect()}
    assert got == {"a.json": '{"invoiceNumber":"2","total":2.5}', "b.json": "{}"}


def test_routed_payloads_by_container(spark):
    out = tempfile.mkdtemp(prefix="paperlane-sink-")
    rows = [("raw", "a", bytearray(b"1")), ("bad", "b", bytearray(b"2")), (None, "c", bytearray(b"3"))]
    for run in ("run-1", "run-2"):
        sk.route_to_containers(spark.createDataFrame(rows, "container string, blob_name string, content binary"), out, run)
    got = sorted((r.run_id, r.container, bytes(r.content)) for r in spark.read.parquet(out).collect())
    assert got == [("run-1", "bad", b"2"), ("run-1", "raw", b"1"), ("run-2", "bad", b"2"), ("run-2", "raw", b"1")]


def test_dead_letters_and_log_append(spark):
    base = tempfile.mkdtemp(prefix="paperlane-sink-")
    df = spark.createDataFrame([(1, None), (2, "boom")], "doc_id long, error string").withColumn(
        "content", F.lit(b"bytes"))
    for run in ("run-1", "run-2"):
        sk.write_with_dead_letters(df, os.path.join(base, "outcomes"), run)
    failed = sk.read_dead_letters(spark, os.path.join(base, "outcomes")).collect()
    assert sorted((r.run_id, r.doc_id, bytes(r.content)) for r in failed) == [("run-1", 2, b"bytes"), ("run-2", 2, b"bytes")]
    assert sk.read_dead_letters(spark, os.path.join(base, "outcomes"), "ok").count() == 2
    rows = sk.log_rows(df, "run-1", "OCRPipeline", "ocr_failed", "Failed", step_value=F.col("doc_id"),
                       detail=F.col("error"), logged_at=dt.datetime(2024, 1, 1))
    assert sk.append_process_log(rows, os.path.join(base, "log")) is True
    assert spark.read.parquet(os.path.join(base, "log")).count() == 2
    # a failing log write is reported, never raised
    assert sk.append_process_log(rows.withColumn("item_count", F.lit("x").cast("int") / 0), "/proc/nope") is False


def test_run_email_scan_writes_once_and_derives(spark):
    from paperlane.plans import pipelines as pl
    from paperlane.sources import fixtures as fx
    from tests.conftest import SF_SMALL

    out = tempfile.mkdtemp(prefix="paperlane-scan-")
    paths = pl.run_email_scan(fx.messages(spark, SF_SMALL), fx.attachments_with_text(spark, SF_SMALL), 61368,
                              fx.AS_OF_MAIL, out)
    outcomes = spark.read.parquet(paths["outcomes"])
    summary = spark.read.parquet(paths["summary"]).first()
    assert summary.total_attachments == outcomes.count()
    assert summary.valid_invoices == outcomes.where("is_valid").count()
    notes = spark.read.parquet(paths["notifications"])
    assert notes.count() == outcomes.select("message_id").distinct().count()
    log = spark.read.parquet(paths["log"])
    assert log.where("step_name = 'workflow_completed'").count() == 1
    assert log.where("step_name = 'attachment_processed'").count() == outcomes.count()
