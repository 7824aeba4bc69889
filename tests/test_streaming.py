"""Structured Streaming jobs against their batch twins."""
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from paperlane.sources import fixtures as fx
from paperlane.streaming import jobs as sj
from tests.streaming_util import start_to_memory
from tests.conftest import SF_SMALL


def _events_stream(spark):
    d = tempfile.mkdtemp(prefix="paperlane-stream-")
    shutil.copy(os.path.join(SF_SMALL, "events.parquet"), os.path.join(d, "part-0.parquet"))
    schema = spark.read.parquet(d).schema
    return d, spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)


def test_stream_lineage_counts_matches_batch_up_to_watermark(spark):
    d, ev = _events_stream(spark)
    stream = sj.lineage_window_counts(fx.process_log_from(ev))
    start_to_memory(stream, "k1_out", os.path.join(d, "_ckpt_k1"))
    got = {(r.window_start, r.step_name): r.total for r in spark.table("k1_out").collect()}
    batch = sj.lineage_window_counts(fx.process_log(spark, SF_SMALL), watermark=None)
    exp = {(r.window_start, r.step_name): r.total for r in batch.collect()}
    assert got and set(got) <= set(exp)
    assert all(exp[k] == v for k, v in got.items())
    # append mode only emits windows closed by the watermark: the last ones stay open
    max_end = batch.agg(F.max("window_end")).first()[0]
    missing = set(exp) - set(got)
    assert all(k[0] >= max_end - __import__("datetime").timedelta(minutes=40) for k in missing)


def test_stream_sessions_match_batch(spark):
    d, ev = _events_stream(spark)
    stream = sj.run_sessions(fx.process_log_from(ev))
    start_to_memory(stream, "k6_out", os.path.join(d, "_ckpt_k6"))
    got = {(r.run_id, r.session_start): (r.n_events, r.items) for r in spark.table("k6_out").collect()}
    exp = {(r.run_id, r.session_start): (r.n_events, r.items)
           for r in sj.run_sessions(fx.process_log(spark, SF_SMALL), watermark=None).collect()}
    assert got and all(exp.get(k) == v for k, v in got.items())


def test_stream_dedup_skip_and_idempotent_route(spark):
    d = tempfile.mkdtemp(prefix="paperlane-stream-")
    listing = fx.source_blobs(spark, SF_SMALL, as_of=None).select("container", "name", "last_modified", "size")
    listing.write.parquet(os.path.join(d, "in", "a"))
    listing.write.parquet(os.path.join(d, "in", "b"))  # the same blobs listed twice
    src = spark.readStream.schema(listing.schema).parquet(os.path.join(d, "in", "*"))
    new = sj.new_documents(src)
    todo = sj.skip_processed(new, fx.translated_blobs(spark, SF_SMALL))
    out = os.path.join(d, "routed")
    q = (todo.writeStream.foreachBatch(sj.route_sink(out)).option("checkpointLocation", os.path.join(d, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    written = spark.read.parquet(out)
    exp = sj.skip_processed(listing.dropDuplicates(["container", "name"]), fx.translated_blobs(spark, SF_SMALL))
    assert written.count() == exp.count()
    assert written.select("name").distinct().count() == written.count()
    # replaying batch 0 rewrites the same folder instead of adding rows
    b0 = written.where("batch_id = 0").drop("batch_id")
    replay = spark.createDataFrame(b0.collect(), b0.schema)  # a copy: the sink overwrites its own folder
    sj.route_sink(out)(replay, 0)
    assert spark.read.parquet(out).count() == exp.count()
