"""A key that holds a third of all rows: results equal a brute-force
computation, and the plans reduce the hot key before the shuffle."""
import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from paperlane.operators import lineage as lin
from paperlane.operators import listing as ls
from paperlane.operators import mail as ml


def _hot_outcomes(spark, n=30000):
    rows = [((0 if i % 3 == 0 else i), f"a{i}", i % 4 != 0) for i in range(n)]
    return spark.createDataFrame(rows, "message_id long, att_id string, is_valid boolean").repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_with_hot_message(spark):
    df = _hot_outcomes(spark)
    got = {r.message_id: (r.valid_count, r.invalid_count) for r in ml.message_rollup(df).collect()}
    pdf = df.toPandas()
    exp = pdf.groupby("message_id")["is_valid"].agg(["sum", "count"])
    assert got[0] == (int(exp.loc[0, "sum"]), int(exp.loc[0, "count"] - exp.loc[0, "sum"]))
    assert len(got) == len(exp)
    plan = _plan(ml.message_rollup(df))
    assert "partial_sum" in plan  # map-side partial aggregation before the exchange


def test_latest_write_with_hot_key(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("c", "hot" if i % 3 == 0 else f"n{i}", base + dt.timedelta(seconds=i), float(i % 7), i)
            for i in range(30000)]
    df = spark.createDataFrame(rows, "container string, name string, written_at timestamp_ntz, tiebreak double, v long")
    got = {r.name: r.v for r in ls.latest_write_per_blob(df).collect()}
    pdf = pd.DataFrame(rows, columns=["container", "name", "written_at", "tiebreak", "v"])
    exp = pdf.sort_values(["written_at", "tiebreak", "v"]).groupby("name").tail(1).set_index("name")["v"]
    assert got == exp.to_dict()
    plan = _plan(ls.latest_write_per_blob(df))
    assert "partial_max" in plan and "Window" not in plan


def test_latest_step_per_run_hot_run(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("run-hot" if i % 3 == 0 else f"run-{i % 50}", "OCRPipeline", f"s{i % 12}", None, 1, "Completed",
             base + dt.timedelta(minutes=i), None) for i in range(9000)]
    df = spark.createDataFrame(rows, "run_id string, workflow_name string, step_name string, step_value string, "
                                     "item_count int, status string, logged_at timestamp_ntz, detail string")
    got = {r.run_id: r.logged_at for r in lin.latest_step_per_run(df).collect()}
    assert got["run-hot"] == base + dt.timedelta(minutes=8997)
    assert "partial_max" in _plan(lin.latest_step_per_run(df))


def test_reconcile_with_hot_stem(spark):
    ts = dt.datetime(2024, 1, 10, 8)
    src = spark.createDataFrame([("raw", f"dir{i}/x.pdf" if i % 3 == 0 else f"y{i}.pdf", ts, 1) for i in range(3000)],
                                "container string, name string, last_modified timestamp_ntz, size long")
    tgt = spark.createDataFrame([("ocr", "x_ocr.pdf", ts, 1)] * 1000 + [("ocr", "y1_enhanced_ocr.pdf", ts, 1)],
                                "container string, name string, last_modified timestamp_ntz, size long")
    out = ls.reconcile_unprocessed(src, tgt, dt.datetime(2024, 1, 10, 12))
    names = {r.name for r in out.collect()}
    assert not any(n.endswith("/x.pdf") for n in names) and "y1.pdf" not in names
    assert len(names) == 3000 - 1000 - 1


def test_long_document_is_spread_over_tasks(spark):
    from paperlane.operators import translate as tr

    long_text = "".join(chr(97 + i % 26) for i in range(400))
    df = spark.createDataFrame([(1, long_text, "de"), (2, "short", "fr")], "doc_id long, text string, lang string")
    chunks = tr.explode_chunks(df, ["doc_id"], chunk_size=10).repartition(8, "doc_id", "chunk_idx")
    parts = chunks.where("doc_id = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1  # 40 chunks of one document land in several tasks
    dist = {r.doc_id: r.translated_text for r in
            tr.translate_distributed(df, tr.prefix_batch_translator(), ["doc_id"], chunk_size=10,
                                     num_partitions=8).collect()}
    native = {r.doc_id: r.translated_text for r in
              tr.translate_native(df, tr.prefix_translator(), chunk_size=10).collect()}
    assert dist == native and dist[1].count("[EN]") == 40
