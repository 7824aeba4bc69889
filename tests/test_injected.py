import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlane.operators.injected import (CallPolicy, apply_document_fn, schema_violations,
                                          structured_output_schema)


def test_policy_retries_then_succeeds():
    calls = {"n": 0}

    def flaky(x):
        calls["n"] += 1
        if calls["n"] < 3:
            raise IOError("busy")
        return x

    out, err, att = CallPolicy(max_attempts=3, base_delay=0.0).call(flaky, 5)
    assert (out, err, att) == (5, None, 3)
    out, err, att = CallPolicy(max_attempts=2, base_delay=0.0).call(lambda: 1 / 0)
    assert out is None and "ZeroDivisionError" in err and att == 2


def test_bad_row_is_isolated(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "boom"), (3, "fine")], "doc_id long, text string")

    def svc(b: pd.DataFrame) -> pd.DataFrame:
        if (b["text"] == "boom").any():
            raise ValueError("service rejected the document")
        return pd.DataFrame({"upper": b["text"].str.upper()})

    schema = T.StructType([T.StructField("upper", T.StringType())])
    out = {r.doc_id: r for r in apply_document_fn(df.repartition(1), svc, ["text"], schema, ["doc_id"],
                                                  CallPolicy(max_attempts=1, base_delay=0.0)).collect()}
    assert out[1].upper == "OK" and out[3].upper == "FINE"
    assert out[2].upper is None and "rejected" in out[2].error


def test_structured_output_schema():
    js = {"type": "object", "properties": {"is_invoice": {"type": "boolean"}, "reason": {"type": "string"},
                                           "items": {"type": "array", "items": {"type": "object", "properties": {
                                               "q": {"type": "number"}}}}}}
    t = structured_output_schema(js)
    assert t.simpleString() == "struct<is_invoice:boolean,reason:string,items:array<struct<q:double>>>"


def test_waits_grow_and_are_capped():
    waits = CallPolicy(max_attempts=6, base_delay=1.0, backoff=2.0, max_delay=5.0, jitter=0.2).waits()
    assert len(waits) == 5 and all(lo <= w <= min(lo * 1.2, 5.0) for lo, w in zip((1, 2, 4, 5, 5), waits))
    seen = []

    def closed():
        seen.append(1)
        raise KeyError("gone")

    assert CallPolicy(max_attempts=4, base_delay=0.0, retry_on=(OSError,)).call(closed)[2] == 1 and len(seen) == 1
    assert CallPolicy(max_attempts=0).call(closed) == (None, "no attempt made", 0)


def test_attempts_count_the_batch_too(spark):
    def svc(b: pd.DataFrame) -> pd.DataFrame:
        if len(b) > 1 or b["text"].iloc[0] == "boom":
            raise ValueError("no")
        return pd.DataFrame({"n": b["text"].str.len()})

    df = spark.createDataFrame([(1, "ok"), (2, "boom")], "doc_id long, text string").repartition(1)
    out = {r.doc_id: r for r in apply_document_fn(df, svc, ["text"], T.StructType([T.StructField("n", T.LongType())]),
                                                  ["doc_id"], CallPolicy(max_attempts=2, base_delay=0.0)).collect()}
    assert (out[1].n, out[1].attempts) == (2, 3) and (out[2].n, out[2].attempts) == (None, 4)


def test_schema_lists_required_and_enum(spark):
    item = {"type": "object", "required": ["q"], "properties": {"q": {"type": ["number", "null"]},
                                                               "kind": {"type": "string", "enum": ["a", "b"]}}}
    js = {"type": "object", "required": ["name", "items"], "properties": {
        "name": {"type": ["string", "null"]}, "size": {"type": ["string", "number"]},
        "kind": {"type": "string", "enum": ["x", None]}, "items": {"type": "array", "items": item}}}
    kind = structured_output_schema(js)
    assert kind.simpleString() == "struct<name:string,size:string,kind:string,items:array<struct<q:double,kind:string>>>"
    rows = ['{"name":"n","kind":"x","items":[{"q":1,"kind":"a"}]}', '{"kind":"y"}', '{"name":"n","items":[{"q":1},{"kind":"c"}]}']
    df = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", kind).alias("d"))
    found = df.select(F.filter(F.array(*schema_violations(F.col("d"), js)), lambda x: x.isNotNull()).alias("v")).collect()
    assert [r.v for r in found] == [[], ["missing:name", "enum:kind", "missing:items"], ["missing:items.q"]]
