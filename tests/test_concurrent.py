import threading
import time

import pandas as pd
from pyspark.sql import types as T

from paperlane.operators.injected import CallPolicy, Limits, _Calls, apply_concurrently

ONCE = CallPolicy(max_attempts=1, base_delay=0.0)


def test_calls_overlap_and_keep_their_order():
    busy, most, lock = 0, 0, threading.Lock()

    def slow(i):
        nonlocal busy, most
        with lock:
            busy += 1
            most = max(most, busy)
        time.sleep(0.02 + 0.03 * (i % 3 == 0))
        with lock:
            busy -= 1
        return {"v": i}

    began = time.monotonic()
    got = list(_Calls(slow, ONCE, Limits(at_once=5)).outcomes(range(1, 51)))
    assert [r["v"] for r, _, _ in got] == list(range(1, 51)) and most == 5
    assert time.monotonic() - began < 1.0  # 1.5 s one by one


def test_a_call_past_its_deadline_costs_its_own_row():
    def hangs(i):
        time.sleep(1.0 if i == 3 else 0.01)
        return {"v": i}

    began = time.monotonic()
    got = list(_Calls(hangs, ONCE, Limits(at_once=2, deadline=0.2)).outcomes(range(1, 9)))
    assert time.monotonic() - began < 0.9
    assert [(r or {}).get("v") for r, _, _ in got] == [1, 2, None, 4, 5, 6, 7, 8]
    assert got[2][1] == "deadline: no result in 0.2 s" and got[2][2] is None


def test_given_up_calls_are_bounded():
    alive, most, lock = 0, 0, threading.Lock()

    def hangs(i):
        nonlocal alive, most
        with lock:
            alive += 1
            most = max(most, alive)
        time.sleep(0.15)
        with lock:
            alive -= 1

    got = list(_Calls(hangs, ONCE, Limits(at_once=2, deadline=0.05)).outcomes(range(1, 9)))
    assert len(got) == 8 and most <= 4 and all(e.startswith("deadline") for _, e, _ in got)


def test_stop_after_failures_in_a_row():
    seen = []

    def down(i):
        seen.append(i)
        if i != 2:
            raise OSError("down")
        return {"v": i}

    got = list(_Calls(down, ONCE, Limits(at_once=1, stop_after=3)).outcomes(range(1, 11)))
    assert seen == [1, 2, 3, 4, 5] and got[1][0] == {"v": 2}
    assert [e for _, e, _ in got[5:]] == ["not called: 3 failures in a row"] * 5


def test_rows_in_spark(spark):
    df = spark.createDataFrame(pd.DataFrame({"doc_id": range(40), "text": ["ab"] * 39 + [None]})).coalesce(1)

    def service(row, client):
        if row["doc_id"] == 5:
            time.sleep(2)
        return {"n": len(row["text"] or "") + client}

    out = apply_concurrently(df, service, ["doc_id", "text"], T.StructType([T.StructField("n", T.LongType())]),
                             ["doc_id"], ONCE, Limits(deadline=0.5), make_client=lambda: 1, chunk=7).collect()
    assert [r.doc_id for r in out] == list(range(40))
    assert [r.n for r in out] == [3] * 5 + [None] + [3] * 33 + [1]
    assert out[5].error.startswith("deadline") and all(r.error is None for r in out if r.doc_id != 5)
    empty = apply_concurrently(df.limit(0), service, ["doc_id", "text"], T.StructType([T.StructField("n", T.LongType())]),
                               ["doc_id"], ONCE, make_client=lambda: 1)
    assert empty.collect() == []
