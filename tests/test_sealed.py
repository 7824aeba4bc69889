"""Sealed days: the same totals as the raw log, from sums and open days alone."""
import datetime as dt
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from paperlane.operators.sealed import SealedCounts
from paperlane.operators.sinks import append_process_log
from paperlane.sources import fixtures as fx

from .conftest import SF_SMALL


@pytest.fixture
def sealed(spark):
    base = tempfile.mkdtemp(prefix="sealed-")
    append_process_log(fx.process_log(spark, SF_SMALL), f"{base}/log")
    return SealedCounts(spark, f"{base}/log", f"{base}/sums")


def days(s):
    return sorted(r[0] for r in s.raw().select("logged_date").distinct().collect())


def raw_totals(s, first=None, last=None):
    rows = s.raw()
    rows = rows if first is None else rows.where(F.col("logged_date") >= F.lit(first))
    rows = rows if last is None else rows.where(F.col("logged_date") <= F.lit(last))
    return {(r[0], r[1]): (r[2], r[3]) for r in rows.groupBy("workflow_name", "step_name").agg(F.sum("item_count"), F.count(F.lit(1))).collect()}


def totals(s, first=None, last=None):
    return {(r.workflow_name, r.step_name): (r.total, r.n_rows) for r in s.workflow_totals(first, last).collect()}


def test_totals_of_any_period(sealed):
    every = days(sealed)
    periods = [(None, None), (every[0], every[-1]), (every[2], every[2]), (every[-3], None), (None, every[1]), (every[1], every[-2])]
    assert [totals(sealed, *p) for p in periods] == [raw_totals(sealed, *p) for p in periods]  # nothing sealed yet
    assert sealed.seal(every[-2]) == every[:-2] and sealed.seal(every[-2]) == []
    assert [totals(sealed, *p) for p in periods] == [raw_totals(sealed, *p) for p in periods]
    assert sealed.seal(every[-1]) == [every[-2]]
    assert [totals(sealed, *p) for p in periods] == [raw_totals(sealed, *p) for p in periods]


def test_only_open_days_are_read_raw(sealed):
    every = days(sealed)
    sealed.seal(every[-1])
    plan = sealed.step_totals()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2  # the sums, and the log with a filter on its partitions
    assert re.search(r"PartitionFilters: \[[^\]]*NOT logged_date", plan)  # folders of sealed days aren't opened
    assert sealed.counts().where(F.col("logged_date") < F.lit(every[-1])).count() == sealed.table.read().count()


def test_late_rows_open_a_day_again(spark, sealed):
    every = days(sealed)
    sealed.seal(every[-1])
    late = fx.process_log(spark, SF_SMALL).limit(3).withColumn("logged_at", F.lit(dt.datetime.combine(every[0], dt.time(9))).cast("timestamp_ntz"))
    append_process_log(late, sealed.log)
    assert sealed.seal(every[-1]) == [every[0]]
    assert totals(sealed) == raw_totals(sealed) and totals(sealed, every[0], every[0]) == raw_totals(sealed, every[0], every[0])


def test_a_crash_while_sealing_leaves_the_old_seals(sealed, monkeypatch):
    every = days(sealed)
    sealed.seal(every[2])
    with monkeypatch.context() as m:
        m.setattr(type(sealed.table), "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            sealed.seal(every[-1])
    assert totals(sealed) == raw_totals(sealed)
    assert sealed.seal(every[-1]) == every[2:-1] and totals(sealed) == raw_totals(sealed)
