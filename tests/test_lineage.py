import datetime as dt

import pytest

from paperlane.operators import lineage as lin
from paperlane.sources import fixtures as fx
from tests.conftest import SF_ORACLE


@pytest.mark.parametrize("period,expected", [("today", 84), ("yesterday", 83), ("last_7_days", 598),
                                             ("overall", 2264)])
def test_attachment_processed_counts(spark, period, expected):
    r = lin.lineage_summary(fx.process_log(spark, SF_ORACLE), period, fx.AS_OF_LOG).first()
    assert r.attachments_processed == expected and r.period == period


def test_invalid_period(spark):
    with pytest.raises(ValueError, match="Valid options"):
        lin.lineage_summary(fx.process_log(spark, SF_ORACLE), "last_year", fx.AS_OF_LOG)


def test_period_is_normalised(spark):
    r = lin.lineage_response(fx.process_log(spark, SF_ORACLE), "  TODAY ", fx.AS_OF_LOG).first()
    assert r.period == "today" and r.filter_country_code is None


def test_empty_log_gives_one_row_of_zeros(spark):
    log = fx.process_log(spark, SF_ORACLE).limit(0)
    rows = lin.lineage_summary(log, "overall", fx.AS_OF_LOG).collect()
    assert len(rows) == 1 and all(v == 0 for k, v in rows[0].asDict().items() if k != "period")


def test_filters_reach_the_scan(spark):
    df = lin.lineage_summary(fx.process_log(spark, SF_ORACLE), "today", fx.AS_OF_LOG)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_run_id_and_lookback(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("2.5",), ("",), ("abc",), ("0",)], "raw string")
    got = [r[0] for r in df.select(lin.parse_lookback("raw", 1.0)).collect()]
    assert got == [2.5, 1.0, 1.0, 0.0]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 678901),)], "t timestamp_ntz")
    assert ts.select(lin.run_id_for("ocr", F.col("t"))).first()[0] == "ocr-20240102-030405-678901"
