"""Process-log reads: period filter, step counts, the 12-metric summary.

All period predicates are range predicates on ``logged_at`` against literals,
so the parquet scan receives them as ``PushedFilters`` (and a log table
partitioned by date is pruned). The summary is one global aggregate: a
partial aggregate per task, then a single final row, however large the log.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from paperlane import vocab


def _ts_literal(df: DataFrame, col: str, value: dt.datetime) -> Column:
    """Literal of the same timestamp flavour as ``df[col]`` (keeps the filter pushable)."""
    dtype = df.schema[col].dataType
    target = "timestamp_ntz" if isinstance(dtype, TimestampNTZType) else "timestamp"
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(target)


def validate_period(period: str) -> str:
    p = (period or "").lower().strip()
    if p not in vocab.VALID_PERIODS:
        raise ValueError(f"Invalid period '{p}'. Valid options: {sorted(vocab.VALID_PERIODS)}")
    return p


def period_predicate(df: DataFrame, period: str, as_of: dt.datetime, col: str = "logged_at") -> Column:
    """Today / yesterday are UTC calendar days of ``as_of``; the rolling
    periods have no upper bound; ``overall`` keeps everything."""
    p = validate_period(period)
    day = dt.datetime(as_of.year, as_of.month, as_of.day)
    ts = F.col(col)
    if p == "today":
        return (ts >= _ts_literal(df, col, day)) & (ts < _ts_literal(df, col, day + dt.timedelta(days=1)))
    if p == "yesterday":
        return (ts >= _ts_literal(df, col, day - dt.timedelta(days=1))) & (ts < _ts_literal(df, col, day))
    if p == "last_7_days":
        return ts >= _ts_literal(df, col, as_of - dt.timedelta(days=7))
    if p == "last_30_days":
        return ts >= _ts_literal(df, col, as_of - dt.timedelta(days=30))
    return F.lit(True)


def scan_process_log(log: DataFrame, period: str, as_of: dt.datetime) -> DataFrame:
    """The log under a period predicate."""
    return log.where(period_predicate(log, period, as_of))


def lineage_counts(log: DataFrame, period: str, as_of: dt.datetime) -> DataFrame:
    """``SUM(item_count)`` per step name under the period filter."""
    return (scan_process_log(log, period, as_of)
            .groupBy("step_name")
            .agg(F.sum("item_count").cast("bigint").alias("total")))


def lineage_summary(log: DataFrame, period: str, as_of: dt.datetime) -> DataFrame:
    """The 12 fixed metrics in one row (0 when absent; unknown steps dropped).

    One pass: every metric is a conditional sum inside a single global
    aggregate, which always yields exactly one row, even on empty input.
    """
    p = validate_period(period)
    filtered = scan_process_log(log, p, as_of).where(F.col("step_name").isin(*vocab.STEP_NAMES))
    metrics = [
        F.coalesce(F.sum(F.when(F.col("step_name") == step, F.col("item_count"))), F.lit(0))
         .cast("bigint").alias(key)
        for key, step in vocab.SUMMARY_METRICS
    ]
    return filtered.agg(*metrics).select(F.lit(p).alias("period"), *[k for k, _ in vocab.SUMMARY_METRICS])


def lineage_response(log: DataFrame, period: str, as_of: dt.datetime,
                     country_code: str | None = None, source_lang: str | None = None) -> DataFrame:
    """Summary plus the echoed (not applied) filters."""
    return lineage_summary(log, period, as_of).select(
        "*",
        F.lit(country_code).cast("string").alias("filter_country_code"),
        F.lit(source_lang).cast("string").alias("filter_source_lang"),
    )


def lineage_response_json(log: DataFrame, period: str, as_of: dt.datetime,
                          country_code: str | None = None, source_lang: str | None = None) -> DataFrame:
    """The response document as JSON (``filters`` as a nested object)."""
    summary = lineage_summary(log, period, as_of)
    metric_cols = ["period"] + [k for k, _ in vocab.SUMMARY_METRICS]
    filters = F.struct(F.lit(country_code).cast("string").alias("country_code"),
                       F.lit(source_lang).cast("string").alias("source_lang"))
    return summary.select(F.to_json(F.struct(*metric_cols, filters.alias("filters")),
                                    {"ignoreNullFields": "false"}).alias("response"))


def preview_process_log(log: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of the log; ordered so the preview is deterministic."""
    return log.orderBy(F.col("logged_at").desc(), "run_id", "step_name", "step_value").limit(n)


def workflow_step_counts(log: DataFrame, period: str, as_of: dt.datetime, with_subtotals: bool = False) -> DataFrame:
    """Totals per (workflow, step); ``rollup`` adds workflow subtotals."""
    f = scan_process_log(log, period, as_of)
    g = f.rollup("workflow_name", "step_name") if with_subtotals else f.groupBy("workflow_name", "step_name")
    return g.agg(F.sum("item_count").cast("bigint").alias("total"), F.count(F.lit(1)).alias("n_rows"))


def run_drilldown(log: DataFrame, run_id: str) -> DataFrame:
    """Rows of one run, newest first (the filter reaches the scan)."""
    return log.where(F.col("run_id") == run_id).orderBy(F.col("logged_at").desc())


def latest_step_per_run(log: DataFrame) -> DataFrame:
    """most recent step row per run.

    ``max_by`` over a struct is an aggregate with a map-side partial step,
    so a run holding a large share of the log never lands whole in one task
    (a ``row_number`` window would sort the whole run in one partition).
    """
    key = F.struct("logged_at", "step_name", "step_value", "item_count", "status", "workflow_name")
    return (log.groupBy("run_id").agg(F.max(key).alias("last"))
            .select("run_id", "last.logged_at", "last.workflow_name", "last.step_name", "last.step_value",
                    "last.item_count", "last.status"))


def run_id_for(prefix: str, ts_col) -> Column:
    """``<prefix>-YYYYMMDD-HHMMSS-ffffff`` in UTC."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.concat(F.lit(prefix + "-"), F.date_format(c, "yyyyMMdd-HHmmss-SSSSSS"))


def parse_lookback(raw, default: float, zero_means_default: bool = False) -> Column:
    """Parse a float; missing / empty / unparsable -> default.

    ``zero_means_default`` gives the mail scanner's ``hours or default`` rule (Q12).
    """
    c = F.col(raw) if isinstance(raw, str) else raw
    parsed = F.when(F.trim(c) == "", F.lit(None)).otherwise(F.when(
        F.trim(c).rlike(r"(?i)^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$"), F.trim(c).try_cast("double")))
    bad = parsed.isNull() | (parsed == 0) if zero_means_default else parsed.isNull()
    return F.when(bad, F.lit(float(default))).otherwise(parsed)
