"""Lineage counts from sealed days (E1, E2, E7, incrementally).

The process log is partitioned by date. :class:`SealedCounts` keeps, beside it,
the sums of each day by workflow and step, and which days are sealed: for each
sealed day the number of log rows that its sums were made of. A query over a
period of whole days reads the sums of its sealed days and the raw rows of the
open ones alone, and merges the two; the result is that of the raw log.

Rows that come late for a sealed day open it again: sealing counts each day's
rows (from Parquet footers, no column is read) and makes anew the sums of days
whose count has changed. A seal is a version of a keyed table (one commit for
all days of a run), so a crash leaves the old seals.

Scale: sums are at most (days x workflows x steps) rows; a year of log is a few
thousand rows to read in place of all its raw rows. Sealing reads the days that
it seals, each once unless rows come late.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlane.operators.keyed import KeyedTable

SUM_KEYS = ("logged_date", "workflow_name", "step_name")


class SealedCounts:
    """``log``: folder of a process log partitioned by ``logged_date``;
    ``folder``: where the sums are kept."""

    def __init__(self, spark: SparkSession, log: str, folder: str):
        self.spark, self.log = spark, log.rstrip("/")
        self.table = KeyedTable(spark, folder, keys=SUM_KEYS, order=("sealed_rows",))

    def raw(self) -> DataFrame:
        return self.spark.read.parquet(self.log)

    def _sealed(self) -> DataFrame | None:
        return None if self.table.snapshot() is None else self.table.read()

    def seal(self, before: dt.date) -> list[dt.date]:
        """Seal the days before a date that are open or have got rows since;
        returns them."""
        days = {r["logged_date"]: r["count"] for r in
                self.raw().where(F.col("logged_date") < F.lit(before)).groupBy("logged_date").count().collect()}  # a row a day
        sealed = self._sealed()
        known = {} if sealed is None else {r["logged_date"]: r["sealed_rows"] for r in sealed.groupBy("logged_date").agg(
            F.max("sealed_rows").alias("sealed_rows")).collect()}
        todo = sorted(d for d, n in days.items() if known.get(d) != n)
        if todo:
            rows = F.create_map(*(F.lit(x) for d in todo for x in (d, days[d])))
            sums = (self.raw().where(F.col("logged_date").isin(todo)).groupBy(*SUM_KEYS)
                    .agg(F.sum("item_count").cast("bigint").alias("total"), F.count(F.lit(1)).alias("n_rows"))
                    .withColumn("sealed_rows", rows[F.col("logged_date")]))
            self.table.write(sums, f"seal-{before.isoformat()}-{todo[-1].isoformat()}-{sum(days.values())}")
        return todo

    def counts(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """``(logged_date, workflow_name, step_name, total, n_rows)`` of the
        days from ``first`` to ``last`` (both included; None: no bound)."""
        def within(df: DataFrame) -> DataFrame:
            df = df if first is None else df.where(F.col("logged_date") >= F.lit(first))
            return df if last is None else df.where(F.col("logged_date") <= F.lit(last))

        columns = [*SUM_KEYS, "total", "n_rows"]
        sealed = self._sealed()
        if sealed is None:
            return self._sums(within(self.raw())).select(*columns)
        days = sorted(r[0] for r in sealed.select("logged_date").distinct().collect())  # a row a day
        open_days = self._sums(within(self.raw()).where(~F.col("logged_date").isin(days)))
        return within(sealed).select(*columns).unionByName(open_days.select(*columns))

    def _sums(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*SUM_KEYS).agg(F.sum("item_count").cast("bigint").alias("total"), F.count(F.lit(1)).alias("n_rows"))

    def step_totals(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """E1 over whole days: ``(step_name, total)``."""
        return self.counts(first, last).groupBy("step_name").agg(F.sum("total").cast("bigint").alias("total"))

    def workflow_totals(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """E7 over whole days: ``(workflow_name, step_name, total, n_rows)``."""
        return self.counts(first, last).groupBy("workflow_name", "step_name").agg(
            F.sum("total").cast("bigint").alias("total"), F.sum("n_rows").cast("bigint").alias("n_rows"))
