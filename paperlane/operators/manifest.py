"""A manifest of targets laid out for the anti-joins of D1 and D2.

The targets of a container are a bucketed table: each listing is added once,
dealt into a fixed number of buckets by its join key. A reconciliation or skip
check then deals and sorts only the worklist, by the same buckets; the manifest,
which holds all targets ever written, is read in place without an exchange. The
scan takes the two columns it needs and, for D1, one day's rows.

Defined cases: the first listing makes the table, an empty one too; listings
may overlap (an anti-join takes a key that stands there twice as one); an
unnamed blob (null) has no target and stays in the worklist.
"""
from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlane.functions import naming as nm
from paperlane.operators.listing import pdf_filter, same_utc_day_filter


class TargetManifest:
    """The manifest in folder ``path``, which all executors share. Another
    session opens it again by the same path and number of buckets."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1024):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = "manifest_" + hashlib.sha256(self.path.encode()).hexdigest()[:20]

    def open(self) -> DataFrame:
        """The manifest's rows; a session that doesn't know the table yet learns
        its layout. Files that other sessions added are seen."""
        if not self.spark.catalog.tableExists(self.table):
            self.spark.sql(f"""CREATE TABLE {self.table} (stem_key STRING, name_key STRING, last_modified TIMESTAMP)
                USING parquet OPTIONS (path '{self.path}')
                CLUSTERED BY (stem_key) SORTED BY (stem_key) INTO {self.buckets} BUCKETS""")
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def add(self, targets: DataFrame) -> None:
        """Adds a listing ``(name, last_modified, ...)`` of the target container.
        One task writes each bucket, so a listing adds a file for each at most."""
        self.open()
        rows = pdf_filter(targets).select(nm.strip_ocr_suffix(F.col("name")).alias("stem_key"),
                                          F.col("name").alias("name_key"), F.col("last_modified").cast("timestamp"))
        (rows.repartition(self.buckets, "stem_key").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "stem_key").sortBy("stem_key").option("path", self.path).saveAsTable(self.table))

    def without_target(self, worklist: DataFrame, key, since: dt.datetime | None = None) -> DataFrame:
        """The rows of ``worklist`` whose ``key`` has no target; with ``since``
        only targets of that UTC day count."""
        have = self.open()
        if since is not None:
            have = same_utc_day_filter(have, since)
        return (worklist.withColumn("stem_key", key)
                .join(have.select("stem_key").hint("merge"), "stem_key", "left_anti").drop("stem_key"))

    def reconcile(self, source: DataFrame, as_of: dt.datetime, normalize_keys: bool = False) -> DataFrame:
        """The day's source PDFs without an OCR output of the day."""
        key = F.lower(nm.path_stem(nm.base_name(F.col("name"))))
        return self.without_target(pdf_filter(same_utc_day_filter(source, as_of)),
                                   nm.normalize_blob_name(key) if normalize_keys else key, as_of)
