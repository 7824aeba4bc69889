"""Structured Streaming forms of the polling jobs (K1-K6).

The reference polls on timers over look-back windows; here the same work is
incremental: file sources with checkpoints, event-time watermarks, windowed
and session aggregations whose state the watermark bounds, stream-static
anti-joins for skip logic, and ``foreachBatch`` sinks that are idempotent
per batch id. Every job has a batch twin (same function on a static
DataFrame) used as its correctness reference.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from paperlane.functions import naming as nm


def event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need ``timestamp``; parquet often carries ``timestamp_ntz``."""
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


# --- K1 --------------------------------------------------------------------------------------
def lineage_window_counts(log: DataFrame, window: str = "30 minutes", watermark: str | None = "10 minutes",
                          ts: str = "logged_at") -> DataFrame:
    """Step totals per tumbling event-time window (state dropped past the watermark)."""
    df = event_time(log, ts)
    if watermark and df.isStreaming:
        df = df.withWatermark(ts, watermark)
    return (df.groupBy(F.window(ts, window).alias("w"), "step_name")
            .agg(F.sum("item_count").cast("bigint").alias("total"), F.count(F.lit(1)).alias("n_rows"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "step_name",
                    "total", "n_rows"))


# --- K2 --------------------------------------------------------------------------------------
def new_documents(listing: DataFrame, watermark: str = "1 day", ts: str = "last_modified",
                  key=("container", "name", "last_modified")) -> DataFrame:
    """Each upload once: a blob that is listed again within the watermark is
    dropped, one that was uploaded again (a newer ``last_modified``) is not."""
    df = event_time(listing, ts)
    if df.isStreaming:
        return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(key))
    return df.dropDuplicates(list(key))


# --- K3 --------------------------------------------------------------------------------------
def skip_processed(stream: DataFrame, processed: DataFrame, target_name=nm.translated_blob_name) -> DataFrame:
    """Stream-static anti-join: only blobs whose target does not exist yet."""
    done = processed.select(F.col("name").alias("_target")).distinct()
    return (stream.withColumn("_target", target_name(F.col("name")))
            .join(done, "_target", "left_anti").drop("_target"))


def first_of_target(listing: DataFrame, ttl: str | None = "7 days", ts: str = "last_modified",
                    target_name=nm.translated_blob_name) -> DataFrame:
    """One source of each target: what the stream itself has taken on is kept as
    keyed state, so a later batch that names the same target skips it, after a
    restart too. State goes when the watermark is ``ttl`` past the source's
    time (a later upload is then taken on again, if its target isn't listed).

    The state is Spark's own (JVM, one row a target); a target that most rows
    name is one row of state and its rows are dropped as they come. Of several
    new sources of one target in one batch any is taken; the batch form takes
    the oldest, then the smallest name. ``ttl`` None: the stream has a watermark.
    """
    df = event_time(listing, ts).withColumn("_target", target_name(F.col("name")))
    if df.isStreaming:
        df = df if ttl is None else df.withWatermark(ts, ttl)
        return df.dropDuplicatesWithinWatermark(["_target"]).drop("_target")
    others = [c for c in df.columns if c not in (ts, "name", "_target")]
    first = df.groupBy("_target").agg(F.min(F.struct(ts, "name", *others)).alias("_first"))
    return first.select(*(F.col("_first")[c].alias(c) for c in df.columns if c != "_target"))


def skipping_sink(processed: Callable[[SparkSession], DataFrame], write: Callable[[DataFrame, int], None],
                  target_name=nm.translated_blob_name) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: ``processed`` lists the existing targets anew for
    each batch (a static join side is listed once, when the query starts), and
    ``write`` gets what is left."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(skip_processed(batch, processed(batch.sparkSession), target_name), batch_id)
    return run


# --- K4 --------------------------------------------------------------------------------------
def route_sink(out_dir: str, partition_col: str = "container"):
    """``foreachBatch`` writer: each micro-batch lands in its own ``batch_id``
    folder (overwrite), so a replayed batch rewrites the same files."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").partitionBy(partition_col)
         .parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}"))
    return write


# --- K5 --------------------------------------------------------------------------------------
def late_reconcile(source: DataFrame, emitted: DataFrame, key: str = "name") -> DataFrame:
    """Batch sweep: source rows the stream never emitted (late beyond the watermark)."""
    return source.join(emitted.select(key).distinct(), key, "left_anti")


# --- K6 --------------------------------------------------------------------------------------
def run_sessions(log: DataFrame, gap: str = "30 minutes", watermark: str | None = "1 hour",
                 ts: str = "logged_at", key: str = "run_id") -> DataFrame:
    """Activity sessions per run: events closer than ``gap`` form one session.

    Sessions are merged inside each input partition before the shuffle (a
    setting of :data:`paperlane.session.BASE_CONF`), so a very active run is
    pre-aggregated instead of shipping all its events to one task.
    """
    df = event_time(log, ts)
    if watermark and df.isStreaming:
        df = df.withWatermark(ts, watermark)
    return (df.groupBy(key, F.session_window(ts, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("item_count").cast("bigint").alias("items"))
            .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "n_events", "items"))
