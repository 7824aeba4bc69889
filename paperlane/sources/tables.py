"""Readers for the columnar input tables.

Every reader returns a lazy DataFrame; projections and filters applied later
are pushed into the parquet scan by Catalyst (``ReadSchema`` /
``PushedFilters`` in ``explain``).
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; expected one of {TABLES}")
    return spark.read.parquet(table_path(sf_dir, name))


def read_blob_files(spark: SparkSession, path: str, glob: str | None = None,
                    recursive: bool = True) -> DataFrame:
    """A1/A2 for real object stores: the ``binaryFile`` source.

    Returns ``(container, name, last_modified, size, content)``. Selecting
    only the metadata columns prunes ``content`` so a listing never reads
    payloads.

    Spark file sources skip zero-length files, so an empty blob never shows
    up here. The listing that drives a pipeline (A1) should therefore be the
    store's inventory table (parquet, read with :func:`spark.read.parquet`),
    which includes zero-byte objects; the empty-payload rule then turns them
    into error rows. Use this reader for payloads of listed blobs.
    """
    from pyspark.sql import functions as F

    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    root = path.rstrip("/") + "/"
    df = reader.load(path)
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _escape(root.split("://")[-1]), "")
    return df.select(
        F.lit(os.path.basename(path.rstrip("/"))).alias("container"),
        rel.alias("name"),
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
        F.col("content"),
    )


def _escape(s: str) -> str:
    import re
    return re.escape(s)
