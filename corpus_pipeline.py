"""Training-corpus pipeline: toxicity, line dedup, SimHash near-dedup,
benchmark decontamination, byte-level BPE."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperlane.llm import stages
from paperlane.llm.common import table, written

#: (name, function) in order; each takes (spark, docs, sf_dir) and returns the
#: documents it keeps, the last one their token ids.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("line_dedup", stages.drop_repeated_lines),
    ("simhash_dedup", stages.keep_one_of_each_group),
    ("decontamination", stages.drop_contaminated),
    ("byte_bpe", stages.encode_tokens),
]

#: The toxicity model and BPE are beyond SQL; tests/llm holds run() against a
#: brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and
    read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"pipeline-{name}")
    return docs
