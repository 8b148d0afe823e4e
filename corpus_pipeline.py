"""The corpus pipeline: each stage calls one operator on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threshmill.llm import bwt_dedup, mixing, ngram_join, packing, shared, toxicity
from threshmill.llm.tokens import default_tokenizer


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, default_tokenizer(), end_id=1)


#: (name, function of spark, docs and sf_dir); what a stage returns is written as Parquet and is the next one's docs.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity.stage),
    ("ngram_jaccard_join", ngram_join.stage),
    ("suffix_array_dedup", bwt_dedup.stage),
    ("mixing", mixing.stage),
    ("packing", pack),
]
#: SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces. What a stage has written goes when the next one has.

    Defined results: a null text counts as empty and stays one through all stages; of repeated rows one stays; other
    columns go along; of an empty table, or one from which all rows go, no pieces come.
    """
    docs = shared.table(spark, sf_dir, "documents")
    folder = shared.work_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = shared.staged(spark, docs, f"{folder}/{i}-{name}")
            if i:
                shared.remove(spark, f"{folder}/{i - 1}-{STAGES[i - 1][0]}")
    return docs
