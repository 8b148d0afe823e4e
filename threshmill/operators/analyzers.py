"""Pluggable model calls: analyzers and embedders behind one interface, deterministic by default."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threshmill.operators import registry

RELATIONS = ("new", "duplicate_evidence", "answer_supplement", "multi_cause", "conflict", "temporal_update", "low_value")


class Analyzer(Protocol):
    def analyze(self, issues: DataFrame, entries: DataFrame) -> DataFrame: ...


class DeterministicAnalyzer:
    """Rules alone; never calls a service."""

    def analyze(self, issues: DataFrame, entries: DataFrame) -> DataFrame:
        return registry.analyze(issues, entries)


class MockAnalyzer:
    """Takes the relation that a fixture's ``mock_relation`` asks for."""

    def analyze(self, issues: DataFrame, entries: DataFrame) -> DataFrame:
        asked = F.coalesce("mock_relation", F.lit("new")) if "mock_relation" in issues.columns else F.lit("new")
        return issues.withColumn("relation", asked).withColumn("target_kb_id", F.lit(None).cast("string")).withColumn("confidence", F.lit(1.0))


class CallableAnalyzer:
    """Calls a function on batches of issues; its relation has to be a known one. The function may reach a service."""

    def __init__(self, call: Callable[[pd.DataFrame], pd.DataFrame], retries: int = 2):
        self.call, self.retries = call, retries

    def analyze(self, issues: DataFrame, entries: DataFrame) -> DataFrame:
        call, retries = self.call, self.retries

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for attempt in range(retries + 1):
                    out = call(batch)
                    if set(out["relation"]) <= set(RELATIONS):
                        break
                    if attempt == retries:
                        raise ValueError(f"unknown relation in {set(out['relation'])}")
                yield pd.concat([batch.reset_index(drop=True), out[["relation", "target_kb_id", "confidence"]].reset_index(drop=True)], axis=1)

        schema = ", ".join(f"`{c}` {k}" for c, k in issues.dtypes) + ", relation string, target_kb_id string, confidence double"
        return issues.mapInPandas(run, schema)


def hashing_embedder(dimension: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Deterministic vectors from hashed character bigrams; a stand-in for a model, offline."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension))
        for i, text in enumerate(texts):
            for a in range(max(1, len(text) - 1)):
                h = int.from_bytes(hashlib.blake2b(text[a : a + 2].encode(), digest_size=8).digest(), "little")
                out[i, h % dimension] += 1 if h >> 63 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return embed


def embed(rows: DataFrame, text_col: str, generate: Callable[[list[str]], np.ndarray], vector_col: str = "embedding") -> DataFrame:
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(list(np.asarray(generate([t or "" for t in texts]), float)))

    return rows.withColumn(vector_col, run(text_col))


def attach_vectors(chunks: DataFrame, frozen: DataFrame, supplement: DataFrame, generate: Callable[[list[str]], np.ndarray] | None = None) -> DataFrame:
    """Vectors of chunks by kb_id and exact text from a frozen table, else by content hash from a supplement, else generated; or an error."""
    keyed = chunks.withColumn("content_sha256", F.sha2(F.encode("text", "utf-8"), 256))
    out = keyed.join(frozen.select("kb_id", "text", F.col("embedding").alias("_f")), ["kb_id", "text"], "left").join(supplement.select("content_sha256", F.col("embedding").alias("_s")), "content_sha256", "left")
    out = out.withColumn("embedding", F.coalesce("_f", "_s")).drop("_f", "_s")
    lacking = out.filter("embedding is null")
    if generate is None:
        if lacking.limit(1).count():
            raise ValueError("a chunk has no vector")
        return out
    return out.filter("embedding is not null").unionByName(embed(lacking.drop("embedding"), "text", generate))
