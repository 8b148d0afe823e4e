"""Connected components of links between documents, wholly distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared

MAX_ROUNDS = 60


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b), component being the smallest node reachable.

    Alternates large-star and small-star steps until no edge changes, which takes about log of the nodes many rounds.
    A round is two joins whose minima are combined before the shuffle; a hub's edges are split by the skew join. Each
    round is written to the shared folder, so lineage stays short and no round depends on a lost executor.
    """
    folder = shared.work_dir(spark, "components")
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    pairs = shared.staged(spark, pairs, f"{folder}/0")
    state = _state(pairs)
    for i in range(1, MAX_ROUNDS):
        if not state[0]:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(pairs.filter("false")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        pairs = shared.staged(spark, small, f"{folder}/{i}")
        shared.remove(spark, f"{folder}/{i - 1}")
        now = _state(pairs)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not converge")
    heads = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads)


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
