"""Optional layers of a release, vectors and routes, and what forbids to attach them, as (gate, entity) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _gate(rows: DataFrame, gate: str, entity: str | Column) -> DataFrame:
    return rows.select(F.lit(gate).alias("gate"), (F.col(entity) if isinstance(entity, str) else entity).cast("string").alias("entity"))


def embedding_violations(chunks: DataFrame, vectors: DataFrame, dimension: int, key: str = "chunk_id", vector: str = "embedding") -> DataFrame:
    """Chunks without a vector, vectors without a chunk, repeated ones, and those of a wrong length or with values that are no numbers."""
    keys, own = chunks.select(key), vectors.select(key, vector)
    whole = F.coalesce(F.size(vector) == dimension, F.lit(False))
    sound = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    found = [
        _gate(keys.join(own.select(key), key, "left_anti"), "missing_vector", key), _gate(own.select(key).join(keys, key, "left_anti"), "foreign_vector", key),
        _gate(own.groupBy(key).count().filter("count > 1"), "repeated_vector", key), _gate(own.filter(~whole), "wrong_dimension", key), _gate(own.filter(whole & ~sound), "not_finite", key),
    ]
    return reduce(DataFrame.unionByName, found)


def missing_vectors(chunks: DataFrame, vectors: DataFrame, supplement: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Chunks that neither the vectors nor the supplement of earlier runs cover: what is still to be embedded and appended to it."""
    return chunks.join(vectors.select(key), key, "left_anti").join(supplement.select(key), key, "left_anti")


def route_violations(routes: DataFrame, links: DataFrame, active: DataFrame, model: str) -> DataFrame:
    """Of routes (video_id, video_url, model, embedding) and links (video_id, kb_id): one without the other, unlike lengths of
    vectors, addresses that are not https, another model, and links to entries that are not active."""
    both = routes.select(F.lit("routes").alias("kind")).unionByName(links.select(F.lit("links").alias("kind")))
    alone = both.agg(F.count_if(F.col("kind") == "routes").alias("routes"), F.count_if(F.col("kind") == "links").alias("links")).filter("(routes = 0) <> (links = 0)")
    lengths = routes.agg(F.min(F.size("embedding")).alias("least"), F.max(F.size("embedding")).alias("greatest")).filter("least <> greatest")
    found = [
        _gate(alone, "one_without_the_other", F.when(F.col("links") == 0, "links").otherwise("routes")), _gate(lengths, "unlike_dimensions", F.format_string("%d to %d", "least", "greatest")),
        _gate(routes.filter(~F.coalesce(F.startswith("video_url", F.lit("https://")), F.lit(False))), "not_https", "video_id"), _gate(routes.filter(~F.coalesce(F.col("model") == model, F.lit(False))), "another_model", "video_id"),
        _gate(links.join(active.select("kb_id"), "kb_id", "left_anti").select("kb_id").distinct(), "dangling_link", "kb_id"),
    ]
    return reduce(DataFrame.unionByName, found)
