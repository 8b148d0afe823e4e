"""Similarity joins and searches over vectors, exact and pruned by a partition tree, in products of tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threshmill.operators import clusters
from threshmill.operators import vector_tree as tree

#: Pairs whose similarity is recomputed at a time, and pairs that leave a task at a time.
PAIRS, BATCH = 1 << 12, 1 << 18


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of rows i of a with rows j of b, each added up in the same order: equal vectors score equally in every tile."""
    out = [np.einsum("ij,ij->i", a[i[s : s + PAIRS]], b[j[s : s + PAIRS]]) for s in range(0, len(i), PAIRS)]
    return np.concatenate(out) if out else np.zeros(0)


def _ids(listed) -> np.ndarray:
    if isinstance(listed, np.ndarray) and listed.dtype.kind in "iu":
        return listed
    out = np.empty(len(listed), object)
    out[:] = listed
    return out


def _sides(batches: Iterator[pd.DataFrame]) -> tuple[list, list]:
    """The tiles of both blocks in the tree's order; those of a block with itself twice."""
    rows = pd.concat(list(batches)).sort_values(["side", "tile"])
    a, b = (list(rows[rows["side"] == s].itertuples(index=False)) for s in "ab")
    return a, b or a


def _balls(tiles: list) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([np.frombuffer(t.centre) for t in tiles]), np.array([t.radius for t in tiles])


def pairs_above(vectors: DataFrame, id_col: str, vector_col: str, threshold: float, group_col: str | None = None, *, extra: tuple[str, ...] = (), combine: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None, schema: str | None = None, edges: tuple[float, ...] = ()) -> DataFrame:
    """Pairs (id_a < id_b, similarity) with a cosine of at least ``threshold``; with a group, of different groups only.

    Vectors are put in tiles by a partition tree, and only tiles meet whose balls are near enough; a task holds two
    blocks of tiles, and only what reaches the threshold leaves it. Rows without an identifier and vectors that are null, empty or not finite take no part.

    ``combine`` may turn the pairs of a task, batch by batch and with each ``extra`` column of both sides (name_a, name_b), into
    rows of ``schema`` before they leave it. Its similarities are right to the last places; on which side of one of ``edges`` they are is exact.
    """
    extra = tuple(dict.fromkeys((*extra, *((group_col,) if group_col else ()))))
    rows = tree.usable(vectors, id_col, vector_col, *extra)
    n = rows.count()
    tiles = tree.tiled(rows, n, tree.upper_cuts(rows, n), extra)
    meet = tree.meeting(tiles, tiles, threshold, ordered=True)
    both = tree.block_pairs(meet, tiles, tiles, list(extra))
    kind, units = dict(vectors.dtypes)[id_col], tree.Tiles(None, None, tiles.width, tiles.real).units
    told = np.array(sorted({threshold, *edges}))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right = _sides(batches)
        near = tree.most(tree.gaps(*_balls(left), *_balls(right))) >= threshold
        theirs: dict = {}
        for p, own in enumerate(left):
            a, ids_a = units(own.vectors), _ids(own.ids)
            for q in np.flatnonzero(near[p]):
                other = right[q]
                if left is right and q < p:
                    continue
                if q not in theirs:
                    theirs[q] = units(other.vectors), _ids(other.ids)
                b, ids_b = theirs[q]
                sims = a @ b.T
                keep = sims >= threshold - tree.SLACK
                if left is right and p == q:
                    keep &= np.triu(np.ones_like(keep), 1)
                if group_col:
                    ours, others = _ids(getattr(own, group_col)), _ids(getattr(other, group_col))
                    keep &= (ours[:, None] != others) & pd.notna(ours)[:, None] & pd.notna(others)
                i, j = np.nonzero(keep)
                if combine is None:
                    score = _products(a, b, i, j)
                else:
                    score = sims[i, j]
                    at = np.searchsorted(told, score)
                    close = np.minimum(np.abs(score - told[np.minimum(at, len(told) - 1)]), np.abs(score - told[np.maximum(at - 1, 0)])) <= tree.SLACK
                    score[close] = _products(a, b, i[close], j[close])
                sure = score >= threshold
                i, j, score = i[sure], j[sure], score[sure]
                x, y = ids_a[i], ids_b[j]
                out = {"id_a": np.minimum(x, y), "id_b": np.maximum(x, y), "similarity": score}
                if combine is not None and extra:
                    less = np.asarray(x < y, bool)
                    for c in extra:
                        u, v = np.asarray(getattr(own, c))[i], np.asarray(getattr(other, c))[j]
                        out |= {f"{c}_a": np.where(less, u, v), f"{c}_b": np.where(less, v, u)}
                yield pd.DataFrame(out)

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks = _chunked(found(batches))
        yield from combine(chunks) if combine else chunks

    return both.groupBy("block_a", "block_b").applyInPandas(run, schema if combine else f"id_a {kind}, id_b {kind}, similarity double")


def components_above(vectors: DataFrame, id_col: str, vector_col: str, threshold: float) -> DataFrame:
    """Edges (a, b) with the components of the pairs of ``pairs_above``: of its pairs a task sends stars, no more than it has rows."""
    kind = dict(vectors.dtypes)[id_col]
    stars = lambda found: clusters.as_stars(p.rename(columns={"id_a": "a", "id_b": "b"}) for p in found)
    return pairs_above(vectors, id_col, vector_col, threshold, combine=stars, schema=f"a {kind}, b {kind}")


def counted_above(vectors: DataFrame, id_col: str, vector_col: str, edges: list[float], label_col: str | None = None) -> DataFrame:
    """(edge, pairs, same): how many pairs reach each of the rising ``edges`` but not the next, and how many of them have one label; tasks count."""

    def count(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, same = np.zeros(len(edges), np.int64), np.zeros(len(edges), np.int64)
        for pairs in found:
            at = np.searchsorted(edges, pairs["similarity"], "right") - 1
            total += np.bincount(at, minlength=len(edges))
            if label_col:
                same += np.bincount(at[(pairs[f"{label_col}_a"] == pairs[f"{label_col}_b"]).to_numpy(bool)], minlength=len(edges))
        yield pd.DataFrame({"edge": edges, "pairs": total, "same": same})

    found = pairs_above(vectors, id_col, vector_col, edges[0], extra=(label_col,) if label_col else (), combine=count, schema="edge double, pairs long, same long", edges=tuple(edges))
    return found.groupBy("edge").agg(F.sum("pairs").alias("pairs"), F.sum("same").alias("same"))


def best_above(vectors: DataFrame, id_col: str, vector_col: str, edges: list[float]) -> DataFrame:
    """(id_a, similarity): the best similarity of each vector to those with a greater id, if it reaches the least of ``edges``; tasks keep the best."""
    kind = dict(vectors.dtypes)[id_col]

    def best(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pairs in found:
            own = pairs.groupby("id_a", as_index=False)["similarity"].max()
            held = own if held is None else pd.concat([held, own]).groupby("id_a", as_index=False)["similarity"].max()
        if held is not None:
            yield held

    found = pairs_above(vectors, id_col, vector_col, edges[0], combine=best, schema=f"id_a {kind}, similarity double", edges=tuple(edges))
    return found.groupBy("id_a").agg(F.max("similarity").alias("similarity"))


def _chunked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of many frames in fewer."""
    held, size = [], 0
    for frame in frames:
        if len(frame):
            held.append(frame)
            size += len(frame)
        if size >= BATCH:
            yield pd.concat(held)
            held, size = [], 0
    if held:
        yield pd.concat(held)


def pairs_between(left: DataFrame, right: DataFrame, id_col: str, vector_col: str, threshold: float) -> DataFrame:
    """Pairs (left_id, right_id, similarity) of two tables with a cosine of at least ``threshold``; as ``pairs_above``, but no pair within a table."""
    asked, rows = tree.usable(left, id_col, vector_col), tree.usable(right, id_col, vector_col)
    m, n = asked.count(), rows.count()
    schema = f"left_id {dict(left.dtypes)[id_col]}, right_id {dict(right.dtypes)[id_col]}, similarity double"
    if not m or not n:
        return left.sparkSession.createDataFrame([], schema)
    cuts = tree.upper_cuts(rows, n)
    ours, theirs = tree.tiled(asked, m, cuts), tree.tiled(rows, n, cuts)
    if ours.width != theirs.width:
        raise ValueError("vectors of different lengths")
    side = lambda t, s: t.rows.select(F.col("tile").alias(s), F.col("ids").alias(f"ids_{s}"), F.col("vectors").alias(f"vectors_{s}"))
    both = tree.meeting(ours, theirs, threshold).join(side(ours, "a"), "a").join(side(theirs, "b"), "b")
    units = {s: tree.Tiles(None, None, t.width, t.real).units for s, t in (("a", ours), ("b", theirs))}

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        (ids_a, a), (ids_b, b) = ((_ids(row[f"ids_{s}"]), units[s](row[f"vectors_{s}"])) for s in "ab")
        i, j = np.nonzero(a @ b.T >= threshold - tree.SLACK)
        found = _products(a, b, i, j)
        sure = found >= threshold
        return pd.DataFrame({"left_id": ids_a[i[sure]], "right_id": ids_b[j[sure]], "similarity": found[sure]})

    return both.groupBy("a", "b").applyInPandas(run, schema)


def top_k(queries: DataFrame, base: DataFrame, id_col: str, vector_col: str, k: int, exclude_self: bool = True) -> DataFrame:
    """The ``k`` nearest of ``base`` for each query: query_id, id, similarity, rank; ties go to the smaller id.

    Both sides are put in tiles by one partition tree. First each tile of queries meets its nearest tiles, which gives
    each query a similarity that its k-th best reaches at least. Then it meets all tiles whose balls allow so much, and
    only candidates that reach the query's own bound leave a task, ``k`` for each query and pair of tiles at most.
    Rows that take no part are those of ``pairs_above``.
    """
    asked, rows = tree.usable(queries, id_col, vector_col), tree.usable(base, id_col, vector_col)
    n = rows.count()
    cuts = tree.upper_cuts(rows, n)
    right = tree.tiled(rows, n, cuts)
    left = right if queries is base else tree.tiled(asked, asked.count(), cuts)
    kind, asker = dict(base.dtypes)[id_col], dict(queries.dtypes)[id_col]
    units = {s: tree.Tiles(None, None, t.width, t.real).units for s, t in (("a", left), ("b", right))}
    side = lambda t, s: t.rows.select(F.col("tile").alias(s), F.col("ids").alias(f"ids_{s}"), F.col("vectors").alias(f"vectors_{s}"))

    def bound(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        best, ids_a, a = np.zeros((0, 0)), None, None
        for row in pdf.itertuples(index=False):
            if a is None:
                ids_a, a = _ids(row.ids_a), units["a"](row.vectors_a)
                best = np.empty((len(a), 0))
            sims = a @ units["b"](row.vectors_b).T
            if exclude_self:
                sims[ids_a[:, None] == _ids(row.ids_b)] = -np.inf
            best = np.concatenate([best, sims], axis=1)
            if best.shape[1] > k:
                best = np.partition(best, -k, axis=1)[:, -k:]
        floor = best.min(1) if best.shape[1] >= k else np.full(len(a), -2.0)
        floor = np.maximum(floor, -2.0) - tree.SLACK
        return pd.DataFrame({"tile": [key[0]], "floor": [floor.min()], "floors": [floor.tolist()]})

    def nearest(own, others: list, bounds: np.ndarray, names: dict) -> pd.DataFrame:
        """The ``k`` nearest of other tiles (index, tile) for a tile's queries, from the nearest tile on."""
        ids_a, a = _ids(own.ids), units["a"](own.vectors)
        floors = np.asarray(own.floors, float) if own.floors is not None else np.full(len(a), -2.0)
        i, j, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for q, other in others:
            if bounds[q] < floors.min():
                continue
            ids_b, b, place = names[q]
            sims = a @ b.T
            if exclude_self:
                sims[ids_a[:, None] == ids_b] = -np.inf
            least = floors
            if sims.shape[1] > k:  # what is behind k others of the tile is not needed, but for ties
                least = np.maximum(floors, np.partition(sims, -k, axis=1)[:, -k] - tree.SLACK)
            x, y = np.nonzero(sims >= np.maximum(least, -2.0)[:, None])
            if not len(x):
                continue
            i, j, score = np.append(i, x), np.append(j, place[y]), np.append(score, _products(a, b, x, y))
            order = np.lexsort((j, -score, i))  # places are in the order of identifiers: ties go to the smaller one
            i, j, score = i[order], j[order], score[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            last = rank == k - 1
            floors = floors.copy()
            floors[i[last]] = np.maximum(floors[i[last]], score[last] - tree.SLACK)
            i, j, score = (c[rank < k] for c in (i, j, score))
        return ids_a[i], j, score

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ours, theirs = _sides(batches)
        listed = [_ids(t.ids) for t in theirs]
        place, known = pd.factorize(np.concatenate(listed), sort=True)
        at = np.cumsum([0] + [len(x) for x in listed])
        names = {q: (x, units["b"](t.vectors), place[at[q] : at[q + 1]]) for q, (t, x) in enumerate(zip(theirs, listed))}
        known = np.asarray(known)
        tops = tree.most(tree.gaps(*_balls(ours), *_balls(theirs)))
        for own, bounds in zip(ours, tops):
            asked, j, score = nearest(own, [(q, theirs[q]) for q in np.argsort(-bounds, kind="stable")], bounds, names)
            yield pd.DataFrame({"query_id": asked, "id": known[j], "similarity": score})

    if n > tree.TILE_ROWS:
        pairs = tree.seeds(left, right, k + 1)
        known = pairs.join(side(left, "a"), "a").join(side(right, "b"), "b").groupBy("a").applyInPandas(bound, "tile long, floor double, floors array<double>").checkpoint()
        leaves = left.rows.select("tile", "leaf").join(known, "tile", "left").groupBy("leaf").agg(F.min(F.coalesce("floor", F.lit(-2.0))).alias("floor")).collect()
        meet = tree.meeting(left, right, {r.leaf: r.floor for r in leaves}, known.select("tile", "floor"))
        asking = known.select("tile", "floors")
    else:
        meet = tree.meeting(left, right, -2.0)
        asking = left.rows.select("tile", F.lit(None).cast("array<double>").alias("floors"))
    both = tree.block_pairs(meet, left, right, [], asking)
    found = both.groupBy("block_a", "block_b").applyInPandas(run, f"query_id {asker}, id {kind}, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def sweep(pairs: DataFrame, thresholds: list[float], **conditions) -> DataFrame:
    """For each threshold, how many pairs reach it, and how many with each condition; one pass."""
    marked = pairs.select("similarity", *(c.alias(n) for n, c in conditions.items()))
    rows = marked.withColumn("threshold", F.explode(F.array(*(F.lit(t) for t in thresholds))))
    over = F.col("similarity") >= F.col("threshold")
    return rows.groupBy("threshold").agg(F.sum(over.cast("long")).alias("pairs"), *(F.sum((over & F.col(n)).cast("long")).alias(n) for n in conditions))


def buckets(values: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Counts in left-closed buckets between edges, empty ones too."""
    spark = values.sparkSession
    dim = spark.createDataFrame(list(zip(range(len(edges) - 1), edges, edges[1:])), "bucket int, low double, high double")
    index = F.aggregate(F.array(*(F.lit(e) for e in edges)), F.lit(-1), lambda n, e: n + (F.col(value) >= e).cast("int"))
    counted = values.select(index.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    return dim.join(counted, "bucket", "left").select("bucket", "low", "high", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def swept(counts: DataFrame, thresholds: list[float]) -> DataFrame:
    """(threshold, pairs, same) of ``counted_above``: how many reach each threshold that any reaches."""
    rows = counts.filter("pairs > 0").withColumn("threshold", F.explode(F.array(*(F.lit(t) for t in thresholds))))
    over = F.col("edge") >= F.col("threshold")
    sums = (F.sum(F.when(over, F.col(c)).otherwise(0)).cast("long").alias(c) for c in ("pairs", "same"))
    return rows.groupBy("threshold").agg(*sums).filter("pairs > 0")


def counted_buckets(counts: DataFrame, edges: list[float]) -> DataFrame:
    """As ``buckets``, of ``counted_above``."""
    dim = counts.sparkSession.createDataFrame(list(zip(range(len(edges) - 1), edges, edges[1:])), "bucket int, low double, high double")
    return dim.join(counts.select(F.col("edge").alias("low"), "pairs"), "low", "left").select("bucket", "low", "high", F.coalesce("pairs", F.lit(0)).cast("long").alias("n"))


def centroids(vectors: DataFrame, key: str, vector_col: str) -> DataFrame:
    """Element-wise mean of each key's vectors, combined before the shuffle."""
    flat = vectors.select(key, F.posexplode(vector_col).alias("at", "x"))
    means = flat.groupBy(key, "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda r: r["x"]).alias("centroid"))
