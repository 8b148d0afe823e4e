"""Near-duplicate vectors by PCA-ordered tiled comparison (operator 5).

1. Vectors are cleaned and packed as given, in floats or doubles, and normed in double precision where they are used;
   equal ones form one class with one representative.
2. The principal axes come from the covariance of all vectors, summed by partition. Vectors are ordered by a tree of
   medians over the leading axes and cut into tiles of some ``TILE``; a tile knows the box of its leading
   coordinates. Two tiles meet only if their boxes are no farther apart than linked vectors can be.
   The tiles are written once, and each task reads its part of both sides; no tile is copied for those it meets.
3. In a pair of tiles the products of the leading coordinates are added up first. What the rest can add is bounded by
   the product of the suffix norms; where that cannot reach the threshold the pair stops, and only live rows and
   columns go on to the next coordinates. What is left is decided by the whole cosine in double precision.
4. A task adds up each vector's number of links over all its pairs of tiles and returns it with spanning edges of the
   links, never the links themselves.

Defined results: vectors that are null, zero, empty or hold null or non-finite components link with nothing; so do
vectors of unlike lengths; copies of a row are vectors of their own and link; a null identifier is kept and never
names a component; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared
from threshmill.llm.graph import components

THRESHOLD = 0.9
TILE = 2048
#: Leading coordinates in a tile's box and in each step of a product.
BOX_AXES, STEP = 8, 16
#: Rows in the bounded sample whose medians place the cuts of the tree, and how many of them a leaf has at least.
CUT_SAMPLE, LEAF_SAMPLE = 10_000, 8
#: A product in another order of axes differs from the plain one by less than this.
SLACK = 1e-9


def _units(raw: bytes, real: type, dimension: int) -> np.ndarray:
    """Packed vectors in unit length and double precision; scaled first, so that no norm overflows."""
    x = np.frombuffer(raw, real).reshape(-1, dimension).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True, initial=0.0)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, type]:
    """(vec_id, vector), packed, or null where a vector links with nothing; and the numbers that vectors are packed in."""
    real = np.float32 if dict(vectors.dtypes)[vector_col] == "array<float>" else np.float64

    def run(batches):
        for batch in batches:
            column = batch.column("v").cast(pa.large_list(pa.from_numpy_dtype(real)))
            out = []
            for v in column:
                x = v.values.to_numpy(zero_copy_only=False) if v.is_valid and len(v) and not v.values.null_count else None
                out.append(x.tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "vector"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    return rows.mapInArrow(shared.frugal(run), "vec_id long, vector binary"), real


def principal_axes(rows: DataFrame, dimension: int, real: type) -> np.ndarray:
    """Rows: axes in falling order of variance; ``dimension`` squared numbers leave a partition, and one sum comes to the driver."""

    def squares(batches):
        total = np.zeros((dimension, dimension))
        for batch in batches:
            x = _units(b"".join(batch.column("vector").to_pylist()), real, dimension)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    def added(batches):
        total = np.zeros(dimension * dimension)
        for batch in batches:
            for s in batch.column("s"):
                total += np.frombuffer(s.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    sums = rows.select("vector").mapInArrow(shared.frugal(squares), "s binary").repartition(1).mapInArrow(added, "s binary")
    _, axes = np.linalg.eigh(np.frombuffer(sums.first().s).reshape(dimension, dimension))
    return axes.T[::-1].copy()


def _tree(points: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """Cuts (axis, place) of a balanced tree in heap order, over the axes in turn."""
    depth = max(0, int(np.ceil(np.log2(max(1, leaves)))))
    cuts: list[tuple[int, float]] = [(0, 0.0)] * ((1 << depth) - 1)
    where = np.zeros(len(points), np.int64)
    for level in range(depth):
        axis = level % BOX_AXES % points.shape[1]
        for node in range(1 << level):
            own = points[where == node, axis]
            cuts[(1 << level) - 1 + node] = (axis, float(np.median(own)) if len(own) else 0.0)
        nodes = np.array([c[1] for c in cuts[(1 << level) - 1 : (2 << level) - 1]])
        where = where * 2 + (points[:, axis] > nodes[where])
    return cuts


def _leaf(points: np.ndarray, cuts: list[tuple[int, float]]) -> np.ndarray:
    where, level = np.zeros(len(points), np.int64), 0
    while (1 << level) - 1 < len(cuts):
        row = cuts[(1 << level) - 1 : (2 << level) - 1]
        where = where * 2 + (points[:, row[0][0]] > np.array([c[1] for c in row])[where])
        level += 1
    return where


def survivors(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows of a, rows of b) whose cosine may reach the threshold; both in principal coordinates.

    Leading dimensions first: after each step the product so far plus the suffix norms bounds the whole.
    """
    for start in range(0, len(a), 512):
        x = a[start : start + 512]
        rows, cols = np.arange(len(x)), np.arange(len(b))
        product, at = np.zeros((len(x), len(b))), 0
        while at < a.shape[1]:
            till = min(a.shape[1], at + step)
            product += x[rows][:, at:till] @ b[cols][:, at:till].T
            at = till
            rest = np.sqrt((x[rows][:, at:] ** 2).sum(1))[:, None] * np.sqrt((b[cols][:, at:] ** 2).sum(1))
            alive = product + rest >= threshold - SLACK
            live_rows, live_cols = alive.any(1), alive.any(0)
            if not live_rows.any():
                break
            if live_rows.mean() * live_cols.mean() < 0.8:
                rows, cols = rows[live_rows], cols[live_cols]
                product, alive = product[np.ix_(live_rows, live_cols)], alive[np.ix_(live_rows, live_cols)]
        else:
            i, j = np.nonzero(alive)
            yield rows[i] + start, cols[j]


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, i: int) -> int:
        while self.up.setdefault(i, i) != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def compare_tiles(ids_a, sizes_a, a, ids_b, sizes_b, b, same: bool, axes: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of each row of a and of b (counted with the sizes of classes), and spanning edges; a and b are unit vectors."""
    links_a, links_b, forest = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), _Forest()
    pa_, pb = a @ axes.T, b @ axes.T
    for i, j in survivors(pa_, pb, threshold):
        if same:
            i, j = i[i < j], j[i < j]
        for s in range(0, len(i), 1 << 16):
            p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
            sure = np.einsum("ij,ij->i", a[p], b[q]) >= threshold
            p, q = p[sure], q[sure]
            np.add.at(links_a, p, sizes_b[q])
            np.add.at(links_b, q, sizes_a[p])
            # A block of links is thinned to what joins components before the forest sees it.
            roots = np.array([forest.root(x) for x in ids_a[p].tolist()]), np.array([forest.root(x) for x in ids_b[q].tolist()])
            apart = np.unique(np.stack([np.minimum(*roots), np.maximum(*roots)], 1)[roots[0] != roots[1]], axis=0)
            for x, y in apart.tolist():
                forest.join(x, y)
    return links_a, links_b, [(x, r) for x in list(forest.up) if (r := forest.root(x)) != x]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """Each row of the input as vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    shared.small_batches(spark)
    folder = shared.work_dir(spark, "embeddings")
    cleaned, real = clean(vectors, id_col, vector_col)
    rows = shared.staged(spark, cleaned, f"{folder}/rows")
    usable = rows.filter("vector is not null and vec_id is not null")
    links = edges = None
    # One run for each length of vectors that there is, as a rule a single one.
    for width, n, distinct in usable.groupBy(F.length("vector")).agg(F.count("*"), F.approx_count_distinct(F.xxhash64("vector"))).collect():
        own_links, own_edges = _links(spark, usable.filter(F.length("vector") == width), n, distinct, width // np.dtype(real).itemsize, real, threshold, f"{folder}/{width}")
        links = own_links if links is None else links.unionByName(own_links)
        edges = own_edges if edges is None else edges.unionByName(own_edges)
    if links is None:
        none = F.lit(0).cast("long")
        return rows.select("vec_id", none.alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counted = links.groupBy("rep").agg(F.sum("n").alias("n"))
    joined = components(spark, edges).withColumnRenamed("node", "rep")
    # Copies are brought together by a digest, so that vectors are not shuffled for it.
    digest = F.unhex(F.sha2("vector", 256)).alias("digest")
    classes = usable.select("vec_id", digest).groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    known = classes.join(counted, "rep", "left").join(joined, "rep", "left")
    known = known.select("digest", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("vec_id", digest).join(known, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), (F.col("vec_id").eqNullSafe(component)).alias("kept"))


def meeting(boxes: DataFrame, axes: int, reach: float) -> DataFrame:
    """Rows (column_a, column_b) of pairs of ``boxes`` (tile, lo, hi and others) that are no farther apart than ``reach``, each pair once.

    A task reads a part of each side from where the boxes are stored, so nothing is shuffled. Which of a pair is a goes by
    a hash, so that tasks are alike.
    """
    a, b = (boxes.select(*(F.col(c).alias(f"{c}_{s}") for c in boxes.columns)) for s in "ab")
    gap = lambda i: F.greatest(F.lit(0.0), F.get("lo_a", F.lit(i)) - F.get("hi_b", F.lit(i)), F.get("lo_b", F.lit(i)) - F.get("hi_a", F.lit(i)))
    apart = sum((F.pow(gap(i), F.lit(2.0)) for i in range(axes)), F.lit(0.0))
    even = F.pmod(F.hash(F.least("tile_a", "tile_b"), F.greatest("tile_a", "tile_b")), F.lit(2)) == 0
    once = F.when(even, F.col("tile_a") <= F.col("tile_b")).otherwise(F.col("tile_a") >= F.col("tile_b"))
    return a.join(b.hint("shuffle_replicate_nl"), once & (apart <= F.lit(reach * reach + SLACK)))


def tile_pairs(tiles: DataFrame, axes: int, reach: float) -> DataFrame:
    """Pairs (a, b), a <= b, of the tiles whose boxes of leading coordinates are no farther apart than ``reach``."""
    corner = lambda f: F.array(*(f(F.element_at("lead", i + 1)) for i in range(axes)))
    met = meeting(tiles.groupBy("tile").agg(corner(F.min).alias("lo"), corner(F.max).alias("hi")), axes, reach)
    return met.select(F.least("tile_a", "tile_b").alias("a"), F.greatest("tile_a", "tile_b").alias("b"))


def _links(spark: SparkSession, rows: DataFrame, n: int, distinct: int, dimension: int, real: type, threshold: float, folder: str) -> tuple[DataFrame, DataFrame]:
    axes = principal_axes(rows, dimension, real)
    leaves = min(-(-distinct // TILE), CUT_SAMPLE // LEAF_SAMPLE)
    share = min(1.0, CUT_SAMPLE / max(1, n))
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20))).select("vector").limit(2 * CUT_SAMPLE).collect()
    points = _units(b"".join({bytes(r.vector) for r in sample}), real, dimension) @ axes[:BOX_AXES].T
    cuts = _tree(points, leaves)

    def place(cells):
        """Each vector's leaf, copies of a batch once; and over how many tiles the leaf's vectors are dealt by hash."""

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    own = pa.Table.from_batches([batch]).group_by("vector").aggregate([("vec_id", "min"), ("vec_id", "count")]).combine_chunks()
                    leaf = _leaf(_units(b"".join(own["vector"].to_pylist()), real, dimension) @ axes[:BOX_AXES].T, cuts)
                    table = pa.table([pa.array(leaf), pa.array([cells.get(x, 1) for x in leaf.tolist()], pa.int64()), own["vec_id_min"], own["vec_id_count"], own["vector"]], ["leaf", "cells", "rep", "size", "vector"])
                    yield from table.to_batches()

        return rows.mapInArrow(shared.frugal(run), "leaf long, cells long, rep long, size long, vector binary")

    def pack(pdf):
        own = pdf.groupby("vector", sort=False).agg(rep=("rep", "min"), size=("size", "sum")).reset_index().sort_values("rep")
        vectors = b"".join(own["vector"])
        lead = _units(vectors, real, dimension) @ axes[:BOX_AXES].T
        return pd.DataFrame({"tile": pdf["tile"].iloc[:1], "reps": [own["rep"].tolist()], "sizes": [own["size"].tolist()], "vectors": [vectors], "lo": [lead.min(0).tolist()], "hi": [lead.max(0).tolist()]})

    in_leaf = place({}).groupBy("leaf").agg(F.approx_count_distinct(F.xxhash64("vector"))).collect()  # a row for each leaf, of which the sample bounds the number
    tile = F.col("leaf") * F.lit(1 << 32) + F.pmod(F.xxhash64("vector"), F.col("cells"))
    placed = place({leaf: -(-many // TILE) for leaf, many in in_leaf}).select(tile.alias("tile"), "rep", "size", "vector")
    packed = placed.groupBy("tile").applyInPandas(pack, "tile long, reps array<long>, sizes array<long>, vectors binary, lo array<double>, hi array<double>")
    packed = shared.staged(spark, packed, f"{folder}-packed")
    both = meeting(packed, min(BOX_AXES, dimension), float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK)

    def run(batches):
        links, forest, held = {}, _Forest(), None
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = batch.column("tile_a")[k].as_py(), batch.column("tile_b")[k].as_py()
                side = lambda s: (*(batch.column(f"{c}_{s}")[k].values.to_numpy() for c in ("reps", "sizes")), _units(batch.column(f"vectors_{s}")[k].as_py(), real, dimension))  # noqa: B023, E731
                held = held if held and held[0] == a else (a, side("a"))
                sides = held[1], held[1] if a == b else side("b")
                *counts, edges = compare_tiles(*sides[0], *sides[1], a == b, axes, threshold)
                for t, own, more in zip((a, b), sides, counts):
                    if more.any():
                        links.setdefault(t, (own[0].copy(), np.zeros(len(more), np.int64)))[1][:] += more
                for i, j in edges:
                    forest.join(i, j)
        for ids, many in links.values():
            linked = many > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(many[linked]), pa.nulls(int(linked.sum()), pa.int64())], ["rep", "n", "other"])
        if apart := [(i, r) for i in list(forest.up) if (r := forest.root(i)) != i]:
            i, r = np.array(apart, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.zeros(len(i), np.int64)), pa.array(r)], ["rep", "n", "other"])

    columns = [f"{c}_{s}" for s in "ab" for c in ("tile", "reps", "sizes", "vectors")]
    found = shared.staged(spark, both.select(*columns).mapInArrow(shared.frugal(run), "rep long, n long, other long"), f"{folder}-links")
    shared.remove(spark, f"{folder}-packed")
    return found.filter("n > 0").select("rep", "n"), found.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: links and components of all ``embeddings``."""
    return near_duplicates(shared.table(spark, sf_dir, "embeddings"))
