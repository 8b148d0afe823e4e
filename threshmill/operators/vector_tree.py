"""A partition tree over vectors: tiles with bounding balls, and the pairs of tiles that their balls allow.

The upper cuts of the tree are fitted on a bounded sample and deal all rows into leaves. A leaf's rows are dealt by hash
into chunks of bounded size, and each chunk is cut on in a task of its own until its tiles hold at most ``TILE_ROWS``
rows. A cut is the widest gap among the middle half, along the line between two far points. A tile knows its ball, the centre and radius of its unit vectors. Two tiles hold a pair of
similarity s only if the gap between their balls is at most sqrt(2 - 2 s); leaves are compared first, by balls round
their tiles, and then the tiles of the leaves that are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threshmill.operators.clusters import set_checkpoint_dir

#: Rows of a tile; a task multiplies two tiles at a time.
TILE_ROWS = 2048
#: Rows of the sample that places the upper cuts, and how many of them a leaf has at least.
SAMPLE_ROWS, LEAF_SAMPLE = 20_000, 40
#: Bytes of vectors that one task cuts into tiles.
CHUNK_BYTES = 64 << 20
#: Blocks that the tiles are dealt to, and bytes of vectors that a block holds at most: a task multiplies two blocks.
BLOCKS, BLOCK_BYTES = 12, 32 << 20
#: Room for rounding in a bound.
SLACK = 1e-9


def units(vectors) -> np.ndarray:
    """Rows in unit length; a zero vector stays zero."""
    v = vectors.astype(np.float64) if isinstance(vectors, np.ndarray) and vectors.ndim == 2 else np.stack([np.asarray(x, np.float64) for x in vectors])
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(n == 0, 1, n)


def _cut(points: np.ndarray) -> tuple[np.ndarray, float]:
    """A direction between two far points, and the widest gap along it among the middle half, so that clusters stay whole."""
    far = points[np.argmax(((points - points.mean(0)) ** 2).sum(1))]
    other = points[np.argmax(((points - far) ** 2).sum(1))]
    along = other - far
    place = np.sort(points @ along)
    low = len(place) // 4
    middle = place[low : max(low + 2, len(place) - low)]
    if len(middle) < 2:
        return along, float(place[0])
    at = int(np.argmax(np.diff(middle)))
    return along, float((middle[at] + middle[at + 1]) / 2)


def fit(points: np.ndarray, depth: int) -> list[tuple[np.ndarray, float]]:
    """Cuts (direction, place) of a tree of ``depth`` levels, in heap order."""
    cuts: list[tuple[np.ndarray, float]] = []
    parts = [points]
    for _ in range(depth):
        below = []
        for own in parts:
            along, place = _cut(own) if len(own) else (np.zeros(points.shape[1]), 0.0)
            cuts.append((along, place))
            right = own @ along > place
            below += [own[~right], own[right]]
        parts = below
    return cuts


def leaf_of(points: np.ndarray, cuts: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """The leaf of each point."""
    at = np.zeros(len(points), np.int64)
    for _ in range((len(cuts) + 1).bit_length() - 1):
        for node in np.unique(at):
            own = np.flatnonzero(at == node)
            along, place = cuts[node]
            at[own] = 2 * node + 1 + (points[own] @ along > place)
    return at - len(cuts)


def split(points: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """Indexes of points in parts of at most ``rows``; equal points are cut anyhow."""
    todo = [np.arange(len(points))]
    while todo:
        own = todo.pop()
        if len(own) <= rows:
            yield own
            continue
        along, place = _cut(points[own])
        right = points[own] @ along > place
        if not right.any() or right.all():
            right = np.arange(len(own)) >= len(own) // 2
        todo += [own[right], own[~right]]


@dataclass
class Tiles:
    """``rows``: (tile, leaf, n, ids, vectors, centre, radius, extras). ``leaves``: number, centre and radius of each leaf.

    Vectors are as given, in ``real`` numbers of four or eight bytes; ``units`` has their unit vectors."""

    rows: DataFrame
    leaves: pd.DataFrame
    width: int
    real: type = np.float64
    n: int = 0

    def units(self, vectors: bytes) -> np.ndarray:
        return units(np.frombuffer(vectors, self.real).reshape(-1, self.width))

    def blocks(self) -> DataFrame:
        """(tile, block): runs of tiles in the tree's order, as many as ``BLOCKS`` or as their bytes ask for."""
        rows = max(1, min(max(TILE_ROWS, -(-self.n // BLOCKS)), BLOCK_BYTES // (8 * self.width)))
        before = F.sum("n").over(Window.partitionBy("leaf").orderBy("tile")) - F.col("n")
        sizes = self.rows.groupBy("leaf").agg(F.sum("n").alias("size")).orderBy("leaf").collect()  # a row for each leaf, of which the sample bounds the number
        starts, at = [], 0
        for leaf, size in sizes:
            starts.append((leaf, at))
            at += size
        placed = self.rows.select("tile", "leaf", "n").withColumn("before", before).join(F.broadcast(self.rows.sparkSession.createDataFrame(starts, "leaf long, start long")), "leaf")
        return placed.select("tile", F.floor((F.col("start") + F.col("before")) / rows).alias("block"))

    def balls(self) -> DataFrame:
        """The balls of each leaf's tiles, packed in a row."""
        ball = F.struct("tile", "n", "centre", "radius")
        return self.rows.groupBy("leaf").agg(F.sort_array(F.collect_list(ball)).alias("balls"))


def usable(vectors: DataFrame, id_col: str, vector_col: str, *extra: str) -> DataFrame:
    """(id, v, extras) of the rows that take part: with an identifier and a vector, not empty, of finite components."""
    v = F.col(vector_col) if dict(vectors.dtypes)[vector_col] == "array<float>" else F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.coalesce((F.size(v) > 0) & finite & F.col(id_col).isNotNull(), F.lit(False))).select(F.col(id_col).alias("id"), v.alias("v"), *extra)


def upper_cuts(rows: DataFrame, n: int) -> list[tuple[np.ndarray, float]]:
    """Cuts for ``n`` rows of ``usable``; none if they fit in a tile."""
    leaves = max(1, min(-(-n // TILE_ROWS), SAMPLE_ROWS // LEAF_SAMPLE))
    depth = (leaves - 1).bit_length()
    if not depth:
        return []
    share = min(1.0, SAMPLE_ROWS / n)
    sample = rows.filter(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20))).select("v").limit(2 * SAMPLE_ROWS).toPandas()
    points = units(sample["v"]) if len(sample) else np.zeros((0, 1))
    return fit(points, depth) if len(points) else []


def tiled(rows: DataFrame, n: int, cuts: list[tuple[np.ndarray, float]], extra: tuple[str, ...] = ()) -> Tiles:
    """All ``n`` rows of ``usable`` in tiles. All vectors have one length, else this is an error."""
    spark = rows.sparkSession
    set_checkpoint_dir(spark)
    kinds = dict(rows.dtypes)
    real = np.float32 if kinds["v"] == "array<float>" else np.float64
    widths = [r[0] for r in rows.select(F.size("v")).distinct().limit(2).collect()]
    if len(widths) > 1:
        raise ValueError("vectors of different lengths")
    width = widths[0] if widths else 1
    if cuts:

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(leaf=leaf_of(units(batch["v"]), cuts))

        dealt = rows.mapInPandas(place, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", leaf long").checkpoint()
        sizes = dealt.groupBy("leaf").count().collect()  # a row for each leaf, of which the sample bounds the number
    else:
        dealt, sizes = rows.withColumn("leaf", F.lit(0).cast("long")), [(0, n)]
    chunks = {leaf: -(-size * width * 8 // CHUNK_BYTES) for leaf, size in sizes if size * width * 8 > CHUNK_BYTES}
    many = F.create_map(*(F.lit(x).cast("long") for pair in chunks.items() for x in pair)) if chunks else None
    parts = F.coalesce(F.try_element_at(many, F.col("leaf")), F.lit(1).cast("long")) if chunks else F.lit(1).cast("long")
    salted = dealt.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(11)), parts))
    lists = "".join(f", `{c}` array<{kinds[c]}>" for c in extra)
    schema = f"tile long, leaf long, n long, ids array<{kinds['id']}>, vectors binary, centre binary, radius double{lists}"

    def tile_up(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        points, leaf, chunk = units(pdf["v"]), int(pdf["leaf"].iloc[0]), int(pdf["chunk"].iloc[0])
        out = []
        for i, at in enumerate(split(points, TILE_ROWS)):
            own = points[at]
            raw = np.stack([np.asarray(x, real) for x in pdf["v"].iloc[at]])
            centre = own.mean(0)
            radius = float(np.sqrt(((own - centre) ** 2).sum(1).max()))
            out.append(((leaf << 40) | (chunk << 20) | i, leaf, len(at), pdf["id"].iloc[at].tolist(), raw.tobytes(), centre.tobytes(), radius, *(pdf[c].iloc[at].tolist() for c in extra)))
        return pd.DataFrame(out, columns=["tile", "leaf", "n", "ids", "vectors", "centre", "radius", *extra])

    tiles = salted.groupBy("leaf", "chunk").applyInPandas(tile_up, schema)
    if not cuts:
        return Tiles(tiles.checkpoint() if chunks or n > TILE_ROWS else tiles, pd.DataFrame([(0, np.zeros(width), 1.0)], columns=["leaf", "centre", "radius"]), width, real, n)
    tiles = Tiles(tiles.checkpoint(), pd.DataFrame(), width, real, n)

    def round_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for leaf, balls in batch.itertuples(index=False):
                centres = np.stack([np.frombuffer(b["centre"]) for b in balls])
                middle = centres.mean(0)
                far = (np.sqrt(((centres - middle) ** 2).sum(1)) + [b["radius"] for b in balls]).max()
                yield pd.DataFrame({"leaf": [leaf], "centre": [middle.tobytes()], "radius": [far]})

    leaves = tiles.balls().mapInPandas(round_tiles, "leaf long, centre binary, radius double").toPandas()
    tiles.leaves = leaves.assign(centre=[np.frombuffer(c) for c in leaves["centre"]])
    return tiles


def gaps(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """The least distance between points of two balls, for all pairs of balls."""
    apart = (a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * a @ b.T
    return np.maximum(0, np.sqrt(np.maximum(apart, 0)) - ra[:, None] - rb - 1e-7)


def most(gap: np.ndarray) -> np.ndarray:
    """The greatest similarity at a distance."""
    return 1 - gap**2 / 2 + SLACK


def meeting(a: Tiles, b: Tiles, least: dict[int, float] | float, floors: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """Pairs (a, b) of tiles that may hold a similarity of at least ``least``; ``ordered``: of one set of tiles, each pair once.

    The bound may differ by leaf of ``a`` and, with ``floors`` (tile, floor), by tile. Leaves are compared in the
    driver, for their number is bounded; tiles where the lists of two leaves' balls meet.
    """
    spark = a.rows.sparkSession
    if not (len(a.leaves) and len(b.leaves)):
        return spark.createDataFrame([], "a long, b long")
    top = most(gaps(np.stack(a.leaves["centre"]), a.leaves["radius"].to_numpy(), np.stack(b.leaves["centre"]), b.leaves["radius"].to_numpy()))
    limit = np.array([least.get(x, -2.0) for x in a.leaves["leaf"]]) if isinstance(least, dict) else np.full(len(a.leaves), least)
    i, j = np.nonzero(top >= limit[:, None])
    pairs = pd.DataFrame({"leaf_a": a.leaves["leaf"].to_numpy()[i], "leaf_b": b.leaves["leaf"].to_numpy()[j]})
    if ordered:
        pairs = pairs[pairs["leaf_a"] <= pairs["leaf_b"]]
    if pairs.empty:
        return spark.createDataFrame([], "a long, b long")
    left = a.rows.select("leaf", "tile", "n", "centre", "radius")
    left = left.join(floors, "tile", "left") if floors is not None else left.withColumn("floor", F.lit(None).cast("double"))
    left = left.groupBy(F.col("leaf").alias("leaf_a")).agg(F.sort_array(F.collect_list(F.struct("tile", "n", "centre", "radius", "floor"))).alias("balls_a"))
    right = b.balls().select(F.col("leaf").alias("leaf_b"), F.col("balls").alias("balls_b"))
    both = spark.createDataFrame(pairs).join(left, "leaf_a").join(right, "leaf_b").select("leaf_a", "leaf_b", "balls_a", "balls_b")
    flat = -2.0 if isinstance(least, dict) else least

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for leaf_a, leaf_b, x, y in batch.itertuples(index=False):
                side = lambda balls: (np.stack([np.frombuffer(r["centre"]) for r in balls]), np.array([r["radius"] for r in balls]), np.array([r["tile"] for r in balls]))
                (ca, ra, ta), (cb, rb, tb) = side(x), side(y)
                floor = np.array([flat if r["floor"] is None else r["floor"] for r in x])
                near = most(gaps(ca, ra, cb, rb)) >= floor[:, None]
                if ordered and leaf_a == leaf_b:
                    near &= ta[:, None] <= tb
                p, q = np.nonzero(near)
                yield pd.DataFrame({"a": ta[p], "b": tb[q]})

    return both.mapInPandas(run, "a long, b long")


def seeds(a: Tiles, b: Tiles, rows: int) -> DataFrame:
    """For each tile of ``a`` the nearest tiles, of the nearest leaf of ``b``, that hold at least ``rows`` rows, if there are so many: (a, b)."""
    spark = a.rows.sparkSession
    if not (len(a.leaves) and len(b.leaves)):
        return spark.createDataFrame([], "a long, b long")
    apart = ((np.stack(a.leaves["centre"])[:, None] - np.stack(b.leaves["centre"])) ** 2).sum(2)
    pairs = pd.DataFrame({"leaf_a": a.leaves["leaf"].to_numpy(), "leaf_b": b.leaves["leaf"].to_numpy()[apart.argmin(1)]})
    left = a.balls().select(F.col("leaf").alias("leaf_a"), F.col("balls").alias("balls_a"))
    right = b.balls().select(F.col("leaf").alias("leaf_b"), F.col("balls").alias("balls_b"))
    both = spark.createDataFrame(pairs).join(left, "leaf_a").join(right, "leaf_b").select("balls_a", "balls_b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x, y in batch.itertuples(index=False):
                centres, sizes = np.stack([np.frombuffer(r["centre"]) for r in y]), np.array([r["n"] for r in y])
                for own in x:
                    order = np.argsort(((centres - np.frombuffer(own["centre"])) ** 2).sum(1), kind="stable")
                    few = order[: int(np.searchsorted(np.cumsum(sizes[order]), rows)) + 1]
                    yield pd.DataFrame({"a": own["tile"], "b": [y[i]["tile"] for i in few]})

    return both.mapInPandas(run, "a long, b long")


def block_pairs(meet: DataFrame, a: Tiles, b: Tiles, columns: list[str], asking: DataFrame | None = None) -> DataFrame:
    """The tiles of each pair of blocks of which tiles meet: (block_a, block_b, side, tile, ids, vectors, centre, radius, columns).

    A block of its own pair comes as side a alone if ``a`` is ``b``. So a tile is sent once for each block that its own
    meets, not for each tile. ``asking`` (tile, floor, floors) goes with the tiles of side a.
    """
    own = a is b
    left = a.blocks()
    right = left if own else b.blocks()
    name = lambda df, s: df.select(F.col("tile").alias(s), F.col("block").alias(f"block_{s}"))
    pairs = meet.join(name(left, "a"), "a").join(name(right, "b"), "b").select("block_a", "block_b").distinct().checkpoint()
    wide = lambda t, blocks, s: t.rows.join(blocks, "tile").select(F.col("block").alias(f"block_{s}"), F.lit(s).alias("side"), "tile", "ids", "vectors", "centre", "radius", *columns)
    sides = [pairs.join(wide(a, left, "a"), "block_a"), (pairs.filter("block_a <> block_b") if own else pairs).join(wide(b, right, "b"), "block_b")]
    if asking is not None:
        none = [F.lit(None).cast(t).alias(c) for c, t in asking.dtypes if c != "tile"]
        sides = [sides[0].join(asking, "tile", "left"), sides[1].select("*", *none)]
    both = sides[0].unionByName(sides[1])
    return both.repartition(max(1, min(4096, 2 * pairs.count())), "block_a", "block_b")
