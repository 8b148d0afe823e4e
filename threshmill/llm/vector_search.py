"""Nearest neighbours by a block matrix join with quantised product tiles (operator 13).

1. Vectors are cleaned; equal ones form one class, which carries the k + 1 smallest identifiers of its rows. Only these
   can be among k + 1 nearest, so copies cost no products.
2. Query classes are dealt over R blocks and base classes over C groups, and each of the R x C cells is one task. A
   task holds a block of queries with a heap each, and the group's base vectors stream through it in batches.
3. A batch meets the queries in int8 product tiles. With x = s X + r (X int8, r the residual), the product x y differs
   from s t X Y by at most |s X| |r'| + |r| |y|. What cannot reach the query's k-th best so far, or while there are
   fewer than k the k-th best of what the tile's products are at least, is left out; the products of the others are recomputed in double precision, always in the order of the coordinates, so that equal
   vectors have equal scores in every tile. Nothing is approximate but the bound, so recall is 1.
4. Heaps of the groups are merged by query class, and the answer goes to all queries of the class.

Defined results: vectors that are null, zero, empty or hold null or non-finite components take no part, nor do rows with
a null identifier; vectors of unlike lengths do not meet; rows are candidates one by one even if they are repeated, and only the
query's own row is left out; ties go to the smaller identifier; a product
that overflows is infinite, and -infinity if it is no number; with fewer candidates than k all are returned; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threshmill.llm import shared

NEAREST = 20
#: Bytes of query classes in a task's memory, and of base classes that stream through a task.
QUERY_BYTES, BASE_BYTES = 1 << 25, 1 << 29
#: Queries of a product tile, and pairs recomputed at a time.
TILE, PAIRS = 1024, 1 << 16
#: Integers up to 2^24 are exact in single precision, so that many coordinates of int8 products may be added up there.
EXACT_TERMS = (1 << 24) // (127 * 127)
#: Relative room for rounding in a tile's bounds.
SLACK = 1e-5


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of the columns of x and y, added up in the order of the rows (the coordinates)."""
    out = np.zeros(x.shape[1])
    with np.errstate(over="ignore", invalid="ignore"):
        for a, b in zip(x, y):
            out += a * b
    return np.where(np.isnan(out), -np.inf, out)


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, packed doubles, product with itself) of the rows that take part."""

    def run(batches):
        for batch in batches:
            lists = batch.column("v").cast(pa.large_list(pa.float64()))
            width = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            x = pc.fill_null(lists.flatten(), float("nan")).to_numpy() + 0.0
            first = np.cumsum(width) - width
            known = ~np.asarray(batch.column("vec_id").is_null())
            for w in np.unique(width[(width > 0) & known]).tolist():
                at = np.flatnonzero((width == w) & known)
                own = x[first[at][:, None] + np.arange(w)]
                ok = np.isfinite(own).all(1) & own.any(1)
                at, own = at[ok], own[ok]
                if len(at):
                    packed = pa.array([v.tobytes() for v in own], pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), packed, pa.array(product(own.T, own.T))], ["vec_id", "vector", "own"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    return rows.mapInArrow(shared.frugal(run), "vec_id long, vector binary, own double")


class Tile:
    """Rows of vectors with their quantised form: x = top * (code / 127 + residual), where top is the largest coordinate."""

    def __init__(self, x: np.ndarray):
        self.x = np.ascontiguousarray(x.T)
        self.top = np.abs(x).max(1)
        flat = x / self.top[:, None]
        code = np.rint(flat * 127)
        self.code = code.astype(np.int8)
        room = SLACK * (1 + x.shape[1] / EXACT_TERMS)
        self.norm = np.sqrt((flat**2).sum(1))
        self.rest = np.sqrt(((flat - code / 127) ** 2).sum(1)) + room * self.norm
        self.near = np.sqrt((code**2).sum(1)) / 127


def quantised(a: Tile, b: Tile, rows: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(products, room, unit): each product of a's rows with b's rows is unit * (product +- room), the unit being a row's.

    The products of the codes are whole numbers and exact; all else is rounding, for which the room has a share.
    """
    codes_a, codes_b = a.code[rows].astype(np.float32), b.code.astype(np.float32)
    tile = codes_a[:, :EXACT_TERMS] @ codes_b[:, :EXACT_TERMS].T
    for at in range(EXACT_TERMS, codes_a.shape[1], EXACT_TERMS):
        tile += codes_a[:, at : at + EXACT_TERMS] @ codes_b[:, at : at + EXACT_TERMS].T
    most = b.top.max()
    share = b.top / most
    tile *= (share / 127**2).astype(np.float32)
    room = np.outer(a.near[rows].astype(np.float32), (b.rest * share).astype(np.float32))
    room += np.outer(a.rest[rows].astype(np.float32), (b.norm * share).astype(np.float32))
    room += np.float32(1e-30)
    with np.errstate(over="ignore"):
        return tile, room, a.top[rows] * most


class Heaps:
    """The ``k`` best (score, identifier) of each query, best first."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def push(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched, query = np.unique(query, return_inverse=True)
        k = self.id.shape[1]
        query = np.concatenate([np.repeat(np.arange(len(touched)), k), query])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((ids, -score, query))
        first = np.searchsorted(query[order], np.arange(len(touched)))
        best = order[first[:, None] + np.arange(k)]
        self.score[touched], self.id[touched] = score[best], ids[best]


def search(queries: Tile, heaps: Heaps, base: Tile, ids: np.ndarray, edges: np.ndarray) -> int:
    """Brings a batch of base rows, whose identifiers are ids[edges[j]:edges[j + 1]], into the heaps; returns how many pairs were recomputed."""
    done, k = 0, heaps.id.shape[1]
    for start in range(0, len(queries.top), TILE):
        rows = slice(start, start + TILE)
        tile, room, unit = quantised(queries, base, rows)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            least = heaps.score[rows, -1] / unit
            least = np.where(np.isfinite(unit) & (unit > 0) & ~np.isnan(least), least, -np.inf)
        if tile.shape[1] > k and not (least > -np.inf).all():
            # A heap is not full: the k-th best of what the products are at least.
            least = np.maximum(least, np.partition(tile - room, -k, axis=1)[:, -k])
        tile += room
        # Rounded down, so that nothing at the border is lost.
        i, j = np.nonzero(tile >= (least - np.abs(least) * 1e-6).astype(np.float32)[:, None])
        for s in range(0, len(i), PAIRS):
            p, q = i[s : s + PAIRS] + start, j[s : s + PAIRS]
            score = product(queries.x[:, p], base.x[:, q])
            # A pair may have fallen behind while the heaps filled.
            live = ~(score < heaps.score[p, -1])
            p, q, score = p[live], q[live], score[live]
            n = edges[q + 1] - edges[q]
            to = np.cumsum(n)
            at = np.repeat(edges[q] - (to - n), n) + np.arange(int(to[-1]) if len(to) else 0)
            if len(at):
                heaps.push(np.repeat(p, n), np.repeat(score, n), ids[at])
        done += len(i)
    return done


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of greatest inner product for each row whose identifier, as column ``vec_id``, fulfils ``is_query``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    shared.small_batches(spark)
    folder = shared.work_dir(spark, "vector-search")
    rows = shared.staged(spark, clean(vectors, id_col, vector_col), f"{folder}/rows")
    queries = rows.filter(is_query)
    asked = queries.select("vector").distinct().withColumn("query", F.monotonically_increasing_id())
    asked = shared.staged(spark, asked, f"{folder}/queries")
    # Of a class, the identifiers that may be in an answer; the limit holds before the shuffle as well.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.select("vec_id", "vector").withColumn("place", place).filter(F.col("place") <= k + 1)
    base = shared.staged(spark, few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), f"{folder}/base")
    size = lambda df: df.agg(F.coalesce(F.sum(F.length("vector")), F.lit(0))).first()[0]
    blocks = max(1, -(-size(asked) // QUERY_BYTES))
    groups = max(1, -(-size(base) // BASE_BYTES), -(-2 * shared.parallelism(spark) // blocks))

    # Each query block stands in every group's cell, each group in every block's; queries come first in a cell.
    left = asked.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)))
    left = left.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "block", F.lit(0).alias("side"), "query", "vector", F.array().cast("array<long>").alias("ids"))
    right = base.withColumn("group", F.pmod(F.xxhash64("vector", F.lit(13)), F.lit(groups)).cast("int"))
    right = right.select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("side"), F.lit(None).cast("long").alias("query"), "vector", "ids")
    cell = (F.col("block") * groups + F.col("group")).cast("int")
    cells = left.unionByName(right).select(cell.alias("cell"), F.length("vector").alias("width"), "side", "query", "vector", "ids")
    dealt = cells.repartitionById(blocks * groups, "cell").sortWithinPartitions("cell", "width", "side")

    def run(batches):
        key, asking, own, heaps = None, [], None, None

        def answers():
            n, i = (heaps.id < np.iinfo(np.int64).max).sum(1), np.concatenate([q for q, _ in asking])
            keep = np.arange(k + 1) < n[:, None]
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(i, n)), pa.array(heaps.id[keep]), pa.array(heaps.score[keep])], ["query", "vec_id", "score"])

        for batch in batches:
            cell, width, side = (batch.column(c).to_numpy() for c in ("cell", "width", "side"))
            cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (width[1:] != width[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                if key != (cell[a], width[a]):
                    if heaps is not None:
                        yield answers()
                    key, asking, own, heaps = (cell[a], width[a]), [], None, None
                part = batch.slice(a, b - a)
                x = np.frombuffer(b"".join(part.column("vector").to_pylist()), np.float64).reshape(b - a, -1)
                if side[a] == 0:
                    asking.append((part.column("query").to_numpy(), x))
                elif asking:
                    if own is None:
                        own = Tile(np.concatenate([v for _, v in asking]))
                        heaps = Heaps(len(own.top), k + 1)
                    lists = part.column("ids")
                    edges = lists.offsets.to_numpy().astype(np.int64)
                    search(own, heaps, Tile(x), lists.flatten().to_numpy(), edges - edges[0])
        if heaps is not None:
            yield answers()

    found = shared.staged(spark, dealt.mapInArrow(shared.frugal(run), "query long, vec_id long, score double"), f"{folder}/found")
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    top = found.withColumn("place", best).filter(F.col("place") <= k + 1)
    top = top.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("top"))
    answered = queries.select("vector", F.col("vec_id").alias("query_id"), "own").join(asked.join(top, "query").select("vector", "top"), "vector")
    # The query's own row is one with its identifier and its own product; without it the rest moves up.
    mine = lambda t: (t["vec_id"] == F.col("query_id")) & t["score"].eqNullSafe(F.col("own"))
    at = F.coalesce(F.try_element_at(F.filter("top", mine), F.lit(1))["place"], F.lit(k + 1))
    listed = answered.select("query_id", F.explode(F.filter("top", lambda t: t["place"] != at)).alias("t"), at.alias("at"))
    rank = F.col("t.place") - (F.col("t.place") > F.col("at")).cast("int")
    return listed.select("query_id", rank.cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"))


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the 20 nearest of all ``embeddings`` for each whose identifier is divisible by 20."""
    return nearest(shared.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
