"""Duplicate groups, connected components and order-dependent clustering."""

from __future__ import annotations

import heapq
import itertools
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Edges that a task turns into stars at a time, and stars that meet in one task.
STAR_ROWS, TASK_EDGES = 1 << 20, 2_000_000


def set_checkpoint_dir(spark: SparkSession) -> None:
    """The folder that the session names; one of this machine's only where all run on it, as in tests."""
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="threshmill-")
        spark.sparkContext.setCheckpointDir(folder)


class Rounds:
    """Tables of a run of rounds, each written below the checkpoint folder and read back.

    A checkpoint keeps the estimated size of its plan, which each join multiplies, so after some rounds the driver cannot
    hold the number; a table that is read back has the size of its files. What a table's name stood for before is removed.
    """

    def __init__(self, spark: SparkSession):
        set_checkpoint_dir(spark)
        self.spark, self.at, self.paths = spark, itertools.count(), {}
        self.folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/rounds-{uuid.uuid4().hex[:12]}"

    def keep(self, name: str, table: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}-{next(self.at)}"
        table.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(table.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for path in (self.paths.pop(n) for n in names if n in self.paths):
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def number_by_range(rows: DataFrame, *order: str, name: str = "row_no") -> DataFrame:
    """Adds 1, 2, 3 ... in the given order: rows are dealt by range and each range counted, so no task has all rows.

    The ranges come from a sample, so they are written (a reliable checkpoint) before they are counted and numbered.
    """
    set_checkpoint_dir(rows.sparkSession)
    dealt = rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()).checkpoint()
    sizes = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.join(F.broadcast(sizes.select("_p", before.alias("_b"))), "_p")  # a row for each range
    return placed.withColumn(name, F.col("_b") + F.row_number().over(Window.partitionBy("_p").orderBy(*order))).drop("_p", "_b")


def exact_groups(rows: DataFrame, key: Column, order: str, name: str = "group_no") -> DataFrame:
    """Rows whose key occurs more than once, numbered by the key's order.

    Groups are counted and numbered by ranges, so no task numbers all; a group's own rows are ranked together.
    """
    keyed = rows.withColumn("_key", key)
    groups = keyed.groupBy("_key").agg(F.count("*").alias("group_size")).filter("group_size > 1")
    numbered = number_by_range(groups, "_key", name=name)
    return keyed.join(numbered, "_key").drop("_key").withColumn("group_rank", F.row_number().over(Window.partitionBy(name).orderBy(order)))


def stars(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of edges (x, y) as stars: the least node of each, and every other node beside it."""
    codes, names = pd.factorize(np.concatenate([x, y]), sort=True)
    p, q = codes[: len(x)], codes[len(x) :]
    label = np.arange(len(names))
    while True:
        low, high = np.minimum(label[p], label[q]), np.maximum(label[p], label[q])
        open_ = low < high
        if not open_.any():
            break
        p, q = p[open_], q[open_]
        np.minimum.at(label, high[open_], low[open_])
        while not np.array_equal(above := label[label], label):
            label = above
    others = np.flatnonzero(label != np.arange(len(names)))
    return np.asarray(names)[label[others]], np.asarray(names)[others]


def as_stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (a, b) of a partition as stars; what is held grows with its nodes, not with its edges."""
    held, size = [], 0
    for batch in batches:
        held.append(batch[["a", "b"]])
        size += len(batch)
        if size > STAR_ROWS:
            whole = pd.concat(held)
            a, b = stars(whole["a"].to_numpy(), whole["b"].to_numpy())
            held, size = [pd.DataFrame({"a": a, "b": b})], 0
    if held:
        whole = pd.concat(held)
        a, b = stars(whole["a"].to_numpy(), whole["b"].to_numpy())
        yield pd.DataFrame({"a": a, "b": b})


def connected_components(edges: DataFrame, nodes: DataFrame | None = None, max_rounds: int = 50) -> DataFrame:
    """(node, component) of edges (a, b), and lone nodes if given; a component is named by its least node.

    Each partition turns its edges into stars, so no more edges are written than partitions have nodes; stars meet in
    fewer and fewer partitions of at most ``TASK_EDGES`` until one is left. Where they do not shrink any more, or nodes
    are neither numbers nor strings, rounds of least labels with pointer jumping do the rest.
    """
    spark = edges.sparkSession
    set_checkpoint_dir(spark)
    kind = dict(edges.dtypes)["a"]
    own = edges.select("a", "b").filter("a <> b")
    lone = nodes.toDF("node").distinct() if nodes is not None else None
    plain = kind in ("tinyint", "smallint", "int", "bigint", "string") and dict(edges.dtypes)["b"] == kind
    if not plain:
        return _labels_by_rounds(own, lone, max_rounds)
    meet = lambda df: df.mapInPandas(as_stars, f"a {kind}, b {kind}").checkpoint()
    own = meet(own)
    size, parts = own.count(), own.rdd.getNumPartitions()
    while parts > 1 and size:
        parts = -(-size // TASK_EDGES)
        own = meet(own.repartition(parts) if parts > 1 else own.coalesce(1))
        before, size = size, own.count()
        if parts > 1 and size > 0.75 * before:
            return _labels_by_rounds(own, lone, max_rounds)
    found = own.select(F.col("b").alias("node"), F.col("a").alias("component"))
    found = found.unionByName(own.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
    if lone is None:
        return found
    return lone.join(found, "node", "full_outer").select("node", F.coalesce("component", "node").alias("component"))


def _labels_by_rounds(edges: DataFrame, nodes: DataFrame | None, max_rounds: int) -> DataFrame:
    """Each round takes the least label around a node, then that label's own label, so labels travel twice as far each
    time. Each round's labels are written."""
    rounds = Rounds(edges.sparkSession)
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    ids = both.select(F.col("a").alias("node"))
    ids = (ids.unionByName(nodes) if nodes is not None else ids).distinct()
    labels = rounds.keep("labels", ids.withColumn("component", F.col("node")))
    for _ in range(max_rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        stepped = labels.join(near, labels["node"] == near["a"], "left").select("node", "component", F.least("component", F.coalesce("near", "component")).alias("new"))
        up = stepped.select(F.col("node").alias("at"), F.col("new").alias("above"))
        jumped = rounds.keep("labels", stepped.join(up, stepped["new"] == up["at"], "left").select("node", "component", F.least("new", "above").alias("new")))
        moved = jumped.filter("new <> component").limit(1).count()
        labels = jumped.select("node", F.col("new").alias("component"))
        if not moved:
            return labels
    raise RuntimeError("components did not converge")


def single_link(rows: DataFrame, edges: DataFrame, id_col: str, *order: Column) -> DataFrame:
    """Rows with their component, its representative (first in the order) and whether the row is it."""
    parts = connected_components(edges, rows.select(id_col))
    joined = rows.join(parts.withColumnRenamed("node", id_col), id_col)
    by = Window.partitionBy("component").orderBy(*order, id_col)
    return joined.withColumn("representative", F.first(id_col).over(by)).withColumn("is_representative", F.row_number().over(by) == 1)


def dedup_decisions(linked: DataFrame, known_hits: DataFrame, id_col: str) -> DataFrame:
    """kept, in_group or known: a representative that duplicates known entries takes its whole group with it."""
    hit = known_hits.select(F.col(id_col).alias("representative"), F.lit(True).alias("rep_known"))
    own = known_hits.select(id_col, F.lit(True).alias("known"))
    out = linked.join(hit, "representative", "left").join(own, id_col, "left")
    return out.withColumn("decision", F.when(F.coalesce("known", "rep_known", F.lit(False)), "known").when(~F.col("is_representative"), "in_group").otherwise("kept"))


def greedy_keep(rows: DataFrame, edges: DataFrame, id_col: str, order_col: str, rounds: int = 12) -> DataFrame:
    """Rows that stay if, in order, a row goes when it is linked with one that stays: (id, kept).

    Decided by rounds over all edges from earlier to later rows: a row goes as soon as an earlier neighbour is known to
    stay, and stays once all earlier ones are known to go; edges from rows that go, and to rows that are decided, fall out.
    Long chains take many rounds, so what ``rounds`` leave undecided is settled component by component; an edge from a
    row that stays has been used by then, so only undecided rows meet in a task. Rounds are cut by reliable checkpoints.
    """
    set_checkpoint_dir(rows.sparkSession)
    kind = dict(rows.dtypes)[id_col]
    ranked = rows.select(F.col(id_col).alias("node"), F.struct(F.col(order_col).alias("rank"), F.col(id_col).alias("id")).alias("place"))
    both = edges.select("a", "b").filter("a <> b").distinct()
    placed = both.join(ranked.select(F.col("node").alias("a"), F.col("place").alias("pa")), "a").join(ranked.select(F.col("node").alias("b"), F.col("place").alias("pb")), "b")
    first = F.col("pa") < F.col("pb")
    ahead = placed.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("b")).distinct().checkpoint()
    linked = ahead.select(F.col("a").alias("node")).unionByName(ahead.select(F.col("b").alias("node"))).distinct()
    state = linked.withColumn("kept", F.lit(None).cast("boolean")).checkpoint()
    for _ in range(rounds):
        facts = ahead.join(state.select(F.col("node").alias("a"), "kept"), "a").groupBy(F.col("b").alias("node"))
        facts = facts.agg(F.coalesce(F.bool_or("kept"), F.lit(False)).alias("some_kept"), F.count_if(F.col("kept").isNull()).alias("open"))
        now = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.coalesce("some_kept", F.lit(False)), False).when(F.coalesce("open", F.lit(0)) == 0, True)
        state = state.join(facts, "node", "left").select("node", now.alias("kept")).checkpoint()
        waiting = state.filter("kept is null").select(F.col("node").alias("b"))
        gone = state.filter("not kept").select(F.col("node").alias("a"))
        ahead = ahead.join(waiting, "b", "left_semi").join(gone, "a", "left_anti").checkpoint()
        if not ahead.limit(1).count():
            break
    hit = ahead.join(state.filter("kept").select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node"), F.lit(True).alias("hit")).distinct()
    state = state.join(hit, "node", "left").select("node", F.when(F.col("hit"), False).otherwise(F.col("kept")).alias("kept")).checkpoint()
    open_nodes = state.filter("kept is null").select("node")
    ahead = ahead.join(open_nodes.withColumnRenamed("node", "a"), "a", "left_semi").join(open_nodes.withColumnRenamed("node", "b"), "b", "left_semi").checkpoint()
    rest = state.filter("kept is null").select("node")
    decided = state.filter("kept is not null")
    if rest.limit(1).count():
        parts = connected_components(ahead, rest)
        near = ahead.groupBy(F.col("b").alias("node")).agg(F.collect_set("a").alias("near"))
        full = rest.join(parts, "node").join(near, "node", "left").join(ranked, "node").select("component", "node", "near", F.col("place.rank").alias("rank"))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            stay: set = set()
            out = []
            for node, own in pdf.sort_values(["rank", "node"])[["node", "near"]].itertuples(index=False):
                kept = own is None or stay.isdisjoint(own)
                if kept:
                    stay.add(node)
                out.append((node, kept))
            return pd.DataFrame(out, columns=["node", "kept"])

        decided = decided.unionByName(full.groupBy("component").applyInPandas(run, f"node {kind}, kept boolean"))
    out = rows.select(id_col).join(decided.withColumnRenamed("node", id_col), id_col, "left")
    return out.select(id_col, F.coalesce("kept", F.lit(True)).alias("kept"))


def best_matching(pairs: list[tuple]) -> list[tuple]:
    """The matching of greatest total score of (left, right, score) with scores above 0: by the shortest augmenting paths of sparse min-cost flow.

    A left row may also stay alone at score 0, so all rows but the taken ones are reached by one search for each left row.
    """
    best: dict[tuple, float] = {}
    for left, right, score in pairs:
        best[left, right] = max(score, best.get((left, right), score))
    lefts, rights = sorted({l for l, _ in best}), sorted({r for _, r in best})
    at = {r: j for j, r in enumerate(rights)}
    top = max(best.values(), default=0.0)
    near: list[list[tuple[int, float]]] = [[] for _ in lefts]
    place = {l: i for i, l in enumerate(lefts)}
    for (left, right), score in sorted(best.items()):
        near[place[left]].append((at[right], top - score))
    for i, own in enumerate(near):  # staying alone: a right side of its own
        own.append((len(rights) + i, top))
    n = len(rights) + len(lefts)
    price, owner, partner = [0.0] * n, [-1] * n, [-1] * len(lefts)
    paid = [0.0] * len(lefts)  # what a matched left row's own edge costs
    for start in range(len(lefts)):
        # Dijkstra over right rows with reduced costs, until one that is free.
        length: dict[int, float] = {}
        came: dict[int, int] = {}
        done: set[int] = set()
        heap: list[tuple[float, int]] = []
        i, gone, end = start, 0.0, -1
        while end < 0:
            base = 0.0 if i == start else paid[i] - price[partner[i]]
            for j, cost in near[i]:
                if j not in done:
                    to = gone + cost - price[j] - base
                    if to < length.get(j, float("inf")):
                        length[j], came[j] = to, i
                        heapq.heappush(heap, (to, j))
            while True:
                gone, j = heapq.heappop(heap)
                if j not in done:
                    break
            if owner[j] < 0:
                end = j
            else:
                done.add(j)
                i = owner[j]
        for j in done:
            price[j] += length[j] - gone
        j = end
        while True:
            i = came[j]
            before = partner[i]
            owner[j], partner[i] = i, j
            paid[i] = next(cost for k, cost in near[i] if k == j)
            if i == start:
                break
            j = before
    return [(lefts[i], rights[j], best[lefts[i], rights[j]]) for i, j in enumerate(partner) if j < len(rights)]


def bipartite_match(pairs: DataFrame, key: str, least: float = 0.35) -> DataFrame:
    """Within each key, the matching of left and right rows of greatest total score, of pairs scoring at least ``least``.

    Matchings never cross a component of the scored pairs, so components are worked on apart. A component's pairs are in
    one task; README gives figures.
    """
    set_checkpoint_dir(pairs.sparkSession)
    kinds = dict(pairs.dtypes)
    schema = f"{key} {kinds[key]}, left_id {kinds['left_id']}, right_id {kinds['right_id']}, score double"
    node = lambda side: F.concat_ws(":", F.lit("r" if side == "right_id" else "l"), F.length(F.col(key).cast("string")), key, side)
    good = pairs.filter((F.col("score") >= least) & (F.col("score") > 0) & ~F.isnan("score")).select(key, "left_id", "right_id", F.col("score").cast("double").alias("score"), node("left_id").alias("_left"), node("right_id").alias("_right")).checkpoint()
    parts = connected_components(good.select(F.col("_left").alias("a"), F.col("_right").alias("b")))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = best_matching(list(pdf[["left_id", "right_id", "score"]].itertuples(index=False, name=None)))
        return pd.DataFrame([(pdf[key].iloc[0], *m) for m in found], columns=[key, "left_id", "right_id", "score"])

    placed = good.join(parts, good["_left"] == parts["node"]).select("component", key, "left_id", "right_id", "score")
    return placed.groupBy("component").applyInPandas(run, schema)
