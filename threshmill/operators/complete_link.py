"""Conservative agglomeration without a task that holds a component.

Edges are taken from best to worst, and two clusters merge only if all pairs across them are eligible edges. A pair of
clusters that may not merge never may again, so only pairs that may are kept, with the rank of their best edge. If two
clusters are each other's best partner, no merge elsewhere changes that: others only take pairs away or pass on ranks
that come later. So all such pairs can merge at once, and the result is that of the edges in order.

A round merges them, and lets clusters that hang on them by best partners be settled together in tasks of bounded size;
then the pairs are counted anew: two clusters still may merge if as many pairs are left between them as parts have met.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threshmill.operators.clusters import Rounds, number_by_range

#: Rows of pairs that a task settles.
TASK_ROWS = 500_000
#: How often pointers to best partners are doubled when clusters are dealt to tasks.
JUMPS = 3


def settle(pairs: list[tuple], linked: Callable | None = None, joined: Callable | None = None) -> dict:
    """Merges among the clusters whose pairs (x, y, rank) are all given, x being one of them: {x: name of its cluster}.

    Pairs are taken by rank. A cluster whose best partner is another's business stays as it is, and so does one whose
    best partner stays. If worse pairs are not given, ``linked`` of a cluster and others tells with which it may merge, and
    is told of merges by ``joined`` (both and their name).
    """
    near: dict = {}
    for x, y, rank in pairs:
        near.setdefault(x, {})[y] = rank
    up = {x: x for x in near}
    heap = [(rank, x, y) for x, y, rank in pairs if y not in near or x < y]
    heapq.heapify(heap)
    fixed: set = set()
    while heap:
        rank, x, y = heapq.heappop(heap)
        if near.get(x, {}).get(y) != rank:  # one of both has merged meanwhile, or the two may not merge any more
            continue
        if y not in near:
            fixed.add(x)
            continue
        if x in fixed or y in fixed:
            fixed.update((x, y))
            continue
        low, high = min(x, y), max(x, y)
        a, b = near.pop(x), near.pop(y)
        both = {p: min(a[p], b[p]) for p in a.keys() & b.keys()}
        if linked:
            for own, other in ((a, y), (b, x)):
                once = [p for p in own if p not in both and p != other]
                both |= {p: own[p] for p in (linked(other, once) if once else ())}
            joined(x, y, low)
        for p in (a.keys() | b.keys()) & near.keys():
            near[p].pop(x, None)
            near[p].pop(y, None)
            if p in both:
                near[p][low] = both[p]
        near[low] = both
        up[high] = low
        for p, r in both.items():
            heapq.heappush(heap, (r, low, p))
    out = {}
    for x in up:
        top = x
        while up[top] != top:
            top = up[top]
        out[x] = top
    return out


def moved(found: dict) -> pd.DataFrame:
    """The clusters of ``settle`` that merge."""
    parts: dict = {}
    for top in found.values():
        parts[top] = parts.get(top, 0) + 1
    rows = [(x, top, parts[top]) for x, top in found.items() if parts[top] > 1]
    return pd.DataFrame(rows, columns=["node", "cluster", "parts"])


def _settled(pairs: DataFrame, group: str, kind: str) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return moved(settle(list(pdf[["x", "y", "rank"]].itertuples(index=False, name=None))))

    return pairs.groupBy(group).applyInPandas(run, f"node {kind}, cluster {kind}, parts long")


def _merges(rounds: Rounds, pairs: DataFrame, n: int, kind: str, task_rows: int, settled: Callable | None = None) -> DataFrame:
    """(node, cluster, parts) of the clusters that merge in a round: at least the two with the best edge of all."""
    settled = settled or _settled
    if n <= task_rows:
        return settled(pairs.withColumn("root", F.lit(0)), "root", kind)
    best = pairs.groupBy("x").agg(F.min(F.struct("rank", "y")).alias("b"), F.count("*").alias("degree"))
    best = best.select("x", F.col("b.y").alias("partner"), F.col("b.rank").alias("rank"), "degree")
    back = best.select(F.col("x").alias("partner"), F.col("partner").alias("back"))
    best = best.join(back, "partner", "left").withColumn("mutual", F.col("back").eqNullSafe(F.col("x")))
    roots = rounds.keep("roots", best.select("x", "partner", "rank", "degree", "mutual", F.when(F.col("mutual"), F.least("x", "partner")).otherwise(F.col("partner")).alias("root")))
    for _ in range(JUMPS):  # each is written, else the plan doubles
        roots = rounds.keep("roots", roots.join(roots.select(F.col("x").alias("root"), F.col("root").alias("above")), "root").drop("root").withColumnRenamed("above", "root"))
    # The pair that merges comes first in its group; then what hangs on it, as far as a task holds it.
    so_far = F.sum("degree").over(Window.partitionBy("root").orderBy("rank", "x"))
    taken = rounds.keep("taken", roots.withColumn("taken", so_far <= task_rows))
    groups = taken.filter("taken").groupBy("root").agg(F.count("*").alias("members")).filter("members > 1").select("root")
    inside = taken.filter("taken").join(groups, "root").select("x", "root")
    done = settled(pairs.join(inside, "x"), "root", kind)
    alone = taken.filter("mutual").join(groups, "root", "left_anti").select(F.col("x").alias("node"), F.least("x", "partner").alias("cluster"), F.lit(2).cast("long").alias("parts"))
    return done.unionByName(alone)


def complete_link(edges: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(node, cluster, size) of all nodes of the edges (a, b, similarity, confidence, eligible).

    Edges are taken by confidence, similarity (both falling), a and b; a cluster is named by its smallest member. A pair
    is eligible if one of its rows is. Each round's tables are written.
    """
    rounds = Rounds(edges.sparkSession)
    kind = dict(edges.dtypes)["a"]
    good = edges.filter("eligible and a <> b").select("a", "b", (-F.col("confidence")).alias("_c"), (-F.col("similarity")).alias("_s"))
    ranked = number_by_range(good, "_c", "_s", "a", "b", name="rank")
    one = ranked.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.min("rank").alias("rank"))
    pairs = rounds.keep("pairs", one.unionByName(one.select(F.col("y").alias("x"), F.col("x").alias("y"), "rank")))
    names = rounds.keep("names", edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("cluster", F.col("node")))
    while n := pairs.count():
        moves = rounds.keep("moves", _merges(rounds, pairs, n, kind, task_rows))
        to = moves.select(F.col("node").alias("cluster"), F.col("cluster").alias("top"))
        names = rounds.keep("names", names.join(to, "cluster", "left").select("node", F.coalesce("top", "cluster").alias("cluster")))
        for side in "xy":
            own = moves.select(F.col("node").alias(side), F.col("cluster").alias("top"), F.col("parts").alias(f"parts_{side}"))
            pairs = pairs.join(own, side, "left").withColumns({side: F.coalesce("top", side), f"parts_{side}": F.coalesce(f"parts_{side}", F.lit(1).cast("long"))}).drop("top")
        counted = pairs.filter("x <> y").groupBy("x", "y", "parts_x", "parts_y").agg(F.count("*").alias("n"), F.min("rank").alias("rank"))
        pairs = rounds.keep("pairs", counted.filter("n = parts_x * parts_y").select("x", "y", "rank"))
    rounds.drop("pairs", "moves", "roots", "taken")
    return names.join(names.groupBy("cluster").agg(F.count("*").alias("size")), "cluster").select("node", "cluster", "size")


def cluster_summary(edges: DataFrame, clusters: DataFrame, questions: DataFrame) -> DataFrame:
    """Clusters of two or more: cluster, size, least similarity and confidence inside, and a canonical question.

    That is the most frequent ``canonical_question`` of the edges inside (of equally frequent ones that of the best
    edge), or where there is none the question of the smallest member. ``questions``: (node, question).
    """
    side = lambda s: clusters.select(F.col("node").alias(s), F.col("cluster").alias(f"c{s}"))
    inside = edges.join(side("a"), "a").join(side("b"), "b").filter("ca = cb and a <> b")
    least = inside.groupBy(F.col("ca").alias("cluster")).agg(F.min("similarity").alias("min_similarity"), F.min("confidence").alias("min_confidence"))
    place = F.struct((-F.col("confidence")).alias("c"), (-F.col("similarity")).alias("s"), "a", "b")
    named = inside.filter(F.coalesce("canonical_question", F.lit("")) != "").groupBy(F.col("ca").alias("cluster"), "canonical_question").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    modal = named.groupBy("cluster").agg(F.min_by("canonical_question", F.struct((-F.col("n")).alias("n"), "place")).alias("modal"))
    first = questions.select(F.col("node").alias("cluster"), F.col("question").alias("first"))
    whole = clusters.filter("size > 1").groupBy("cluster").agg(F.max("size").alias("size"))
    out = whole.join(least, "cluster", "left").join(modal, "cluster", "left").join(first, "cluster", "left")
    return out.select("cluster", "size", "min_similarity", "min_confidence", F.coalesce("modal", "first", F.lit("")).alias("canonical_question"))


def blocked_merges(edges: DataFrame, clusters: DataFrame, least_similarity: float, least_confidence: float) -> DataFrame:
    """Why clusters with an eligible edge between them stay apart: cluster_a < cluster_b, and of the pairs across how many are
    missing, of another relation, of low confidence or of low similarity (the first that holds). Edges carry ``same_intent``."""
    side = lambda s: clusters.select(F.col("node").alias(s), F.col("cluster").alias(f"c{s}"), F.col("size").alias(f"n{s}"))
    placed = edges.join(side("a"), "a").join(side("b"), "b").filter("ca <> cb")
    reason = F.when(~F.col("same_intent"), 1).when(F.col("confidence") < least_confidence, 2).when(F.col("similarity") < least_similarity, 3).otherwise(0)
    one = placed.groupBy(F.least("ca", "cb").alias("cluster_a"), F.greatest("ca", "cb").alias("cluster_b"), F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    one = one.agg(F.min(F.when(F.col("eligible"), 0).otherwise(reason)).alias("reason"), F.max(F.col("na") * F.col("nb")).alias("across"))
    by = one.groupBy("cluster_a", "cluster_b").agg(F.max("across").alias("across"), F.count("*").alias("known"), *(F.count_if(F.col("reason") == i).alias(n) for i, n in enumerate(("eligible", "relation_not_same", "low_confidence", "low_similarity"))))
    return by.filter("eligible > 0").select("cluster_a", "cluster_b", (F.col("across") - F.col("known")).alias("missing_pair"), "relation_not_same", "low_confidence", "low_similarity")
