"""Which entries an entry was merged from, over any number of merges, and the source rows that it inherits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threshmill.operators.clusters import Rounds


def merge_closure(entries: DataFrame, merges: DataFrame, id_col: str, max_rounds: int = 100) -> DataFrame:
    """(root, node, path, depth, in_cycle): each entry with itself and all that it was merged from, directly or not.

    ``merges`` holds parent, child and ``place``, by which a parent's children are ordered. A path is the list of places
    from root to node; of several paths the first in depth-first order counts, which is the least of lists. Paths grow by
    a join a round, only from nodes reached for the first time or by a smaller path. A walk round a cycle never makes a
    smaller path, so cycles end; ``in_cycle`` marks roots that were merged from themselves. Rows with a null or unknown parent
    make no path, children that are no entries are nodes as well, repeated merges count once. Each round's tables
    are written.
    """
    written = Rounds(entries.sparkSession)
    edges = merges.select("parent", "child", "place").filter("child is not null").distinct().checkpoint()
    kind = dict(edges.dtypes)["place"]
    roots = entries.select(F.col(id_col).alias("root")).filter("root is not null").distinct()
    reached = written.keep("reached0", roots.select("root", F.col("root").alias("node"), F.array().cast(f"array<{kind}>").alias("path")))
    frontier, rounds = reached, []
    for i in range(1, max_rounds + 1):
        step = frontier.join(edges, F.col("node") == F.col("parent")).select("root", F.col("child").alias("node"), F.concat("path", F.array("place")).alias("path"))
        best = written.keep("best", step.groupBy("root", "node").agg(F.min("path").alias("path")))
        rounds.append(written.keep(f"cycle{i}", best.filter("root = node").select("root")))
        known = reached.withColumnRenamed("path", "was")
        frontier = written.keep(f"frontier{i}", best.join(known, ["root", "node"], "left").filter("was is null or path < was").select("root", "node", "path"))
        if not frontier.limit(1).count():
            break
        reached = written.keep(f"reached{i}", reached.join(frontier, ["root", "node"], "left_anti").unionByName(frontier))
        written.drop(f"reached{i - 1}", f"frontier{i - 1}")
    else:
        raise RuntimeError(f"merges reach deeper than {max_rounds}")
    again = rounds[0]
    for r in rounds[1:]:
        again = again.unionByName(r)
    out = reached.join(again.distinct().withColumn("in_cycle", F.lit(True)), "root", "left")
    return out.select("root", "node", "path", F.size("path").alias("depth"), F.coalesce("in_cycle", F.lit(False)).alias("in_cycle"))


def inherited_rows(closure: DataFrame, rows: DataFrame, node_col: str, key_col: str, order_col: str) -> DataFrame:
    """The source rows of each root: of those with one key, the first along the path, and in a node by ``order_col``.

    The first is found by aggregates that are combined before the shuffle, so a root with very many rows is in no task as a whole.
    """
    own = rows.select(F.col(node_col).alias("node"), F.col(key_col).alias("_key"), F.col(order_col).alias("_order"), F.struct(*rows.columns).alias("_row"))
    met = closure.select("root", "node", "path").join(own, "node")
    first = met.groupBy("root", "_key").agg(F.min_by("_row", F.struct("path", "_order")).alias("_row"))
    return first.select("root", "_row.*")
