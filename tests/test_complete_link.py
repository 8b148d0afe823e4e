"""Complete-link clusters against the edges taken one by one."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threshmill.operators import complete_link

EDGES = "a long, b long, similarity double, confidence double, eligible boolean"


def one_by_one(edges):
    """{node: name of its cluster}."""
    good = {frozenset(e[:2]) for e in edges if e[4]}
    cluster = {n: frozenset([n]) for e in edges for n in e[:2]}
    for a, b, *_ in sorted((e for e in edges if e[4]), key=lambda e: (-e[3], -e[2], e[0], e[1])):
        x, y = cluster[a], cluster[b]
        if x != y and all(frozenset((i, j)) in good for i in x for j in y):
            cluster.update(dict.fromkeys(x | y, x | y))
    return {n: min(c) for n, c in cluster.items()}


def graph(seed, n=60, groups=9):
    """Blocks of mostly linked nodes with ties, loose edges, chains, repeated and reversed rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        for j in range(i + 1, n):
            if rng.random() < (0.8 if i % groups == j % groups else 0.04):
                a, b = (i, j) if rng.random() < 0.7 else (j, i)
                out.append((a, b, round(rng.random(), 1), rng.choice([0.9, 0.95]), rng.random() < 0.9))
    out += [(i, i + 1, 1 - i / 1000, 1.0, True) for i in range(100, 107)]
    out += [(i, j, 0.99, 0.99, True) for i in range(200, 208) for j in range(i + 1, 208)]
    return out + out[:20] + [(b, a, *rest) for a, b, *rest in out[20:40]] + [(3, 3, 1.0, 1.0, True), (500, 501, 0.5, 0.5, False)]


def clusters(spark, rows, **options):
    found = complete_link.complete_link(spark.createDataFrame(rows, EDGES), **options).collect()
    assert len({r.node for r in found}) == len(found)
    sizes = Counter(r.cluster for r in found)
    assert all(r["size"] == sizes[r.cluster] for r in found)
    return {r.node: r.cluster for r in found}


@pytest.mark.parametrize("task_rows", [40, 10**6])
def test_rounds_equal_the_edges_in_order(spark, task_rows):
    rows = graph(task_rows, 30, 6)
    assert clusters(spark, rows, task_rows=task_rows) == one_by_one(rows)


def test_odd_graphs(spark):
    assert clusters(spark, []) == {}
    assert clusters(spark, [(1, 1, 1.0, 1.0, True), (2, 3, 1.0, 1.0, False)]) == {1: 1, 2: 2, 3: 3}
    path = [(1, 2, 0.9, 0.95, True), (2, 3, 0.89, 0.95, True)]
    assert clusters(spark, path) == {1: 1, 2: 1, 3: 3}
    assert clusters(spark, [*path, (1, 3, 0.88, 0.9, True)]) == {1: 1, 2: 1, 3: 1}


def test_settle_in_any_groups():
    """Tasks that know only some nodes never merge what the edges in order would not."""
    for seed in range(40):
        rng = random.Random(seed)
        rows = [e for e in graph(seed, 24, 4) if e[0] != e[1] and e[4]]
        wanted = one_by_one(rows)
        ranks = {}
        for rank, e in enumerate(sorted(rows, key=lambda e: (-e[3], -e[2], e[0], e[1]))):
            ranks.setdefault(frozenset(e[:2]), rank)
        pairs = [(x, y, r) for p, r in ranks.items() for x, y in (tuple(p), tuple(p)[::-1])]
        own = {x for x, *_ in pairs if rng.random() < 0.6}
        found = complete_link.settle([p for p in pairs if p[0] in own])
        assert set(found) == own and all(wanted[x] == wanted[top] for x, top in found.items())
        assert complete_link.settle(pairs) == {x: wanted[x] for x, *_ in pairs}


def test_no_task_holds_a_component(spark, monkeypatch):
    """Of one component, no task is given more pairs than the bound."""
    seen = []
    settled = complete_link._settled
    monkeypatch.setattr(complete_link, "_settled", lambda pairs, group, kind: (seen.extend(r["count"] for r in pairs.groupBy(group).count().collect()), settled(pairs, group, kind))[1])
    rows = graph(5, 20, 4) + [(i, 100 + i, 0.1, 0.1, True) for i in range(20)]
    assert clusters(spark, rows, task_rows=60) == one_by_one(rows)
    assert seen and max(seen) <= 60


def test_summary_and_reasons(spark):
    schema = "a string, b string, similarity double, confidence double, eligible boolean, same_intent boolean, canonical_question string"
    rows = [("a", "b", 0.95, 0.99, True, True, "q1"), ("a", "c", 0.9, 0.95, True, True, "q2"), ("b", "c", 0.89, 0.95, True, True, "q2"), ("c", "d", 0.9, 0.93, True, True, None), ("a", "d", 0.5, 0.95, False, True, "q9"), ("b", "d", 0.95, 0.95, False, False, None), ("e", "f", 0.9, 0.9, True, True, ""), ("g", "h", 0.9, 0.9, True, True, "x"), ("g", "i", 0.9, 0.9, True, True, "y"), ("h", "i", 0.9, 0.9, True, True, None), ("c", "e", 0.9, 0.9, True, True, None)]
    edges = spark.createDataFrame(rows, schema)
    found = complete_link.complete_link(edges)
    questions = spark.createDataFrame([(x, f"own {x}") for x in "abcdefghi"], "node string, question string")
    summary = {r.cluster: tuple(r)[1:] for r in complete_link.cluster_summary(edges, found, questions).collect()}
    assert summary == {"a": (3, 0.89, 0.95, "q2"), "e": (2, 0.9, 0.9, "own e"), "g": (3, 0.9, 0.9, "x")}
    reasons = {tuple(r)[:2]: tuple(r)[2:] for r in complete_link.blocked_merges(edges, found, 0.88, 0.9).collect()}
    assert reasons == {("a", "d"): (0, 1, 0, 1), ("a", "e"): (5, 0, 0, 0)}


def test_queries_over_whole_tables(spark, sf_dir):
    from threshmill.plans import registry, vectors

    edges = [tuple(r) for r in vectors.labelled_edges(spark, sf_dir).collect()]
    wanted = one_by_one(edges)
    assert {r.node: r.cluster for r in registry.QUERIES["complete_link_clusters"](spark, sf_dir).collect()} == wanted
    label = {r.vec_id: r.label for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    for r in registry.QUERIES["canonical_questions"](spark, sf_dir).collect():
        own = [e for e in edges if wanted[e[0]] == wanted[e[1]] == r.cluster]
        same = Counter(f"label {label[e[0]]}" for e in own if label[e[0]] == label[e[1]])
        assert r["size"] == sum(c == r.cluster for c in wanted.values()) > 1 and r.min_similarity == min(e[2] for e in own)
        assert same[r.canonical_question] == max(same.values(), default=0)
    blocked = registry.QUERIES["blocked_merges"](spark, sf_dir).filter(F.col("missing_pair") + F.col("relation_not_same") + F.col("low_confidence") + F.col("low_similarity") == 0)
    assert blocked.count() == 0
