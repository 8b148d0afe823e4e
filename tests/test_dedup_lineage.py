"""Three-tier deduplication and merge lineage against plain loops."""

import random

import numpy as np
from pyspark.sql import functions as F

from threshmill.operators import dedup, lineage

ROWS = "id long, place long, text string, vector array<double>"


def by_loop(rows, existing, threshold):
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    firsts, kept, out = {}, [], {}
    for i, _, text, vector in sorted(rows, key=lambda r: (r[1], r[0])):
        text = text or ""
        vector = firsts.setdefault(text, vector)
        near = lambda v: vector is not None and v is not None and unit(vector) @ unit(v) >= threshold
        exact = next((k for k, t, _ in kept if t == text), None)
        close = next((k for k, _, v in kept if near(v)), None)
        entry = next((k for k, v in sorted(existing) if near(v)), None)
        out[i] = ("exact", exact) if exact is not None else ("near", close) if close is not None else ("existing", entry) if entry is not None else ("kept", None)
        if out[i][0] == "kept":
            kept.append((i, text, vector))
    return out


def test_two_runs_equal_one(spark, tmp_path):
    rng = random.Random(3)
    texts = [f"t{k}" for k in range(60)] + [None, ""]
    vectors = {t or "": [rng.gauss(0, 1) for _ in range(3)] for t in texts} | {"t5": None}
    rows = [(i, (i * 37) % 101, t, vectors[t or ""]) for i, t in enumerate(rng.choices(texts, k=150))]
    existing = [(1000 + k, [rng.gauss(0, 1) for _ in range(3)]) for k in range(6)]
    wanted = by_loop(rows, existing, 0.9)
    assert {d for d, _ in wanted.values()} == {"exact", "near", "existing", "kept"}
    frame = spark.createDataFrame(rows, ROWS)
    entries = spark.createDataFrame(existing, "id long, vector array<double>")
    index = dedup.KeptIndex(spark, f"file://{tmp_path}/kept")
    got = {}
    for run, part in ((1, frame.filter("place < 50")), (1, frame.filter("place < 50")), (2, frame.filter("place >= 50"))):  # the first one is repeated
        got |= {r.id: (r.decision, r.target) for r in index.extend(run, part, entries).collect()}
    assert got == wanted
    assert index.kept(3, frame).count() == sum(d == "kept" for d, _ in wanted.values())
    assert dedup.deduplicated(frame.filter("false"), entries, index.kept(3, frame)).count() == 0


def test_closure_of_chains_diamonds_and_a_cycle(spark):
    edges = {"a": ["b", "c"], "b": ["d"], "c": ["d", "e"], "d": ["f"], "x": ["y"], "y": ["z"], "z": ["x", "w"], "deep": ["late", "m"], "m": ["late"], "late": ["end"]}
    rows = [(p, c, i) for p, own in edges.items() for i, c in enumerate(own)]
    entries = spark.createDataFrame([(n,) for n in "abcdefgxyz"] + [("deep",), ("a",)], "id string")
    merges = spark.createDataFrame([*rows, rows[0], ("a", None, 9), (None, "a", 0)], "parent string, child string, place int")
    got = {(r.root, r.node): (r.path, r.in_cycle) for r in lineage.merge_closure(entries, merges, "id").collect()}

    def walk(root):
        found, again, stack = {root: []}, False, [(root, [], [root])]
        while stack:  # depth first, in order
            node, path, on = stack.pop()
            for i, c in reversed(list(enumerate(edges.get(node, [])))):
                again |= c == root
                if c not in on:
                    stack.append((c, path + [i], on + [c]))
            if node not in found:
                found[node] = path
        return found, again

    wanted = {(r, n): (p, walk(r)[1]) for r in [*"abcdefgxyz", "deep"] for n, p in walk(r)[0].items()}
    assert got == wanted
    assert got["a", "d"] == ([0, 0], False) and got["x", "w"] == ([0, 0, 1], True) and got["deep", "late"] == ([0], False)
    sources = spark.createDataFrame([("d", "k1", 2), ("d", "k1", 1), ("c", "k1", 0), ("e", "k2", 0), ("a", None, 0), ("c", None, 0)], "entry string, key string, line int")
    closure = lineage.merge_closure(entries.filter("id = 'a'"), merges, "id")
    rows = {(r.key, r.entry, r.line) for r in lineage.inherited_rows(closure, sources, "entry", "key", "line").collect()}
    assert rows == {("k1", "d", 1), ("k2", "e", 0), (None, "a", 0)}
    assert lineage.merge_closure(entries.filter("false"), merges, "id").count() == 0
    assert not closure.filter(F.col("depth") != F.size("path")).count()
