"""Pruned exact search against all products, and how many pairs of tiles it visits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threshmill.operators import dedup, similarity, vector_tree


def clustered(n, clusters, width=16, spread=0.05, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    v = centres[np.arange(n) % clusters] + rng.normal(size=(n, width)) * spread
    return [(i, x.tolist(), i % 7) for i, x in enumerate(v)]


def cosines(rows):
    v = np.array([r[1] for r in rows])
    n = np.linalg.norm(v, axis=1, keepdims=True)
    v = v / np.where(n == 0, 1, n)
    return v @ v.T


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<double>, g int")


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(vector_tree, "TILE_ROWS", 20)
    monkeypatch.setattr(vector_tree, "SAMPLE_ROWS", 300)
    monkeypatch.setattr(vector_tree, "LEAF_SAMPLE", 20)
    monkeypatch.setattr(vector_tree, "CHUNK_BYTES", 200 * 16 * 8)


ODD = [(5000, None, 1), (5001, [], 1), (5002, [float("nan")] * 16, 1), (5003, [None] * 16, 1), (None, [1.0] * 16, 1)]


def test_pairs_above_is_exact(spark, small):
    rows = clustered(500, 25) + [(1000 + i, clustered(1, 1)[0][1], i) for i in range(70)] + [(2000, [0.0] * 16, 0)]
    s = cosines(rows)
    for threshold, group in ((0.98, None), (0.6, "g"), (0.0, None)):
        wanted = {(rows[i][0], rows[j][0]) for i, j in zip(*np.nonzero(s >= threshold)) if i < j and not (group and rows[i][2] == rows[j][2])}
        found = similarity.pairs_above(frame(spark, rows + ODD), "id", "v", threshold, group).collect()
        assert len(found) == len(wanted) and {(r.id_a, r.id_b) for r in found} == wanted
    assert similarity.pairs_above(frame(spark, ODD), "id", "v", 0.5).count() == 0


@pytest.mark.parametrize("k", [4, 700])
def test_top_k_is_exact(spark, small, k):
    rows = clustered(400, 12) + [(1000 + i, clustered(1, 1)[0][1], i) for i in range(60)] + [(2000, [0.0] * 16, 0)]
    s = np.round(cosines(rows), 12)
    df = frame(spark, rows + ODD)
    for asked in (lambda i: True, lambda i: i % 5 == 0):
        base = df if asked(1) else df.filter("id % 5 <> 0")
        queries = df if asked(1) else df.filter("id % 5 = 0")
        wanted = []
        for i, r in enumerate(rows):
            if asked(r[0]):
                others = [j for j, o in enumerate(rows) if j != i and (asked(1) or o[0] % 5)]
                wanted += [(r[0], rank, s[i, j]) for rank, j in enumerate(sorted(others, key=lambda j: (-s[i, j], rows[j][0]))[:k], 1)]
        found = similarity.top_k(queries, base, "id", "v", k).collect()
        got, wanted = sorted((r.query_id, r["rank"], r.similarity) for r in found), sorted(wanted)
        assert [r[:2] for r in got] == [r[:2] for r in wanted] and np.allclose([r[2] for r in got], [r[2] for r in wanted], rtol=0, atol=1e-9)
        copies = [i for i in range(1001, 1060) if asked(1) or i % 5][:k]
        assert sorted((r["rank"], r.id) for r in found if r.query_id == 1000)[: len(copies)] == list(enumerate(copies, 1))


def test_strings_as_identifiers(spark, small):
    rows = [(f"x{i:03}", v) for i, v, _ in clustered(90, 3)]
    s = cosines(rows)
    found = similarity.pairs_above(spark.createDataFrame(rows, "id string, v array<float>"), "id", "v", 0.9).collect()
    assert {(r.id_a, r.id_b) for r in found} == {(rows[i][0], rows[j][0]) for i, j in zip(*np.nonzero(s >= 0.9)) if i < j}


def visited(spark, n):
    """(pairs of tiles that meet, all pairs of tiles) of clustered vectors."""
    rows = vector_tree.usable(frame(spark, clustered(n, n // 40)), "id", "v")
    tiles = vector_tree.tiled(rows, n, vector_tree.upper_cuts(rows, n))
    count = tiles.rows.count()
    return vector_tree.meeting(tiles, tiles, 0.9, ordered=True).count(), count * (count + 1) // 2


def test_visited_pairs_grow_less_than_all(spark, small, monkeypatch):
    monkeypatch.setattr(vector_tree, "SAMPLE_ROWS", 2000)
    (few, all_few), (many, all_many) = visited(spark, 800), visited(spark, 3200)
    assert many < 0.1 * all_many
    assert many / few < 0.75 * all_many / all_few, (few, all_few, many, all_many)


def test_top_k_visits_few(spark, small):
    n = 2000
    df = frame(spark, clustered(n, 50))
    rows = vector_tree.usable(df, "id", "v")
    tiles = vector_tree.tiled(rows, n, vector_tree.upper_cuts(rows, n))
    floors = tiles.rows.select("tile", F.lit(0.95).alias("floor"))
    met, count = vector_tree.meeting(tiles, tiles, {leaf: 0.95 for leaf in tiles.leaves["leaf"]}, floors).count(), tiles.rows.count()
    assert met < 0.3 * count**2
    seeded = vector_tree.seeds(tiles, tiles, 6)
    assert seeded.select("a").distinct().count() == count and seeded.count() <= 3 * count


def test_lengths_that_differ_are_an_error(spark):
    with pytest.raises(ValueError):
        similarity.pairs_above(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, v array<double>"), "id", "v", 0.5)


def test_a_tile_is_sent_once_for_each_block(spark, small, monkeypatch):
    monkeypatch.setattr(vector_tree, "BLOCKS", 3)
    rows = vector_tree.usable(frame(spark, clustered(400, 10)), "id", "v")
    tiles = vector_tree.tiled(rows, 400, vector_tree.upper_cuts(rows, 400))
    meet = vector_tree.meeting(tiles, tiles, -2.0, ordered=True)
    sent, count = vector_tree.block_pairs(meet, tiles, tiles, []), tiles.rows.count()
    assert meet.count() == count * (count + 1) // 2
    blocks = tiles.blocks().select("block").distinct().count()
    assert 3 <= blocks <= 4 and sent.count() == count * blocks


def test_reduced_pairs_equal_pairs(spark, small):
    rows = clustered(300, 12, spread=0.3)
    s, n = cosines(rows), len(rows)
    df = frame(spark, rows + ODD[:-1])
    edges = [0.5, 0.8, 0.95, 1.5]
    upper = [(s[i, j], rows[i][2] == rows[j][2]) for i in range(n) for j in range(i + 1, n)]
    counts = similarity.counted_above(df, "id", "v", edges, "g")
    wanted = {(t, sum(x >= t for x, _ in upper), sum(x >= t and e for x, e in upper)) for t in edges[:3]}
    assert {tuple(r) for r in similarity.swept(counts, edges).collect()} == wanted
    best = {r.id_a: r.similarity for r in similarity.best_above(df, "id", "v", edges).collect()}
    assert best.keys() == {i for i in range(n - 1) if s[i, i + 1 :].max() >= 0.5}
    assert all(abs(v - s[i, i + 1 :].max()) < 1e-12 for i, v in best.items())


def test_a_task_sends_stars_only(spark, small):
    rows = clustered(300, 3, spread=0.01)  # 14850 pairs at least
    stars = similarity.components_above(frame(spark, rows), "id", "v", 0.9).collect()
    assert 297 <= len(stars) < 14 * 300
    assert {r.a % 3 == r.b % 3 for r in stars} == {True}


@pytest.mark.parametrize("head", [16, 4096])
def test_greedy_apart_is_the_loop(spark, small, monkeypatch, head):
    monkeypatch.setattr(dedup, "HEAD_ROWS", head)
    rows = clustered(260, 30, spread=0.25) + [(900 + i, clustered(1, 1)[0][1], 0) for i in range(20)]
    s, kept = cosines(rows), []
    for i in range(len(rows)):
        if not any(s[i, j] >= 0.8 for j in kept):
            kept.append(i)
    made = []
    monkeypatch.setattr(similarity, "pairs_above", lambda *a, real=similarity.pairs_above: made.append(a[0].count()) or real(*a))
    found = dedup.greedy_apart(frame(spark, rows + ODD[:-1]).withColumn("rank", F.col("id")), "id", "v", "rank", 0.8).collect()
    assert len(found) == len(rows) + len(ODD) - 1
    assert {r.id for r in found if r.kept} == {rows[i][0] for i in kept} | {r[0] for r in ODD[:-1]}
    assert sum(made) < len(rows) / 2
