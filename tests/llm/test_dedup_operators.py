"""Operators 5, 8 and 9 and the pipeline against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from threshmill.llm import bwt_dedup, embeddings, graph, ngram_join, shared
from threshmill.llm.queries import QUERIES
from threshmill.llm.shingles import Hasher


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# --- components


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [*((i, i + 1) for i in range(100, 160)), *((200, i) for i in range(201, 260)), *map(tuple, rng.integers(300, 500, (150, 2)).tolist())]
    got = {r.node: r.component for r in graph.components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: r for n, r in roots(nodes, links).items()}
    assert graph.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# --- 5


def brute_vectors(rows):
    unit = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    n = Counter(x for pair in links for x in pair)
    top = roots([i for i, _ in rows], links)
    return {i: (n[i], top[i], top[i] == i) for i, _ in rows}


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(size=24) * (0.25 if i % 3 else 0.6)).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)] + [(300, None), (301, []), (302, [0.0] * 24), (303, [None, *rows[1][1][1:]]), (304, [float("nan"), *rows[1][1][1:]]), (305, [float("inf"), *rows[1][1][1:]]), (306, [x * 1e200 for x in rows[1][1]]), (307, [1.0, 0.0]), (308, [1.0, 0.01])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("unit", F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    rows[-3] = (306, rows[1][1])
    assert got == brute_vectors(rows)
    assert embeddings.near_duplicates(df.filter("false")).count() == 0


def test_tile_pairs_by_brute_force(spark):
    rng = np.random.default_rng(14)
    low = rng.uniform(-1, 1, (60, 4))
    boxes = np.stack([low, low + rng.uniform(0, 0.7, low.shape) * (rng.random((60, 1)) < 0.5)], 1)
    rows = [(t, corner.tolist()) for t, corners in enumerate(boxes) for corner in corners]
    tiles = spark.createDataFrame(rows, "tile long, lead array<double>")
    for axes in (1, 2, 4):
        gap = lambda a, b: np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))[:axes]
        wanted = [(i, j) for i in range(60) for j in range(i, 60) if (gap(boxes[i], boxes[j]) ** 2).sum() <= 0.45**2]
        assert sorted(map(tuple, embeddings.tile_pairs(tiles, axes, 0.45).collect())) == wanted


def test_null_vector_identifiers(spark):
    rows = [(None, [1.0, 0.0]), (4, [1.0, 0.01]), (4, [1.0, 0.01]), (None, None)]
    got = sorted(((r.vec_id or -1), r.n_links) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert len(got) == 4 and got[-1][0] == 4


def shuffled(spark, job):
    """Bytes that the stages of a job write to shuffles."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: {s.stageId(): s.shuffleWriteBytes() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList()))}
    before = stages()
    job()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(n for i, n in stages().items() if i not in before)


def test_vectors_are_shuffled_once(spark, monkeypatch):
    """What goes to disk follows the rows, not the pairs of tiles, and no vector of the result is lost."""
    monkeypatch.setattr(embeddings, "TILE", 16)
    v = np.random.default_rng(5).normal(size=(1200, 64))
    frame = lambda n: spark.createDataFrame([(i, x) for i, x in enumerate(v[:n].tolist())], "vec_id long, embedding array<float>")
    few, many = (shuffled(spark, lambda n=n: embeddings.near_duplicates(frame(n)).collect()) for n in (300, 1200))
    assert 0 < many < 6 * few and many < 4 * 1200 * 64 * 4


# --- 8


def covered(texts, length=400):
    counts = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = {}
    for i, b in texts:
        hit = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if counts[b[s : s + length]] > 1:
                hit[s : s + length] = True
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out[i] = (len(b), int(hit.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~hit].tobytes()).hexdigest())
    return out


def windows(texts, length=bwt_dedup.STAGE_LENGTH):
    for b in ((t or "").encode() for t in texts):
        yield from (b[s : s + length] for s in range(len(b) - length + 1))


def passages_gone(counts, raw, length=bwt_dedup.STAGE_LENGTH, words=51):
    """What the pipeline's stage leaves of a text, by brute force."""
    hit = np.zeros(len(raw) + 2, bool)
    for s in range(len(raw) - length + 1):
        if counts[raw[s : s + length]] > 1:
            hit[s + 1 : s + 1 + length] = True
    edges = np.flatnonzero(np.diff(hit.astype(int)))
    out, at = b"", 0
    for a, b in zip(edges[::2], edges[1::2]):
        if len(raw[a:b].split()) >= words:
            out += raw[at:a]
            at = b
    return (out + raw[at:]).decode(errors="ignore")


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdeé"), rng.integers(2, 8))) for _ in range(n))


def repeats(rng):
    passage, other = prose(rng, 120), prose(rng, 150)
    texts = [prose(rng, 200) + passage + prose(rng, 50), passage + prose(rng, 60), prose(rng, 90) + passage[30:], "a" * 1000, "ab" * 400, "x" * 399, "x" * 400, "", None, other, other, other[:450], prose(rng, 20) + other[:399] + prose(rng, 20), "line of text\n" * 90]
    return texts + [prose(rng, 100) + passage[i : i + 430] + prose(rng, 100) for i in range(0, 60, 7)]


def test_transforms_find_repeats():
    rng = np.random.default_rng(5)
    pool = [rng.integers(97, 99, 30).astype(np.uint8).tobytes() for _ in range(4)]
    contexts = [b"".join(pool[j] for j in rng.integers(0, 4, 3))[: 90 - int(rng.integers(0, 60))] for _ in range(30)]
    contexts[3] = contexts[4] = b"a" * 60
    length = 25
    counts = Counter(c[s : s + length] for c in contexts for s in range(len(c) - length + 1))
    groups = [contexts[i : i + 7] for i in range(0, 30, 7)]
    shards = [(bwt_dedup.transform(own), np.array([len(c) for c in own])) for own in groups]
    found = bwt_dedup.repeated_starts(shards, length)
    assert found.tolist() == [counts[c[s : s + length]] > 1 for c in contexts for s in range(len(c) - length + 1)]
    for own, (symbols, sizes) in zip(groups, shards):  # a transform gives its contexts back
        back = bwt_dedup.steps_back(symbols)
        for k, c in enumerate(own):
            at, out = k, []
            for _ in range(len(c)):
                out.append(int(symbols[at]) - 1)
                at = back[at]
            assert bytes(reversed(out)) == c and symbols[at] == 0


@pytest.mark.parametrize(("block", "length"), [(2048, 400), (4, 400), (4, 200)])
def test_repeats(spark, monkeypatch, block, length):
    monkeypatch.setattr(bwt_dedup, "BLOCK", block)
    monkeypatch.setattr(bwt_dedup, "SHARD_CONTEXTS", min(block, 256) // 2)
    monkeypatch.setattr(bwt_dedup, "SHARD_BYTES", 2_000)
    monkeypatch.setattr(bwt_dedup, "SLOT_BYTES", 10_000)
    monkeypatch.setattr(bwt_dedup, "PART", 700)
    texts = repeats(np.random.default_rng(6))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lows", F.lit("clash")).repartition(3)
    got = {}
    for r in bwt_dedup.repeat_runs(docs, length=length).collect():
        raw = (r.text or "").encode()
        left, removed, runs = bwt_dedup._kept(raw, r[bwt_dedup.LOWS] or [], r[bwt_dedup.HIGHS] or [], length)
        got[r.doc_id] = (len(raw), removed, runs, hashlib.sha256(left).hexdigest())
    assert got == covered([(i, (t or "").encode()) for i, t in enumerate(texts)], length)


def test_repeated_rows_and_null_identifiers(spark):
    rng = np.random.default_rng(8)
    one, two = prose(rng, 150), prose(rng, 150)
    rows = [(1, one), (1, one), (None, two), (None, two), (None, prose(rng, 150)), (2, prose(rng, 150))]
    marked = bwt_dedup.repeat_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(marked) == len(rows)
    for r in marked:
        whole = r.text in (one, two)
        assert bwt_dedup._kept(r.text.encode(), r[bwt_dedup.LOWS] or [], r[bwt_dedup.HIGHS] or [])[0] == (b"" if whole else r.text.encode())


def test_stage_removes_passages_of_over_50_words(spark):
    rng = np.random.default_rng(9)
    passages, short = [prose(rng, n) for n in range(51, 61)], [prose(rng, n) for n in (30, 45, 49)]
    rows = [(10 * i + j, f"{prose(rng, 80)}\n{p}\n{prose(rng, 80)}") for i, p in enumerate(passages + short) for j in range(2)]
    rows += [(1000, "x" * 300), (1001, None), (1002, "")]
    counts = Counter(windows(t for _, t in rows))
    out = {r.doc_id: r.text for r in bwt_dedup.stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert out == {i: t and passages_gone(counts, t.encode()) for i, t in rows if not t or passages_gone(counts, t.encode())}
    assert not any(p in out[10 * i + j] for i, p in enumerate(passages) for j in range(2))
    assert all(out[i] == t for i, t in rows[2 * len(passages) : -3])


def test_repeats_of_scripts_without_spaces(spark):
    passage = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(120))
    docs = spark.createDataFrame([(i, f"document {i} " + passage + f" end {i}") for i in range(2)], "doc_id long, text string")
    left = {r.doc_id: r.text for r in bwt_dedup.stage(spark, docs, "").collect()}
    assert all(len(left[i]) < 30 and left[i].startswith(f"document {i}") for i in range(2))
    short = spark.createDataFrame([(i, f"document {i} " + passage[:90] + f" end {i}") for i in range(2)], "doc_id long, text string")
    assert {r.text for r in bwt_dedup.stage(spark, short, "").collect()} == {r.text for r in short.collect()}


def test_remove_repeats_keeps_columns(spark):
    texts = repeats(np.random.default_rng(7))
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, lows string")
    out = bwt_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(texts)
    assert {r.doc_id for r in out.filter("text is null").collect()} == {8}
    assert bwt_dedup.remove_repeats(docs.filter("false")).count() == 0


# --- 9


def shingle_sets(rows):
    out = {}
    for i, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def joined(rows):
    sets = shingle_sets(rows)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    top = roots(sets, links)
    return {i: (len(s), top[i]) for i, s in sets.items()}


def variants(rng):
    base = [prose(rng, n).split() for n in (6, 30, 120, 300)]
    passage = prose(rng, 40)
    texts = [None, "", " \n", "One", "one", "ONE two", "one TWO", "É é", "a b c d", "a b c d e"]
    for i in range(120):
        words = list(base[i % 4])
        for _ in range(int(rng.integers(0, max(2, len(words) // 20)))):
            words[int(rng.integers(0, len(words)))] = prose(rng, 1)
        texts.append(" ".join(words))
    return texts + [prose(rng, 60) + " " + passage for _ in range(60)] + [texts[50]] * 15


@pytest.mark.parametrize(("block", "shingles", "holders"), [(1024, 1 << 20, 256), (8, 1 << 20, 4), (1024, 2000, 16)])
def test_jaccard(spark, monkeypatch, block, shingles, holders):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles)
    monkeypatch.setattr(ngram_join, "HOLDER_BLOCK", holders)
    rows = list(enumerate(variants(np.random.default_rng(8))))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k1", F.lit("clash")).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()}
    assert got == joined(rows)
    assert ngram_join.jaccard_components(df.filter("false")).count() == 0


def test_jaccard_on_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in shared.table(spark, sf_dir, "documents").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op9_ngram_join"](spark, sf_dir).collect()} == joined(rows)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f"), (3, "")]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 1), (1, 1), (1, 1), (2, 1), (3, 3)]


def test_divide_skip_counts():
    rng = np.random.default_rng(9)
    for _ in range(100):
        lists = [np.unique(rng.integers(0, 80, rng.integers(1, 60))) for _ in range(int(rng.integers(1, 12)))]
        size = np.array([len(x) for x in lists])
        total = Counter(i for ids in lists for i in ids.tolist())
        need = int(rng.integers(1, 12))
        found, count = ngram_join.divide_skip(np.concatenate(lists), np.cumsum(size) - size, size, need)
        assert dict(zip(found.tolist(), count.tolist())) == {i: c for i, c in total.items() if c >= need}


def test_search_finds_all_components():
    rng = np.random.default_rng(11)
    for _ in range(20):
        base = [np.unique(rng.integers(0, 1 << 40, rng.integers(1, 60)).astype(np.uint64)) for _ in range(4)]
        sets = []
        for _ in range(60):
            own = base[int(rng.integers(0, 4))]
            own = own[rng.random(len(own)) > rng.choice([0, 0.05, 0.12, 0.3])]
            sets.append(np.unique(np.concatenate([own, rng.integers(0, 1 << 40, rng.integers(0, 6)).astype(np.uint64), base[0][:1]])))
        sets.sort(key=len)
        links = [(i, j) for j in range(len(sets)) for i in range(j) if ngram_join.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))]
        found = ngram_join.search(sets)
        assert set(map(tuple, map(sorted, found))) <= set(links) and roots(range(len(sets)), found) == roots(range(len(sets)), links)


def test_candidates_lose_no_link():
    rng = np.random.default_rng(10)
    hasher = Hasher()
    texts = [t.encode() for t in variants(rng)[10:80]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes, edges = hasher.sets(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    sets = [hashes[a:b] for a, b in zip(edges, edges[1:])]
    near = roots(range(len(sets)), ngram_join.candidates([ngram_join.bitmap(s) for s in sets], np.array([len(s) for s in sets])))
    for i in range(len(sets)):
        for j in range(i):
            if ngram_join.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                assert near[i] == near[j]


# --- pipeline


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs, kept = shared.table(spark, sf_dir, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        docs = shared.staged(spark, docs, shared.work_dir(spark, "t"))
        kept.append((before, docs))
    columns = shared.table(spark, sf_dir, "documents").columns
    assert all(after.columns == columns for _, after in kept[:-1])
    before, after = kept[1]
    groups = joined([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in groups.items() if i == c}
    before, after = kept[2]
    wanted = {r.doc_id: (r.text or "", passages_gone(before_texts, (r.text or "").encode())) for before_texts in [Counter(windows(r.text for r in before.collect()))] for r in before.collect()}
    left = {r.doc_id: r.text for r in after.collect()}
    assert set(left) == {i for i, (had, has) in wanted.items() if has or not had}
    assert all(left[i] == wanted[i][1] for i in left)
    before, after = kept[4]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_pipeline_keeps_one_of_repeated_rows(spark, sf_dir):
    rng = np.random.default_rng(12)
    a, b, c, d = (prose(rng, 120) for _ in range(4))
    rows = [(1, a), (1, a), (2, a), (3, b), (3, c), (None, b), (None, d), (None, d), (5, "short"), (5, ""), (None, ""), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert all(len(t) > 400 for t in (a, b, c, d))
    once = ngram_join.stage(spark, docs, sf_dir)
    key = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    wanted = sorted([(1, a), (3, b), (3, c), (None, d), (5, "short"), (5, ""), (None, ""), (None, None), (None, None)], key=repr)
    assert once.columns == docs.columns and key(once) == wanted
    assert key(bwt_dedup.stage(spark, shared.staged(spark, once, shared.work_dir(spark, "t")), sf_dir)) == wanted


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null and empty texts, repeated rows, null identifiers, extra columns that clash, and empty tables."""
    import corpus_pipeline

    rng = np.random.default_rng(15)
    texts = [prose(rng, 120) for _ in range(30)]
    rows = [(i, t, "en", "s1", len(t), "x") for i, t in enumerate(texts)] + [(0, texts[0], "en", "s1", 1, "x")] * 3
    rows += [(100, None, None, None, None, None), (101, "", "en", "s2", 0, "x"), (None, texts[5], "en", "s1", 1, "x"), (None, prose(rng, 60), None, "s1", 1, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_key string"
    for name, own in (("some", rows), ("none", [])):
        spark.createDataFrame(own, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    docs = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = shared.staged(spark, stage(spark, docs, f"{tmp_path}/some"), shared.work_dir(spark, "t"))
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        kept = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "toxicity":
            assert len(kept) == len(rows)
        elif name != "mixing":  # one of the repeated rows, and one text for the null identifier's copy of text 5
            assert len(kept) == 30 + 2 + 1 and len(set(kept)) == len(kept)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
