"""Operators 11, 12 and 13 against brute force."""

import hashlib
import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from threshmill.llm import alignment, branch_merge, vector_search
from threshmill.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 12


def edited(value, code):
    return {0: "", 1: f"{value}!", 2: f"{value}?"}.get(code, value)


def merged_by_hand(rows):
    """Rows (doc_id, lang, source, text or None, four counters): each branch is built whole, then compared with the base."""
    out = []
    for doc, text, lang, source in rows:
        code = lambda b, name: zlib.crc32(f"{b}:{'' if doc is None else doc}:{name}".encode()) % 7  # noqa: E731, B023
        base, lines = {"lang": lang or "", "source": source or ""}, (text or "").split("\n")
        branch = {}
        for b in "LR":
            codes = [code(b, i) for i in range(len(lines))]
            branch[b] = {
                "gone": code(b, "row") == 0,
                "cols": {n: edited(v, code(b, n)) for n, v in base.items()},
                "lines": [None if c == 0 else edited(x, c) for x, c in zip(lines, codes)],
                "gaps": [{3: "!", 4: "?"}.get(c) for c in codes],
                "row": {3: "!", 4: "?"}.get(code(b, "row")),
            }
        left, right = branch["L"], branch["R"]
        n = [0, 0, 0, 0]

        def merge(old, x, y, gap=False):
            if old == x == y:
                return old
            if old in (x, y) or x == y:
                n[0] += 1  # noqa: B023
                return x if y == old else y
            n[3 if gap else 2 if x is None or y is None else 1] += 1  # noqa: B023
            return y

        changed = lambda s: s["cols"] != base or s["lines"] != lines or any(s["gaps"])  # noqa: E731, B023
        whole = lambda s: (*s["cols"].values(), "\n".join(x for pair in zip(s["lines"], s["gaps"]) for x in pair if x is not None))
        if left["gone"] and right["gone"]:
            state, n = (None,) * 3, [1, 0, 0, 0]
        elif left["gone"]:
            state, n = (whole(right), [0, 0, 1, 0]) if changed(right) else ((None,) * 3, [1, 0, 0, 0])
        elif right["gone"]:
            state, n = (None,) * 3, [0, 0, 1, 0] if changed(left) else [1, 0, 0, 0]
        else:
            both = {
                "cols": {k: merge(base[k], left["cols"][k], right["cols"][k]) for k in base},
                "lines": [merge(*x) for x in zip(lines, left["lines"], right["lines"])],
                "gaps": [merge(None, x, y, True) for x, y in zip(left["gaps"], right["gaps"])],
            }
            state = whole(both)
        out.append((doc, *state, *n))
        if left["row"] or right["row"]:
            n = [0, 0, 0, 0]
            added = merge(None, left["row"], right["row"], True)
            out.append((None if doc is None else -1 - doc, *base.values(), added, *n))
    return sorted(out, key=repr)


def test_merge(spark):
    rows = [(i, "\n".join(f"line {j}" if j % 5 else "" for j in range(i % 9)), "en" if i % 4 else "", f"s{i % 3}" if i % 7 else None) for i in range(900)]
    rows += [(1000, None, None, None), (1001, "", "", ""), (1002, "\n\n", "en", "x"), (1003, "a\r\nb\x00\n", "de", "é"), (None, "no\nidentifier", "en", "x"), (5, rows[5][1], *rows[5][2:]), (1004, "x\n" * 5000, "en", "y"), (1005, "w" * 300_000, "en", "y")]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(7) for c in ("lines", "states", "gone_l", "fate", "l")})
    merged = branch_merge.merge_branches(df)
    got = sorted(map(tuple, merged.collect()), key=repr)
    assert got == merged_by_hand(rows)
    kinds = {i for r in got for i, n in enumerate(r[4:]) if n}
    assert kinds == {0, 1, 2, 3} and any(r[3] is None for r in got) and any(r[3] == "" for r in got)
    assert branch_merge.merge_branches(df.filter("false")).count() == 0


def test_merge_stays_in_rows(spark, sf_dir):
    plan = QUERIES["op12_branch_merge"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Exchange", "Generate", "Python", "Arrow", "Aggregate "))


def test_merge_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    wanted = sorted(((*r[:3], r[3] if r[3] is None else sha(r[3]), *r[4:]) for r in merged_by_hand([tuple(r) for r in rows])), key=repr)
    assert sorted(map(tuple, QUERIES["op12_branch_merge"](spark, sf_dir).collect()), key=repr) == wanted


# --- 13


def nearest_by_hand(rows, k, asks):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (q, x) in enumerate(ok):
        if asks(q):
            dots = [(reduce(lambda s, ab: s + ab[0] * ab[1], zip(x.tolist(), y.tolist()), 0.0), i) for j, (i, y) in enumerate(ok) if j != at and len(y) == len(x)]
            best = sorted(((-np.inf if np.isnan(s) else s), i) for s, i in dots)
            best = sorted(best, key=lambda p: (-p[0], p[1]))[:k]
            out += [(q, r, i, s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_search(spark, monkeypatch):
    rng = np.random.default_rng(31)
    rows = [(i, (rng.normal(size=12) * 10.0 ** rng.integers(-2, 3)).round(3).tolist()) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(400 + i, rows[5][1]) for i in range(3)]
    rows += [(3, rows[3][1]), (5, rows[7][1]), (405, rows[9][1]), (405, rows[9][1]), (500, [1.0, 0.0]), (501, [0.5, 0.5]), (510, [2.0]), (None, rows[1][1])]
    rows += [(600, None), (605, []), (610, [0.0] * 12), (615, [None, *rows[1][1][1:]]), (620, [float("nan"), *rows[1][1][1:]]), (625, [float("inf"), *rows[1][1][1:]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("vector", "query", "own", "place")})
    wanted = nearest_by_hand(rows, 6, lambda i: i % 5 == 0)
    found = lambda d: sorted(map(tuple, d.collect()))
    assert found(vector_search.nearest(df, F.col("vec_id") % 5 == 0, 6)) == wanted
    monkeypatch.setattr(vector_search, "QUERY_BYTES", 1500)
    monkeypatch.setattr(vector_search, "BASE_BYTES", 4000)
    monkeypatch.setattr(vector_search, "TILE", 5)
    monkeypatch.setattr(vector_search, "PAIRS", 7)
    assert found(vector_search.nearest(df, F.col("vec_id") % 5 == 0, 6)) == wanted
    assert vector_search.nearest(df.filter("false"), F.col("vec_id") % 5 == 0, 6).count() == 0


def test_search_far_and_wide(spark):
    rng = np.random.default_rng(32)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 2500)))] + [(100, [1e200] * 3), (101, [1e200, -1e200, 1.0]), (102, [1e-200] * 3), (103, [5e-324, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, vector_search.nearest(df, F.lit(True), 3).collect())) == nearest_by_hand(rows, 3, lambda i: True)


def test_tile_bounds_hold_and_leave_little():
    rng = np.random.default_rng(33)
    x, y = rng.normal(size=(300, 64)), rng.normal(size=(3000, 64)) * rng.uniform(0.1, 3, (3000, 1))
    a, b = vector_search.Tile(x), vector_search.Tile(y)
    tile, room, unit = vector_search.quantised(a, b, slice(0, 300))
    assert (np.abs(tile * unit[:, None] - x @ y.T) <= room * unit[:, None]).all()
    heaps = vector_search.Heaps(300, 21)
    done = sum(vector_search.search(a, heaps, vector_search.Tile(y[s : s + 300]), np.arange(s, s + 300), np.arange(301)) for s in range(0, 3000, 300))
    assert [sorted(h) for h in heaps.id.tolist()] == [sorted(np.argsort(-d, kind="stable")[:21].tolist()) for d in x @ y.T]
    assert done < 0.05 * x.shape[0] * y.shape[0]


def test_search_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = sorted(map(tuple, QUERIES["op13_vector_search"](spark, sf_dir).collect()))
    wanted = nearest_by_hand(rows, 20, lambda i: i % 20 == 0)
    assert [r[:3] for r in got] == [r[:3] for r in wanted] and np.allclose([r[3] for r in got], [r[3] for r in wanted], rtol=0, atol=1e-12)


# --- 11


def aligned_by_hand(rows):
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) from the libraries' own calls, token by token."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in shown)}

    def spelled_b(i):
        piece = b.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("\u2581", " ").encode()

    found, counts = [], Counter()
    for doc, text in rows:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a, bytes_b = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a], [spelled_b(i) for i in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append((doc, 0, 0, [], []))
            continue
        ends_a = {int(e): i for e, i in zip(np.cumsum([len(x) for x in bytes_a]), range(len(ids_a)))}
        ends_b = {int(e): i for e, i in zip(np.cumsum([len(x) for x in bytes_b]), range(len(ids_b)))}
        links, groups, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a[end], ends_b[end]
            links.append((ids_a[x], ids_b[y]))
            groups.append(",".join(map(str, ids_a[i : x + 1])) + "|" + ",".join(map(str, ids_b[j : y + 1])))
            i, j = x + 1, y + 1
        counts.update(links)
        found.append((doc, len(ids_a), len(ids_b), groups, links))
    highest = {}
    for (x, y), n in counts.items():
        highest[y] = max(n, highest.get(y, 0))
    return sorted(((doc, n_a, n_b, len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), sha(";".join(groups)) if groups else "") for doc, n_a, n_b, groups, links in found), key=repr)


ODD = ["", None, "a", " ", "  two  spaces ", "\n\n\ttabs\r\n", "<s> <unk> </s> <|endoftext|> <0x41>", "sign \u2581 of B", "\x00 zero", "e\u0301 \ufb01 \u00a0 \u3000", "日本語のテキスト", "🙂👍🏽 emoji", "x" * 3000, "na\u00efve caf\u00e9 \u2013 \u201cquoted\u201d", "\ufeff", "word " * 2000]


def test_alignment(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD * 2)] + [(None, "no identifier"), (3, "another row")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("row", "pairs", "times", "n_a")})
    found = lambda: sorted(map(tuple, alignment.align_corpus(df, alignment.default_tokenizer(), alignment.default_pieces())[0].collect()), key=repr)
    wanted = aligned_by_hand(rows)
    assert found() == wanted and any(r[1] > r[3] for r in wanted) and any(r[5] < r[4] for r in wanted)
    monkeypatch.setattr(alignment, "HOT_PAIRS", 5)
    assert found() == wanted
    none = alignment.align_corpus(df.filter("false"), alignment.default_tokenizer(), alignment.default_pieces())
    assert none[0].count() == none[1].count() == 0


def test_alignment_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_alignment"](spark, sf_dir)
    assert sorted(map(tuple, got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr) == aligned_by_hand(rows)


# --- 4: one kind of anchors for all lengths


def test_fingerprints_change_little_with_a_word(spark):
    from threshmill.llm import syncmers

    rng = np.random.default_rng(44)
    rows = []
    for n in [*range(2, 61), 100, 300]:
        words = ["".join(rng.choice(list("abcdefghijklmnop"), 3)) for _ in range(n)]
        other = ["".join(rng.choice(list("qrstuvwxyz"), 3)) for _ in range(n)]
        rows.append((n, " ".join(words), " ".join(words[:-1]), " ".join(words[: n // 2] + other[n // 2 :]), " ".join(other)))
    df = spark.createDataFrame(rows, "n int, whole string, less string, half string, other string")
    sketched = df.select("n", *(syncmers.sketch(F.col(c)).alias(c) for c in ("whole", "less", "half", "other")))
    alike = lambda c: syncmers.likeness(F.col("whole"), F.col(c)).alias(c)
    for r in sketched.select("n", alike("less"), alike("half"), alike("other")).collect():
        assert r.less >= 0.5 and r.other == 0.0, r
        assert r.half < r.less or r.n < 4
        if r.n >= 60:
            assert 0.15 < r.half < 0.55 and r.less > 0.8, r


def test_fingerprints_by_hand(spark):
    """Sketch and likeness of texts around the borders of k-mers against sets of hashes."""
    from threshmill.llm import syncmers

    rng = np.random.default_rng(45)
    texts = [" ".join("".join(rng.choice(list("abcdef"), 3)) for _ in range(n)) for n in (0, 1, 2, 8, 9, 10, 32, 33, 34, 90)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", syncmers.anchors(F.col("t")).alias("a"), syncmers.sketch(F.col("t")).alias("s")).collect()
    assert [len(r.a) > 0 for r in rows][:4] == [False] * 4
    sketches = {}
    for r in rows:
        own = r.t.split()
        hashed = spark.createDataFrame([(w,) for w in own] or [("",)], "w string").select(F.hash("w").alias("h"), F.xxhash64("w", F.lit(3)).alias("x")).collect() if own else []
        sample = {h.h for h in hashed if (h.x / 2**64 + 0.5) * len(own) < syncmers.SHORT}
        sketches[r.t] = sorted({a["hash"] for a in r.a} | sample)[: syncmers.SKETCH]
        assert r.s == sketches[r.t]
    pairs = [(a, b) for a in texts for b in texts]
    sketched = spark.createDataFrame(pairs, "a string, b string").select("a", "b", syncmers.sketch(F.col("a")).alias("x"), syncmers.sketch(F.col("b")).alias("y"))
    for a, b, value in sketched.select("a", "b", syncmers.likeness(F.col("x"), F.col("y"))).collect():
        both = sorted({*sketches[a], *sketches[b]})[: syncmers.SKETCH]
        wanted = sum(h in sketches[a] and h in sketches[b] for h in both) / len(both) if both else 1.0
        assert abs(value - wanted) < 1e-12


# --- 3: templates that depend on what came before


def test_templates_that_count_turns(spark):
    from threshmill.llm import chat

    numbered = lambda turns: "".join(f"[{i}] {r}: {t}\n" for i, (r, t) in enumerate(turns))
    late = lambda turns: ("long\n" if len(turns) > 600 else "short\n") + numbered(turns)

    def two_back(turns):
        return "".join(f"{r}({turns[i - 2][0] if i > 1 else '-'}): {t}\n" for i, (r, t) in enumerate(turns))

    two_back.lookback = 2
    turns = [("assistant" if i % 3 else "user", f"t{i}") for i in range(1000)]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)] + [(2, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    for template in (numbered, two_back):
        rows = chat.format_conversations(df, template).filter("conv_id = 1").orderBy("block").collect()
        assert "".join(r.formatted for r in rows) == template(turns) and not any(r.rewrites for r in rows) and len(rows) == 4
        masked = [r.formatted[s.start : s.start + s.length] for r in rows for s in r.loss_spans]
        assert masked == [t for r, t in turns if r == "assistant"]
    assert [r.rewrites for r in chat.format_conversations(df, late).filter("conv_id = 1").orderBy("block").collect()] == [False, False, True, False]
