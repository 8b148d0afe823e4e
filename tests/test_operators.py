import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from threshmill.operators import clusters, guards, incremental, messages, registry, segments, similarity
from threshmill.sources import file_inventory, json_lines_numbered, subtitles

START = datetime(2026, 1, 1)


def chat(spark, *rows):
    """(minute, speaker, role, question) rows of one document."""
    data = [("d", i, None if m is None else START + timedelta(minutes=m), s, r, q) for i, (m, s, r, q) in enumerate(rows)]
    return spark.createDataFrame(data, "document_id string, idx long, ts timestamp, speaker string, role string, is_question boolean")


def splits(df):
    return [(r.segment, r.start_reason, r.end_reason) for r in segments.rule_segments(df).orderBy("idx").collect()]


def test_gap_splits_at_exactly_two_hours(spark):
    got = splits(chat(spark, (0, "a", "customer", True), (119, "a", "customer", True), (239, "a", "customer", True)))
    assert got == [(0, "document_start", "time_gap_120m"), (0, "document_start", "time_gap_120m"), (1, "time_gap_120m", "document_end")]


def test_size_and_null_times(spark):
    got = splits(chat(spark, *((None, "a", "customer", False) for _ in range(31))))
    assert [g[0] for g in got] == [0] * 30 + [1]
    assert got[-1][1] == "max_messages"


def test_question_rules(spark):
    got = splits(chat(spark, (0, "a", "customer", True), (1, "s", "support", False), (5, "a", "customer", True), (6, "b", "customer", True), (30, "s", "support", False), (55, "b", "customer", True)))
    assert [g[0] for g in got] == [0, 0, 0, 1, 1, 2]
    assert got[3][1] == "different_customer_question" and got[5][1] == "new_customer_question_after_reply"


def test_messages(spark):
    files = spark.createDataFrame([("f", "# T\r\n　【2026-09-15 10:00】客户：怎么设置？\r\nnothing\r\n\r\n【2026-09-15 10:01】客服: 进入: 设置")], "path string, text string")
    got = messages.parse_messages(files).orderBy("line_number").collect()
    assert [(r.line_number, r.timestamp, r.speaker, r.content) for r in got] == [(2, "2026-09-15 10:00", "客户", "怎么设置？"), (5, "2026-09-15 10:01", "客服", "进入: 设置")]
    assert len({r.message_sha256 for r in got}) == 2


def test_paragraph_chunks(spark):
    rows = [("d", i, "x" * n) for i, n in enumerate((300, 150, 500, 10))]
    got = segments.chunk_paragraphs(spark.createDataFrame(rows, "document_id string, para_index int, text string")).orderBy("chunk").collect()
    assert [(r.para_start, r.para_end) for r in got] == [(0, 1), (2, 2), (3, 3)]


def edges(spark, *rows):
    return spark.createDataFrame(list(rows), "a string, b string, similarity double, confidence double, eligible boolean")


def test_single_link_and_greedy_differ_on_a_chain(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("z", 4)], "id string, rank int")
    chain = spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string")
    linked = clusters.single_link(rows, chain, "id", F.col("rank"))
    decided = {r.id: r.decision for r in clusters.dedup_decisions(linked, rows.filter("id = 'a'").select("id"), "id").collect()}
    assert decided == {"a": "known", "b": "known", "c": "known", "z": "kept"}
    greedy = clusters.greedy_keep(rows, chain, "id", "rank")
    assert {r.id for r in greedy.filter("kept").collect()} == {"a", "c", "z"}


def test_greedy_keep_by_brute_force(spark):
    rng = random.Random(7)
    n = 60
    pairs = {(i, j) for i in range(n) for j in range(i) if rng.random() < 0.05} | {(i, i + 1) for i in range(30)}
    rank = {i: rng.randrange(20) if i > 30 else i - 100 for i in range(n)}
    stay = set()
    for i in sorted(range(n), key=lambda i: (rank[i], i)):
        if not any((i, j) in pairs or (j, i) in pairs for j in stay):
            stay.add(i)
    rows = spark.createDataFrame(list(rank.items()), "id long, rank int")
    edges = spark.createDataFrame(sorted(pairs), "a long, b long")
    for rounds in (1, 3, 60):
        assert {r.id for r in clusters.greedy_keep(rows, edges, "id", "rank", rounds).filter("kept").collect()} == stay


def test_bipartite_match(spark):
    rows = spark.createDataFrame([("k", "a", "x", 0.9), ("k", "a", "y", 0.8), ("k", "b", "x", 0.8), ("k", "b", "y", 0.2)], "key string, left_id string, right_id string, score double")
    assert {(r.left_id, r.right_id) for r in clusters.bipartite_match(rows, "key").collect()} == {("a", "y"), ("b", "x")}


def brute_matching(pairs):
    """The greatest total, by trying all."""
    if not pairs:
        return 0.0
    left, own = pairs[0][0], [p for p in pairs if p[0] == pairs[0][0]]
    rest = [p for p in pairs if p[0] != left]
    return max([brute_matching(rest), *(s + brute_matching([p for p in rest if p[1] != r]) for _, r, s in own)])


def test_best_matching_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        pairs = [(i, j, round(rng.random(), 2) + 0.01) for i in range(rng.randint(1, 6)) for j in range(rng.randint(1, 6)) if rng.random() < 0.6]
        found = clusters.best_matching(pairs)
        assert set(found) <= set(pairs) and len({l for l, *_ in found}) == len(found) == len({r for _, r, _ in found})
        assert abs(sum(s for *_, s in found) - brute_matching(pairs)) < 1e-9


def test_matching_of_a_large_label(spark):
    n = 60
    rows = [("k", i, j, 0.9 - 0.01 * abs(i - j)) for i in range(n) for j in range(n) if abs(i - j) < 10]
    got = clusters.bipartite_match(spark.createDataFrame(rows, "key string, left_id long, right_id long, score double"), "key").collect()
    assert {(r.left_id, r.right_id) for r in got} == {(i, i) for i in range(n)}


def test_components_take_few_jobs(spark, monkeypatch):
    n = 150
    edges = [(i, i + 1) for i in range(n) if i % 50 != 49] + [(7, 7), (900, 7), (None, 1)]
    wanted = {i: i // 50 * 50 for i in range(n)} | {900: 0, 1000: 1000}
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4)
    nodes = spark.createDataFrame([(1000,), (3,), (3,)], "id long")
    count = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    for group, size in (("whole", 10**6), ("rounds", 100), ("no shrinking", 10)):
        monkeypatch.setattr(clusters, "TASK_EDGES", size)
        monkeypatch.setattr(clusters, "STAR_ROWS", size)
        spark.sparkContext.setJobGroup(group, group)
        got = {r.node: r.component for r in clusters.connected_components(frame, nodes).collect()}
        assert got == wanted
        if group == "whole":
            assert count() <= 12
    words = spark.createDataFrame([("b", "c"), ("ä", "c"), ("z", "x")], "a string, b string")
    assert {r.node: r.component for r in clusters.connected_components(words).collect()} == {"b": "b", "c": "b", "ä": "b", "x": "x", "z": "x"}
    pairs = spark.createDataFrame([((1, 2), (3, 4))], "a struct<x:int,y:int>, b struct<x:int,y:int>")
    assert {tuple(r.component) for r in clusters.connected_components(pairs).collect()} == {(1, 2)}


def test_issue_matching_has_no_id_prefix(spark, tmp_path):
    from threshmill.plans import vectors

    rows = [(i, [1.0, 0.0], 1) for i in (1000, 1001)] + [(2001, [0.0, 1.0], 1), (2002, [0.0, 1.0], 2)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [(r.left_id, r.right_id) for r in vectors.issue_matching(spark, str(tmp_path)).collect()] == [(1000, 1001)]


def test_top_k_with_ties_and_zero(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0])], "id long, v array<double>")
    got = {(r.query_id, r.id, r["rank"]) for r in similarity.top_k(v, v, "id", "v", 1).collect()}
    assert got == {(1, 2, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1)}


REVISIONS = "kb_id string, revision int, status string, question string, answer string, supersedes string"


def test_chain(spark):
    good = [("KB-0001", 1, "superseded", "q", "a", None), ("KB-0001", 2, "active", "q", "b", "KB-0001@r1")]
    bad = [("KB-0002", 1, "superseded", "q", "a", None), ("KB-0002", 3, "active", "q", "b", None)]
    found = registry.chain_violations(spark.createDataFrame(good + bad, REVISIONS)).collect()
    assert [(r.kb_id, r.revision, r.violations) for r in found] == [("KB-0002", 3, ["gap", "bad_supersedes"])]


def test_reviews_become_revisions(spark):
    revisions = spark.createDataFrame([("KB-0001", 1, "active", "怎么设置标签", "进入设置页面", None)], REVISIONS)
    issues = spark.createDataFrame([("i1", "怎么设置标签？", "不支持这个功能"), ("i2", "如何导出报表？", "点击导出按钮"), ("i3", "短", "短"), ("i4", "怎么设置标签", "进入设置页面。")], "issue_id string, question string, answer string")
    analyzed = registry.analyze(issues, registry.active(revisions))
    assert {r.issue_id: (r.relation, r.confidence) for r in analyzed.collect()} == {"i1": ("conflict", 0.9), "i2": ("new", 0.8), "i3": ("low_value", 1.0), "i4": ("duplicate_evidence", 1.0)}
    reviews = registry.review_rows(analyzed).withColumn("status", F.lit("approved"))
    after = {(r.kb_id, r.revision): (r.status, r.supersedes) for r in registry.approve(reviews, revisions).collect()}
    assert after == {("KB-0001", 1): ("superseded", None), ("KB-0001", 2): ("active", "KB-0001@r1"), ("KB-0646", 1): ("active", None)}


def test_guards(spark):
    row = spark.createDataFrame([("CURRENT_CONFIRMED", 2, 1, 0, 1, 0, 10, True), ("STALE", 2, 0, 0, 1, 0, 10, True)], "decision string, n_members int, n_recent int, n_recent_sound int, n_cited int, n_cited_temporary int, span_days int, annotated boolean")
    assert [r[0] for r in row.select(guards.temporal_gate()).collect()] == ["GATE_FAILED_KEEP_BLOCKED", "STALE"]
    links = spark.createDataFrame([("c", "k1", ["the text", "no"]), ("c", "k1", ["the text"]), ("c", "k2", ["no"]), ("c", "k9", ["x"])], "cluster_id string, chunk_id string, quotes array<string>")
    chunks = spark.createDataFrame([("k1", "here is the text"), ("k2", "other")], "chunk_id string, text string")
    kept = guards.verbatim_quotes(links, chunks).collect()
    assert [(r.chunk_id, r.quotes) for r in kept] == [("k1", ["the text"])]


def test_subtitles(spark):
    text = "1\r\n00:00:01,500 --> 00:00:02,000\r\nhello\r\nworld\r\n\r\n2\n00:01:00,000 --> 00:01:01,250\nend"
    got = subtitles(spark.createDataFrame([("v", text)], "path string, text string")).orderBy("index").collect()
    assert [(r["index"], r.start_seconds, r.end_seconds, r.text) for r in got] == [(1, 1.5, 2.0, "hello world"), (2, 60.0, 61.25, "end")]


def test_several_reviews_of_one_target(spark):
    revisions = spark.createDataFrame([("KB-0001", 1, "active", "q", "a", None), ("KB-0002", 1, "active", "q2", "b", None)], REVISIONS)
    rows = [("r2", "i2", "conflict", "KB-0001", "q", "second"), ("r1", "i1", "answer_supplement", "KB-0001", "q", "first"), ("r3", "i3", "new", None, "q3", "c"), ("r4", "i4", "new", None, "q4", "d")]
    reviews = spark.createDataFrame([(*r, 0.9, "approved") for r in rows], REVIEWS)
    after = registry.approve(reviews, revisions)
    got = sorted((r.kb_id, r.revision, r.status, r.answer, r.supersedes) for r in after.collect())
    assert got == [("KB-0001", 1, "superseded", "a", None), ("KB-0001", 2, "superseded", "first", "KB-0001@r1"), ("KB-0001", 3, "active", "second", "KB-0001@r2"), ("KB-0002", 1, "active", "b", None), ("KB-0646", 1, "active", "c", None), ("KB-0647", 1, "active", "d", None)]
    assert registry.chain_violations(after).count() == 0


REVIEWS = "review_id string, issue_id string, relation string, target_kb_id string, proposed_question string, proposed_answer string, confidence double, status string"


def test_decisions(spark):
    revisions = spark.createDataFrame([("KB-0001", 1, "active", "q", "a", None)], REVISIONS)
    issues = spark.createDataFrame([("i1", "s1", "active"), ("i2", "s1", "invalidated"), ("i3", "s2", "active")], "issue_id string, source string, status string")
    reviews = spark.createDataFrame(
        [("a", "i1", "conflict", "KB-0001", "q", "b", 0.9, "pending"), ("b", "i2", "new", None, "x", "y", 0.8, "pending"), ("c", "i3", "new", None, "x", "y", 0.8, "pending"), ("d", "i2", "revalidation_required", "KB-0001", "q", "a", 1.0, "pending"), ("e", "i1", "new", None, "x", "y", 0.8, "rejected"), ("f", "i9", "new", None, "x", "y", 0.8, "pending")],
        REVIEWS,
    )
    decisions = spark.createDataFrame([("a", "approved", "fine"), ("b", "approved", ""), ("c", "rejected", ""), ("d", "approved", ""), ("e", "approved", ""), ("f", "approved", ""), ("zz", "approved", "")], "review_id string, decision string, note string")
    after = registry.decide(reviews, issues, revisions, decisions)
    assert {r.entity: r.event for r in after["audit"].collect()} == {"a": "review_approved", "b": "refused_inactive_issue", "c": "review_rejected", "d": "revalidation_acknowledged", "e": "refused_already_decided", "f": "refused_inactive_issue", "zz": "refused_unknown_review"}
    assert {r.review_id: r.status for r in after["reviews"].collect()} == {"a": "approved", "b": "pending", "c": "rejected", "d": "approved", "e": "rejected", "f": "pending"}
    assert [tuple(r) for r in after["evidence"].collect()] == [("KB-0001", 2, "i1", "s1", "active")]
    assert {(r.kb_id, r.revision, r.status) for r in after["revisions"].collect()} == {("KB-0001", 1, "superseded"), ("KB-0001", 2, "active")}


def test_revise_and_rebaseline(spark):
    revisions = spark.createDataFrame([("KB-0001", 1, "active", "q", "a", None), ("KB-0002", 1, "retired", "q", "b", None), ("KB-0003", 1, "active", "q3", "c", None)], REVISIONS)
    long = "an answer of more than twenty characters"
    proposed = [("KB-0001", " q ", long), ("KB-0002", "q", long), ("KB-0009", "q", long), ("KB-0003", "q", "short")]
    after, refused = registry.revise(revisions, spark.createDataFrame(proposed, "kb_id string, question string, answer string"))
    assert {r.kb_id: r.reasons for r in refused.collect()} == {"KB-0002": ["not_active"], "KB-0009": ["unknown_entry"], "KB-0003": ["answer_too_short"]}
    assert [(r.revision, r.question, r.supersedes) for r in registry.active(after).filter("kb_id = 'KB-0001'").collect()] == [(2, "q", "KB-0001@r1")]
    base = spark.createDataFrame([("KB-0001", "q", "changed"), ("KB-0005", "new", "e")], "kb_id string, question string, answer string")
    got = sorted((r.kb_id, r.revision, r.status) for r in registry.rebaseline(revisions, base).collect())
    assert got == [("KB-0001", 1, "superseded"), ("KB-0001", 2, "active"), ("KB-0002", 1, "retired"), ("KB-0003", 1, "retired"), ("KB-0005", 1, "active")]


def test_guards_fail_on_what_is_not_known(spark):
    names = ["supported", "answers_question", "is_real_cause", "action_supported", "in_scope", "reusable", "stable", "stable_limitation", "annotated"]
    row = spark.createDataFrame([(None,) * len(names)], ", ".join(f"{n} boolean" for n in names))
    row = row.selectExpr("*", "'publish' AS verdict", "cast(null AS string) AS qa_aligned", "'how_to' AS problem_type", "'candidate' AS decision", "cast(null AS array<struct<flag: string, severity: string>>) AS flags", "cast(null AS int) AS n_recent", "0 AS n_recent_sound", "0 AS n_cited", "0 AS n_cited_temporary", "0 AS n_members", "0 AS span_days")
    got = row.select(guards.cause_verdict().alias("a"), guards.regenerated_verdict().alias("b"), guards.build_verdict(F.col("flags")).alias("c"), guards.admission().alias("d")).first()
    assert tuple(got) == ("insufficient_evidence", "insufficient_evidence", "manual_review", "reject")
    gates = [row.withColumn("decision", F.lit(d)).select(guards.temporal_gate()).first()[0] for d in ("CURRENT_CONFIRMED", "STALE", "UNKNOWN", None)]
    assert gates == ["GATE_FAILED_KEEP_BLOCKED", "GATE_FAILED_KEEP_BLOCKED", "UNKNOWN", "GATE_FAILED_KEEP_BLOCKED"]


def test_changed_interval(spark):
    rows = [("abcdef", "abXdef"), ("abc", "abc"), ("abc", "abcde"), ("abcd", "ad"), ("", "ab"), ("aa", "aaa"), ("ab", "")]
    df = spark.createDataFrame([(list(a), list(b)) for a, b in rows], "a array<string>, b array<string>")
    got = [tuple(r.c) for r in df.select(incremental.changed_interval(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got == [(2, 3), (3, 3), (3, 5), (1, 1), (0, 2), (2, 3), (0, 0)]


def test_numbering_and_files(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i % 40:02d}", i) for i in range(100)], "k string, v int")
    got = clusters.exact_groups(rows, F.col("k"), "v").collect()
    assert {r.group_no for r in got} == set(range(1, 41)) and all(r.group_no == int(r.k[1:]) + 1 for r in got)
    for name in ("b.md", "a.md", "c.md"):
        (tmp_path / name).write_text(f"# Title {name}\nwords here")
    files = file_inventory(spark, f"file://{tmp_path}").orderBy("path").collect()
    assert [(r.document_id, r.title) for r in files] == [("D0001", "Title a.md"), ("D0002", "Title b.md"), ("D0003", "Title c.md")]
    (tmp_path / "x.jsonl").write_text("".join('{"a": %d}\n\n' % i for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = json_lines_numbered(spark, f"file://{tmp_path}/x.jsonl", "a int").filter("a is not null").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(lines) == 2000 and all(r.line_number == 2 * r.a + 1 for r in lines)
