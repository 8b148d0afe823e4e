import json

import pytest

from threshmill.operators import registry
from threshmill.plans.ingest import ConcurrentCommit, Registry, bootstrap, ingest, prune, review
from threshmill.operators import layers
from threshmill.sources import json_lines, sinks, tables
from threshmill.streaming import idempotent_sink, run_available, segment_stream, stream, windowed_counts

REVISIONS = "kb_id string, revision int, status string, question string, answer string, supersedes string"


def files(spark, **texts):
    return spark.createDataFrame([(k, v) for k, v in texts.items()], "path string, text string")


def line(i, who, text):
    return f"【2026-09-15 10:{i:02d}】{who}：{text}"


def test_ingest_scenarios(spark, tmp_path):
    reg = Registry(spark, f"file://{tmp_path}/registry")
    entries = spark.createDataFrame([], "kb_id string, question string, answer string")
    a = "\n".join([line(0, "客户", "怎么设置新的业务标签？"), line(1, "客服", "进入标签设置页面后新建标签并保存。")])
    b = "\n".join([line(0, "客户", "如何导出客户报表？"), line(1, "客服", "点击右上角的导出按钮。")])
    assert ingest(reg, files(spark, a=a, b=b), entries, dry_run=True) == {"files_new": 2, "knowledge_new": 2}
    assert reg.version() == 0
    assert ingest(reg, files(spark, a=a, b=b), entries) == {"files_new": 2, "knowledge_new": 2}
    assert ingest(reg, files(spark, a=a, b=b), entries) == {"files_unchanged": 2}
    longer = a + "\n" + line(2, "客户", "谢谢")
    counts = ingest(reg, files(spark, a=longer, c=b), entries)
    assert counts["files_appended"] == 1 and counts["files_moved"] == 1 and "files_deleted" not in counts
    assert ingest(reg, files(spark, a=longer), entries)["files_deleted"] == 1
    issues = {(r.source, r.status) for r in reg.table("issues").collect()}
    assert ("c", "invalidated") in issues and ("a", "active") in issues
    assert reg.table("reviews").filter("status = 'obsolete'").count() >= 1


def test_release_cycle(spark, tmp_path):
    root = str(tmp_path / "releases")
    first = spark.createDataFrame([("KB-0001", 1, "active", "问", "答案一", None)], REVISIONS)
    none = registry.publish_violations(first, spark.createDataFrame([], "review_id string, relation string, status string"), first.select("kb_id"))
    assert sinks.publish(spark, first, none, root, "1.0.0")["chunk_count"] == 1
    second = spark.createDataFrame([("KB-0001", 1, "superseded", "问", "答案一", None), ("KB-0001", 2, "active", "问", "答案二", "KB-0001@r1"), ("KB-0646", 1, "active", "问二", "答", None)], REVISIONS)
    sinks.publish(spark, second, none, root, "1.1.0")
    log = json.loads((tmp_path / "releases/1.1.0/changelog.json").read_text())
    assert (log["added"], log["revised"], log["removed"]) == (["KB-0646"], ["KB-0001"], [])
    assert sinks.current_release(root) == "1.1.0" and sinks.validate_release(spark, f"{root}/1.1.0") == []
    assert sinks.rollback(spark, root) == "1.0.0" and sinks.current_release(root) == "1.0.0"
    with (tmp_path / "releases/1.1.0/chunks.jsonl").open("a") as f:
        f.write('{"chunk_id":"x"}\n')
    assert {"chunk count", "checksum of chunks.jsonl"} <= set(sinks.validate_release(spark, f"{root}/1.1.0"))
    with pytest.raises(ValueError):
        sinks.rollback(spark, root, "1.1.0")
    with pytest.raises(ValueError):
        sinks.publish(spark, first, none, root, "0.9.0")


def test_gates_forbid_a_release(spark, tmp_path):
    bad = spark.createDataFrame([("KB-0001", 2, "active", "问", "答", None)], REVISIONS)
    reviews = spark.createDataFrame([("r", "conflict", "pending")], "review_id string, relation string, status string")
    wrong = registry.publish_violations(bad, reviews, bad.select("kb_id"))
    assert {r.gate for r in wrong.collect()} == {"broken_chain", "high_risk_pending"}
    with pytest.raises(ValueError):
        sinks.publish(spark, bad, wrong, str(tmp_path), "1.0.0")


def test_tolerant_json_and_append(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    assert sorted(r.a for r in json_lines(spark, f"file://{tmp_path}/x.jsonl", "a int", strict=False).collect()) == [1, 2]
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    out = f"file://{tmp_path}/log"
    assert sinks.append_new(rows, out, "k") == 2
    assert sinks.append_new(rows.unionByName(spark.createDataFrame([(3, "z")], "k int, v string")), out, "k") == 1
    assert spark.read.parquet(out).count() == 3


def test_csv_with_mark(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([("问", 1)], "q string, n int"), str(tmp_path / "o.csv"))
    assert (tmp_path / "o.csv").read_bytes() == "﻿q,n\n问,1\n".encode()


def test_streams(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = f"file://{tmp_path}/in"
    events.repartition(2).write.parquet(folder)
    source = stream(spark, folder, events.schema.simpleString()[7:-1].replace(":", " "))
    run_available(windowed_counts(source, "365 days"), idempotent_sink(f"file://{tmp_path}/out"), f"file://{tmp_path}/c1", "update")
    got = spark.read.parquet(f"file://{tmp_path}/out").agg({"n": "sum"}).first()[0]
    assert got == events.count()


def test_stateful_segments(spark, tmp_path):
    rows = [("d", 0, "a", "customer", True), ("d", 60_000_000, "s", "support", False), ("d", 8_000_000_000, "a", "customer", True)]
    spark.createDataFrame(rows, "document_id string, us long, speaker string, role string, is_question boolean").write.parquet(f"file://{tmp_path}/in")
    source = stream(spark, f"file://{tmp_path}/in", "document_id string, us long, speaker string, role string, is_question boolean")
    run_available(segment_stream(source), idempotent_sink(f"file://{tmp_path}/out"), f"file://{tmp_path}/c")
    got = spark.read.parquet(f"file://{tmp_path}/out").collect()
    assert [(r.segment, r.n, r.end_reason) for r in got] == [(0, 2, "time_gap_132m")]


def test_review_evidence_and_revalidation(spark, tmp_path):
    reg = Registry(spark, f"file://{tmp_path}/registry")
    base = spark.createDataFrame([("KB-0001", "系统是否支持删除客户？", "系统支持删除客户。")], "kb_id string, question string, answer string")
    assert bootstrap(reg, base, count=1) == 1 and bootstrap(reg, base) == 0
    a = "\n".join([line(0, "客户", "怎么设置新的业务标签？"), line(1, "客服", "进入标签设置页面后新建标签并保存。")])
    b = "\n".join([line(0, "客户", "系统是否支持删除客户？"), line(1, "客服", "系统不支持删除客户。")])
    counts = ingest(reg, files(spark, a=a, b=b))
    assert counts == {"files_new": 2, "knowledge_new": 1, "knowledge_conflict": 1}
    reviews = {r.relation: r.review_id for r in reg.table("reviews").collect()}
    assert review(reg, {reviews["new"]: "approved"}, "fixture") == {reviews["new"]: "review_approved"}
    assert review(reg, {reviews["new"]: "approved"}) == {reviews["new"]: "refused_already_decided"}
    assert [(r.kb_id, r.status) for r in reg.table("evidence").collect()] == [("KB-0646", "active")]
    assert {(r.source, r.message_watermark, r.last_message_time) for r in reg.table("sources").collect()} == {("a", 2, "2026-09-15 10:01"), ("b", 2, "2026-09-15 10:01")}
    changed = a.replace("标签设置页面", "其他设置页面")
    assert ingest(reg, files(spark, a=changed, b=b))["files_modified"] == 1
    assert [r.status for r in reg.table("evidence").collect()] == ["invalidated"]
    again = [r for r in reg.table("reviews").filter("status = 'pending'").collect() if r.relation == "revalidation_required"]
    assert [(r.target_kb_id, r.proposed_question) for r in again] == [("KB-0646", "怎么设置新的业务标签？")]
    assert review(reg, {again[0].review_id: "approved"}) == {again[0].review_id: "revalidation_acknowledged"}
    assert {"baseline_imported", "review_approved", "revalidation_acknowledged"} <= {r.event for r in reg.table("audit").collect()}


def test_renamed_and_changed_file_keeps_its_source(spark, tmp_path):
    reg = Registry(spark, f"file://{tmp_path}/registry")
    a = "\n".join([line(0, "客户", "如何新增客户？"), line(1, "客服", "点击新增客户并保存。")])
    ingest(reg, files(spark, old=a))
    counts = ingest(reg, files(spark, new=a.replace("点击", "先选择门店，再点击")), authoritative=False, source_ids={"new": "old"})
    assert counts["files_modified"] == 1 and {r.source for r in reg.table("sources").collect()} == {"old"}


def test_of_two_committers_one_fails(spark, tmp_path):
    reg = Registry(spark, f"file://{tmp_path}/registry")
    audit = spark.createDataFrame([("e", "x", "{}")], "event string, entity string, detail string")
    at = reg.version()
    assert reg.commit(at, audit=audit) == 1
    with pytest.raises(ConcurrentCommit):
        reg.commit(at, audit=audit.filter("false"))
    assert reg.version() == 1 and reg.table("audit").count() == 1
    assert reg.commit(audit=audit.union(audit)) == 2 and reg.tables(1)["audit"].count() == 1


def test_one_file_rewrites_its_buckets_only(spark, tmp_path):
    reg = Registry(spark, f"file://{tmp_path}/registry", buckets=16)
    text = lambda k: "\n".join([line(0, "客户", f"怎么设置第{k}个业务标签？"), line(1, "客服", f"进入第{k}个页面后新建标签并保存。")])
    texts = {f"s{k}": text(k) for k in range(40)}
    ingest(reg, files(spark, **texts))
    first = reg.folders(1)
    assert len(first["messages"]) > 8
    bucket = str(spark.sql("SELECT pmod(xxhash64('s7'), 16) AS b").first().b)
    changed = texts | {"s7": texts["s7"].replace("保存", "提交后保存")}
    assert ingest(reg, files(spark, s7=changed["s7"]), authoritative=False)["files_modified"] == 1
    second = Registry(spark, reg.root).folders(2)
    for name in ("messages", "issues"):
        assert {b for b in first[name] if first[name][b] != second[name][b]} == {bucket} and set(first[name]) == set(second[name])
    assert sum(first["reviews"].get(b) != f for b, f in second["reviews"].items()) <= 2
    whole = Registry(spark, f"file://{tmp_path}/whole", buckets=3)
    ingest(whole, files(spark, **texts))
    ingest(whole, files(spark, **changed))
    for name in ("messages", "issues", "reviews", "sources"):
        assert sorted(map(str, reg.table(name).collect())) == sorted(map(str, whole.table(name).collect()))
    counts = ingest(reg, files(spark, **{k: t for k, t in changed.items() if k != "s3"}))
    assert counts["files_deleted"] == 1 and reg.table("messages").count() == 78 and reg.tables(1)["messages"].count() == 80
    part = reg.part("messages", spark.createDataFrame([("s7",)], "source string"))
    assert {r.source for r in part.collect()} >= {"s7"} and part.count() < 78


def test_command_line(spark, tmp_path, capsys):
    from threshmill.__main__ import main

    (tmp_path / "chats").mkdir()
    (tmp_path / "chats/a.md").write_text("\n".join([line(0, "客户", "怎么设置新的业务标签？"), line(1, "客服", "进入标签设置页面后新建标签并保存。")]))
    (tmp_path / "base.jsonl").write_text(json.dumps({"kb_id": "KB-0001", "question": "问", "answer": "答案"}) + "\n")
    state = ["--registry", f"file://{tmp_path}/registry"]
    assert main(["init", f"file://{tmp_path}/base.jsonl", "--count", "2", *state]) == 2
    assert main(["init", f"file://{tmp_path}/base.jsonl", "--count", "1", *state]) == 0
    assert main(["ingest", f"file://{tmp_path}/chats", "--analyze", "--dry-run", *state]) == 0
    assert main(["ingest", f"file://{tmp_path}/chats", "--analyze", *state]) == 0
    capsys.readouterr()
    assert main(["review", *state]) == 0
    found = json.loads(capsys.readouterr().out.strip())
    assert main(["review", "--approve", found["review_id"], *state]) == 0 and main(["review", "--reject", found["review_id"], *state]) == 1
    assert main(["publish", str(tmp_path / "releases"), "--version", "1.0.0", *state]) == 0
    assert main(["publish", str(tmp_path / "releases"), "--version", "1.0.0", *state]) == 2
    assert main(["validate-release", str(tmp_path / "releases/1.0.0")]) == 0


def test_prune_export_and_tables(spark, tmp_path):
    reg = Registry(spark, f"file://{tmp_path}/registry")
    bootstrap(reg, spark.createDataFrame([("KB-0002", "q", "a"), ("KB-0001", "q", "a")], "kb_id string, question string, answer string"))
    sinks.export_registry(reg.table("revisions"), f"file://{tmp_path}/export")
    assert [json.loads(r.value)["kb_id"] for r in spark.read.text(f"file://{tmp_path}/export").collect()] == ["KB-0001", "KB-0002"]
    assert prune(reg, "revisions", "kb_id", spark.createDataFrame([("KB-0001",), ("KB-0009",)], "kb_id string")) == 1
    assert [r.kb_id for r in reg.table("revisions").collect()] == ["KB-0002"] and reg.tables(1)["revisions"].count() == 2
    sinks.write_tables({"one": reg.table("revisions"), "two": reg.table("audit")}, f"file://{tmp_path}/book")
    assert {n: t.count() for n, t in tables(spark, f"file://{tmp_path}/book", "one", "two").items()} == {"one": 1, "two": 1}


def test_missing_vectors_go_to_the_supplement(spark, tmp_path):
    chunks = spark.createDataFrame([("a",), ("b",), ("c",)], "chunk_id string")
    vectors = spark.createDataFrame([("a", [1.0, 2.0])], "chunk_id string, embedding array<double>")
    path = f"file://{tmp_path}/supplement"
    embedded = lambda df: df.selectExpr("chunk_id", "array(0.5D, 0.5D) AS embedding")
    none = vectors.filter("false")
    assert sinks.append_new(embedded(layers.missing_vectors(chunks, vectors, none)), path, "chunk_id") == 2
    assert layers.missing_vectors(chunks, vectors, spark.read.parquet(path)).count() == 0
    whole = vectors.unionByName(spark.read.parquet(path))
    assert layers.embedding_violations(chunks, whole, 2).count() == 0
    bad = whole.unionByName(spark.createDataFrame([("z", [float("nan"), 1.0]), ("a", None)], whole.schema))
    assert {tuple(r) for r in layers.embedding_violations(chunks, bad, 2).collect()} == {("foreign_vector", "z"), ("not_finite", "z"), ("repeated_vector", "a"), ("wrong_dimension", "a")}
    links = spark.createDataFrame([], "video_id string, kb_id string")
    routes = spark.createDataFrame([("v", "https://x", "m", [1.0])], "video_id string, video_url string, model string, embedding array<double>")
    active = spark.createDataFrame([("KB-0001",)], "kb_id string")
    assert [tuple(r) for r in layers.route_violations(routes, links, active, "m").collect()] == [("one_without_the_other", "links")]
