"""Queries over whole tables against brute force."""

def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


TURNS = "conv_id long, turn int, role string, text string"


def plans():
    from threshmill.plans import registry  # needs a session

    return registry


def test_overlaps_of_all_rows(spark, tmp_path):
    lines, parts = [(1, 7, 3), (5000, 8, 53), (5000, 8, 4), (5001, 9, 60)], [(3, 1), (4, 40), (53, 40)]
    write(spark, tmp_path, "lineitem", lines, "l_orderkey long, l_suppkey long, l_partkey long")
    write(spark, tmp_path, "part", parts, "p_partkey long, p_size int")
    wanted = {}
    for s in {s for _, s, _ in lines}:
        for z in {z for _, z in parts}:
            n = len({p % 50 for _, t, p in lines if t == s} & {p % 50 for p, y in parts if y == z})
            wanted |= {(s, z): n} if n else {}
    got = plans().QUERIES["array_overlap_join"](spark, str(tmp_path)).collect()
    assert {(r.suppkey, r.size): r.shared for r in got} == wanted and (8, 40) in wanted


def test_evidence_and_chunks_of_all_turns(spark, tmp_path):
    rows = [(1, i, "user", f"quote {i}. more") for i in range(4)] + [(2, 1, "user", ".nothing")]
    write(spark, tmp_path, "conversations", rows, TURNS)
    got = plans().QUERIES["verbatim_evidence"](spark, str(tmp_path)).collect()
    assert {(r.conv_id, r.turn, r.quote) for r in got} == {(1, i, f"quote {i}") for i in range(4)}
    chunks = plans().QUERIES["rag_chunks"](spark, str(tmp_path)).collect()
    assert {r.chunk_id for r in chunks} == {f"{c}@r{t}" for c, t, *_ in rows}


def test_grounding_of_whole_answers(spark, tmp_path):
    rows = [(1, 0, "user", "first line\n\nthe third line"), (1, 1, "assistant", "x\ny\nthe third line"), (2, 0, "assistant", "no question")]
    write(spark, tmp_path, "conversations", rows, TURNS)
    grams = lambda t: {t[i : i + 2] for i in range(len(t) - 1)}
    own, source = grams("xythethirdline"), grams("firstlinethethirdline")
    got = plans().QUERIES["bigram_grounding"](spark, str(tmp_path)).collect()
    assert {(r.conv_id, r.turn): r.grounded for r in got} == {(1, 1): round(len(own & source) / len(own), 6), (2, 0): 0.0}


def test_groups_of_equal_questions(spark, tmp_path):
    rows = [(2, 0, "user", "How to?"), (2, 1, "assistant", "so"), (2, 2, "user", "how TO"), (2, 3, "assistant", "so"), (3, 0, "user", "a"), (3, 1, "assistant", "one"), (4, 0, "user", "A!"), (4, 1, "assistant", "two"), (5, 0, "user", "?!"), (5, 1, "user", "..."), (7, 0, "user", "once")]
    write(spark, tmp_path, "conversations", rows, TURNS)
    write(spark, tmp_path, "documents", [], "doc_id long, text string, source string")
    got = {r.question_normalized: r for r in plans().QUERIES["exact_question_groups"](spark, str(tmp_path)).collect()}
    assert set(got) == {"howto", "a"}
    same, differ = got["howto"], got["a"]
    assert (same.exact_group_id, same.member_count, same.answer_unique_count, same.group_type, same.needs_review, same.review_reasons) == ("GROUP-EXACT-0002", 2, 1, "same_question_same_answer", False, "")
    assert (differ.exact_group_id, differ.group_type, differ.needs_review, differ.review_reasons) == ("GROUP-EXACT-0001", "same_question_different_answer", True, "multiple_answers | crm_module_diff")
