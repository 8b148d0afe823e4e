import re

from difflib import SequenceMatcher

from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T
from threshmill.functions import vectors as V


def one(spark, *columns, **values):
    row = spark.createDataFrame([tuple(values.values())], [*values]) if values else spark.range(1)
    return tuple(row.select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_clean_and_normalize(spark):
    out = one(spark, T.clean_text("a"), T.normalize("b"), T.normalize_compact("c"), T.count_words("d"), a="　 中文 \n", b="中文 a_B!é", c="“你好”， A-b", d=" x  yy\tz")
    assert out == ("中文", "中文abé", "你好ab", 3)


def test_lines_and_title(spark):
    out = one(spark, T.lines("a"), T.extract_title("b", F.lit("f")), T.extract_title(F.lit("x"), F.lit("f")), a="a\r\nb\x0bc d\n", b="x\n# Head \ny")
    assert out == (["a", "b", "c", "d"], "Head", "f")


def test_times(spark):
    a, b = T.parse_timestamp(F.lit("2026/01/02 03:04")), T.parse_timestamp(F.lit("2026-01-02 05:04:00"))
    assert one(spark, T.minutes_between(a, b), T.parse_timestamp(F.lit("no")), T.month_key(a), T.duration(F.lit(125))) == (120.0, None, "2026-01", "02:05")


def test_grounding(spark):
    source = "客户可以在账号设置里修改客户账号"
    phrases = {"客户账号": True, "企业微信账号": False, "管理员账号": False, "客账": False}
    got = one(spark, *(T.grounded_phrase(F.lit(p), F.lit(source)) for p in phrases))
    assert got == tuple(phrases.values())
    assert one(spark, T.grounded_ratio(F.lit("客户账号"), F.lit(source)), T.grounded_ratio(F.lit(""), F.lit(source))) == (1.0, 0.0)


def test_similarities(spark):
    a, b = "怎么设置标签", "如何设置业务标签"
    got = one(spark, T.sequence_similarity(F.lit(a), F.lit(b)), T.bigram_jaccard(F.lit(a), F.lit(b)))
    assert got[0] == SequenceMatcher(None, a, b).ratio()
    x, y = ({s[i : i + 2] for i in range(len(s) - 1)} for s in (a, b))
    assert got[1] == len(x & y) / len(x | y)


def test_values(spark):
    out = one(spark, T.bool_value(F.lit(" Yes ")), T.confidence_value(F.lit("85%")), T.confidence_value(F.lit("high")), T.clamp01(F.lit("1.7")), T.clamp01(F.lit(None)), T.pair_key(F.lit("b"), F.lit("a")))
    assert out == (True, 85.0, 0.0, 1.0, 0.5, "a||b")
    assert one(spark, T.split_keys(F.lit(" a | |b ")), T.first_json(F.lit('x {"a":1} y')), T.strip_fences(F.lit('```json\n{"a":1}\n```'))) == (["a", "b"], '{"a":1}', '{"a":1}')


def test_patterns(spark):
    text = F.lit("请问怎么设置？ 电话13812345678 password: abc")
    assert one(spark, P.is_question(text), P.hits(text, P.QUESTION["zh"]), P.sensitive(text), P.is_noise(F.lit("好的"))) == (True, 3, ["phone", "api_key"], True)
    assert one(spark, P.sensitive(F.lit("9138123456789"))) == ([],)


def test_vectors(spark):
    v = F.array(F.lit(3.0), F.lit(4.0))
    zero = F.array(F.lit(0.0), F.lit(0.0))
    assert one(spark, V.cosine(v, v), V.cosine(v, zero), V.unit(v), V.unit(zero), V.checked(v, 2), V.checked(v, 3)) == (1.0, 0.0, [0.6, 0.8], [0.0, 0.0], True, False)


def test_equal_pairs_of_texts_are_compared_once(spark):
    """The ratio of a batch, and one Python function in a plan that asks for it twice."""
    rows = spark.createDataFrame([("abcd", "bcde"), ("abcd", "bcde"), (None, ""), ("x", None), ("same", "same")], "a string, b string")
    both = rows.select(T.sequence_similarity("a", "b").alias("r"), T.text_similarity("a", "b").alias("t"))
    assert [r.r for r in both.collect()] == [0.75, 0.75, 1.0, 0.0, 1.0]
    assert len(set(re.findall(r"_ratio\([^)]*\)+#\d+", both._jdf.queryExecution().optimizedPlan().toString()))) <= 1


def test_comparisons_are_spread_over_tasks(spark, sf_dir):
    from threshmill.plans import conversations, scalars

    for name in (conversations.title_similarity, scalars.issue_similarity):
        assert "REPARTITION_BY_NUM" in name(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
