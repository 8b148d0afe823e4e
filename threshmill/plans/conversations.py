"""Messages, speakers, issues and their provenance over conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T
from threshmill.operators import guards, incremental, messages, segments
from threshmill.plans.base import numbered, query, read

ROLES = {"user": "customer", "assistant": "support", "system": "internal"}
#: Patterns that fit the invented prose, in place of the Chinese packs.
PACK = {"question": ("the ", "que ", "die "), "answer": (" of ", " de ", " der "), "internal": ("system", r"\.\n")}
_ROLE_SQL = "CASE role WHEN 'user' THEN 'customer' WHEN 'assistant' THEN 'support' WHEN 'system' THEN 'internal' ELSE 'unknown' END"
_MESSAGES_SQL = f"""
m AS (SELECT conv_id, turn, role || '-' || (conv_id % 40) AS speaker, {_ROLE_SQL} AS speaker_role, text AS content, role = 'user' AS is_question,
 sha256('{{"content":' || to_json(text) || ',"line_number":' || turn || ',"speaker":' || to_json(role) || '}}') AS h FROM conversations)"""


def chat(spark, sf):
    c = read(spark, sf, "conversations")
    role = F.coalesce(F.create_map(*(F.lit(x) for kv in ROLES.items() for x in kv))[F.col("role")], F.lit("unknown"))
    speaker = F.concat_ws("-", "role", (F.col("conv_id") % 40).cast("string"))
    return c.select("conv_id", "turn", "role", speaker.alias("speaker"), role.alias("speaker_role"), F.col("text").alias("content"), (F.col("role") == "user").alias("is_question"))


@query("""
WITH m AS (SELECT conv_id, turn, role = 'user' AS q, text AS content, sha256(conv_id || '/' || turn || '/' || role || '/' || text) AS h,
 row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations),
f AS (SELECT *, i // 30 AS block, min(i) FILTER (q) OVER (PARTITION BY conv_id, i // 30) AS first_q FROM m)
SELECT conv_id, block::INT AS block, min(i)::INT AS start_index, max(i)::INT AS end_index, max(content) FILTER (i = first_q) AS question,
 coalesce(string_agg(content, chr(10) ORDER BY i) FILTER (i > first_q), '') AS answer,
 'ISS-' || substring(sha256(conv_id || chr(0) || string_agg(h, chr(0) ORDER BY i)), 1, 20) AS issue_id
FROM f WHERE first_q IS NOT NULL GROUP BY conv_id, block
""")
def conversation_issues_fixed_blocks(spark, sf):
    """Issues of blocks of 30 messages: first question, what follows, and a fingerprint."""
    m = chat(spark, sf).withColumn("message_sha256", T.sha256(F.concat_ws("/", "conv_id", "turn", "role", "content")))
    return segments.fixed_blocks(m, "conv_id", "turn")


@query("""
SELECT role || '-' || (conv_id % 40) AS speaker, count(*) AS message_count, count(DISTINCT conv_id) AS document_count FROM conversations GROUP BY 1
""")
def speaker_profile(spark, sf):
    return messages.speaker_profile(chat(spark, sf).withColumnRenamed("conv_id", "source"))


def features(spark, sf):
    c = F.col("content")
    rows = chat(spark, sf).select("speaker", F.col("conv_id").alias("source"), F.length("content").alias("n"), *((P.hits(c, PACK[k]) > 0).cast("int").alias(k[0]) for k in PACK))
    out = rows.groupBy("speaker").agg(F.count("*").alias("message_count"), F.countDistinct("source").alias("document_count"), F.avg("n").alias("avg_message_length"), F.sum("q").alias("question_count"), F.sum("a").alias("answer_like_count"), F.sum("i").alias("internal_like_count"))
    return out.select("*", T.safe_ratio("question_count", "message_count").alias("question_ratio"), T.safe_ratio("answer_like_count", "message_count").alias("answer_ratio"), T.safe_ratio("internal_like_count", "message_count").alias("internal_ratio"))


_FEATURES_SQL = r"""
f AS (SELECT speaker, count(*) AS message_count, count(DISTINCT conv_id) AS document_count, avg(length(content)) AS avg_message_length, sum(q)::BIGINT AS question_count, sum(a)::BIGINT AS answer_like_count, sum(i)::BIGINT AS internal_like_count,
 sum(q) / count(*) AS question_ratio, sum(a) / count(*) AS answer_ratio, sum(i) / count(*) AS internal_ratio FROM (
 SELECT role || '-' || (conv_id % 40) AS speaker, conv_id, text AS content, regexp_matches(text, 'the |que |die ')::INT AS q, regexp_matches(text, ' of | de | der ')::INT AS a, regexp_matches(text, 'system|\.\n')::INT AS i FROM conversations) GROUP BY speaker)"""


@query(f"WITH {_FEATURES_SQL} SELECT * REPLACE (round(avg_message_length, 6) AS avg_message_length, round(question_ratio, 6) AS question_ratio, round(answer_ratio, 6) AS answer_ratio, round(internal_ratio, 6) AS internal_ratio) FROM f")
def speaker_features(spark, sf):
    out = features(spark, sf)
    return out.withColumns({c: F.round(c, 6) for c in ("avg_message_length", "question_ratio", "answer_ratio", "internal_ratio")})


_SCORES_SQL = f"""WITH {_FEATURES_SQL}, s AS (SELECT *,
 CASE WHEN document_count >= 100 THEN 6 WHEN document_count >= 50 THEN 5 WHEN document_count >= 20 THEN 4 WHEN document_count >= 10 THEN 2.5 WHEN document_count >= 5 THEN 1 ELSE 0 END
 + CASE WHEN message_count >= 5000 THEN 3 WHEN message_count >= 1000 THEN 2.5 WHEN message_count >= 500 THEN 2 WHEN message_count >= 200 THEN 1 ELSE 0 END + CASE WHEN question_ratio <= 0.08 THEN 1 ELSE 0 END
 + CASE WHEN answer_ratio >= 0.4 THEN 4 WHEN answer_ratio >= 0.25 THEN 3 WHEN answer_ratio >= 0.15 THEN 1.5 ELSE 0 END AS sup,
 CASE WHEN document_count <= 2 THEN 1.5 ELSE 0 END + CASE WHEN message_count <= 10 THEN 0.3 ELSE 0 END + CASE WHEN question_ratio >= 0.5 THEN 4 WHEN question_ratio >= 0.35 THEN 3 WHEN question_ratio >= 0.2 THEN 1.5 ELSE 0 END
 + CASE WHEN document_count <= 3 AND question_ratio >= 0.2 THEN 2 ELSE 0 END AS cust,
 CASE WHEN internal_ratio >= 0.3 THEN 5 WHEN internal_ratio >= 0.2 THEN 4 WHEN internal_ratio >= 0.1 THEN 2.5 WHEN internal_ratio >= 0.05 THEN 1 ELSE 0 END + CASE WHEN document_count >= 10 AND internal_ratio >= 0.1 THEN 2 ELSE 0 END AS intr FROM f)"""


@query(_SCORES_SQL + " SELECT speaker, sup::DOUBLE AS support_score, cust::DOUBLE AS customer_score, intr::DOUBLE AS internal_score FROM s")
def speaker_role_scores(spark, sf):
    return messages.role_scores(features(spark, sf)).select("speaker", "support_score", "customer_score", "internal_score")


@query(_SCORES_SQL + """, r AS (SELECT *, greatest(sup, cust, intr) AS top, list_sort([sup, cust, intr])[2] AS second FROM s), b AS (SELECT *, CASE WHEN sup = top THEN 'support' WHEN cust = top THEN 'customer' ELSE 'internal' END AS best FROM r)
 SELECT speaker, CASE WHEN contains(speaker, 'support') THEN 'support' WHEN contains(speaker, 'internal') THEN 'internal' WHEN message_count < 5 THEN 'unknown' WHEN document_count >= 50 THEN 'support'
 WHEN best = 'internal' AND (message_count < 20 OR internal_ratio < 0.15 OR intr < 4 OR intr - sup < 1.5) THEN 'unknown'
 WHEN best <> 'internal' AND (top < 2 OR top - second < 1 OR (best = 'support' AND message_count < 15 AND document_count < 5)) THEN 'unknown' ELSE best END AS suggested_role FROM b""")
def speaker_role_labels(spark, sf):
    return messages.role_scores(features(spark, sf)).select("speaker", messages.suggested_role().alias("suggested_role"))


@query("""
SELECT conv_id, turn, (text IN ('', 'ok', 'okay', 'yes', 'no', 'thanks', 'thank you', 'got it', 'hi', 'hello') OR length(text) <= 1 OR regexp_full_match(text, '@[^ \\t\\n\\r\\f]+')) AS is_noise,
 regexp_matches(text, '[?]|the |que |die ') AS is_question FROM conversations
""")
def message_predicates(spark, sf):
    c = F.col("text")
    return read(spark, sf, "conversations").select("conv_id", "turn", P.is_noise(c, "en").alias("is_noise"), P.any_of(c, ("[?]", *PACK["question"])).alias("is_question"))


@query("""
WITH q AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations)
SELECT conv_id, count(*) AS turns, string_agg(DISTINCT role, ' | ' ORDER BY role) AS roles, min(n)::INT AS shortest, max(n)::INT AS longest, round(avg(n), 6) AS mean FROM q GROUP BY conv_id
""")
def conversation_summaries(spark, sf):
    """Group summary with distinct values joined, and numeric statistics."""
    q = read(spark, sf, "conversations").select("conv_id", "role", F.length("text").alias("n"))
    return q.groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_join(F.array_sort(F.collect_set("role")), " | ").alias("roles"), F.min("n").alias("shortest"), F.max("n").alias("longest"), F.round(F.avg("n"), 6).alias("mean"))


def asked_and_answered(spark, sf):
    """Turns with the text of the last user turn before them and of the turn after them, if that is an assistant's."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.last(F.when(F.col("role") == "user", F.col("text")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.when(F.lead("role").over(order) == "assistant", F.lead("text").over(order))
    return read(spark, sf, "conversations").select("conv_id", "turn", "role", "text", before.alias("question"), after.alias("answer"))


def spread(spark, turns):
    """Turns dealt apart from their conversations: comparing texts takes long, so neither a long conversation nor a small shuffle may end in few tasks."""
    return turns.repartition(8 * spark.sparkContext.defaultParallelism, "conv_id", "turn")


@query()
def title_similarity(spark, sf):
    """Ratcliff-Obershelp and bigram similarity of each answer with its question, whole text against whole text."""
    rows = spread(spark, asked_and_answered(spark, sf).filter("role = 'assistant'")).select("conv_id", "turn", F.col("text").alias("a"), F.coalesce("question", F.lit("")).alias("b"))
    return rows.select("conv_id", "turn", F.round(T.sequence_similarity("a", "b"), 6).alias("sequence"), F.round(T.text_similarity("a", "b"), 6).alias("similarity"))


_NORMAL = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"
_BIGRAMS = "list_distinct([substring({c}, i, 2) FOR i IN range(1, greatest(length({c}), 2))])"


@query(f"""WITH t AS (SELECT conv_id, turn, role, text, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS question FROM conversations),
p AS (SELECT conv_id, turn, {_NORMAL.format("coalesce(text, '')")} AS a, {_NORMAL.format("coalesce(question, '')")} AS b FROM t WHERE role = 'assistant')
SELECT conv_id, turn, CASE WHEN length(a) = 0 THEN 0.0 ELSE round(len(list_intersect({_BIGRAMS.format(c='a')}, {_BIGRAMS.format(c='b')})) / len({_BIGRAMS.format(c='a')}), 6) END::DOUBLE AS grounded FROM p""")
def bigram_grounding(spark, sf):
    """Share of each answer's bigrams that its question has, whole text against whole text."""
    rows = asked_and_answered(spark, sf).filter("role = 'assistant'")
    whole = lambda c: T.normalize(F.coalesce(c, F.lit("")))
    rows = rows.select("conv_id", "turn", whole("text").alias("a"), whole("question").alias("b"))
    return rows.select("conv_id", "turn", F.round(T.grounded_ratio("a", "b"), 6).alias("grounded"))


_DIFFS = ("resolution", "temporal_status", "knowledge_value", "crm_module", "needs_followup")


@query(f"""WITH c AS (SELECT conv_id, role, text, CASE WHEN lead(role) OVER w = 'assistant' THEN lead(text) OVER w END AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
t AS (SELECT * FROM c UNION ALL SELECT doc_id, 'user', text, source FROM documents), r AS (SELECT {_NORMAL.format('text')} AS q, trim(answer, ' ' || chr(9) || chr(10) || chr(13)) AS answer, CASE WHEN answer IS NOT NULL THEN 'answered' ELSE 'open' END AS resolution, CASE WHEN conv_id % 6 = 0 THEN 'low' ELSE 'high' END AS knowledge_value,
 CASE WHEN conv_id % 8 = 0 THEN 'future_plan' WHEN conv_id % 8 = 1 THEN 'historical' ELSE 'stable' END AS temporal_status, (conv_id % 5 = 0)::VARCHAR AS needs_followup, 'm' || (conv_id % 3) AS crm_module FROM t WHERE role = 'user'),
g AS (SELECT q, count(*) AS member_count, count(DISTINCT nullif(answer, ''))::INT AS answers, {', '.join(f"string_agg(DISTINCT {d}, ' | ' ORDER BY {d}) AS {d}_set, count(DISTINCT {d}) AS {d}_n" for d in _DIFFS)} FROM r WHERE q <> '' GROUP BY q HAVING count(*) > 1),
x AS (SELECT *, list_filter([CASE WHEN answers > 1 THEN 'multiple_answers' END, {', '.join(f"CASE WHEN {d}_n > 1 THEN '{d}_diff' END" for d in _DIFFS)}], lambda z: z IS NOT NULL) AS reasons FROM g)
SELECT printf('GROUP-EXACT-%04d', row_number() OVER (ORDER BY q)) AS exact_group_id, q AS question_normalized, member_count, answers AS answer_unique_count, CASE WHEN answers = 1 THEN 'same_question_same_answer' WHEN answers > 1 THEN 'same_question_different_answer' ELSE 'same_question_mixed' END AS group_type,
 len(reasons) > 0 AS needs_review, array_to_string(reasons, ' | ') AS review_reasons, {', '.join(f'{d}_set' for d in _DIFFS)} FROM x""")
def exact_question_groups(spark, sf):
    """Groups of user turns and documents with equal normalised text: unique values, type and reasons for a review.

    Solution, resolution and the like are judgements that the conversations do not have; some stand in by conv_id.
    """
    c = F.col("conv_id")
    imported = read(spark, sf, "documents").select(F.col("doc_id").alias("conv_id"), "text", F.col("source").alias("answer"))
    rows = asked_and_answered(spark, sf).filter("role = 'user'").select("conv_id", "text", "answer").unionByName(imported).withColumn("question_normalized", T.normalize("text")).filter("question_normalized <> ''")
    rows = rows.withColumns({
        "resolution": F.when(F.col("answer").isNotNull(), "answered").otherwise("open"), "knowledge_value": F.when(c % 6 == 0, "low").otherwise("high"),
        "temporal_status": F.when(c % 8 == 0, "future_plan").when(c % 8 == 1, "historical").otherwise("stable"), "needs_followup": (c % 5 == 0).cast("string"), "crm_module": F.concat(F.lit("m"), (c % 3).cast("string")),
    })
    diffs = _DIFFS
    uniques = (F.array_sort(F.filter(F.collect_set(T.clean_text(x)), lambda v: v != "")).alias(f"{x}_set") for x in ("answer", *diffs))
    g = rows.groupBy("question_normalized").agg(F.count("*").alias("member_count"), *uniques).filter("member_count > 1")
    many = {"multiple_answers": F.size("answer_set") > 1} | {f"{x}_diff": F.size(f"{x}_set") > 1 for x in diffs}
    g = g.withColumns({"answer_unique_count": F.size("answer_set"), "review_reasons": P.flags(**many)})
    kind = P.ladder((F.col("answer_unique_count") == 1, "same_question_same_answer"), (F.col("answer_unique_count") > 1, "same_question_different_answer"), otherwise="same_question_mixed")
    g = numbered(g.withColumns({"group_type": kind, "needs_review": F.size("review_reasons") > 0}), "question_normalized")
    sets = (T.join_list(f"{x}_set").alias(f"{x}_set") for x in diffs)
    return g.select(F.format_string("GROUP-EXACT-%04d", "row_no").alias("exact_group_id"), "question_normalized", "member_count", "answer_unique_count", "group_type", "needs_review", T.join_list("review_reasons").alias("review_reasons"), *sets)


@query("""
WITH c AS (SELECT conv_id, role, count(*) AS n, min(turn) AS first FROM conversations GROUP BY 1, 2)
SELECT conv_id, role AS modal_role, n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, first) AS r FROM c) WHERE r = 1
""")
def modal_value(spark, sf):
    """Mode with the first seen winning ties."""
    c = read(spark, sf, "conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n"), F.min("turn").alias("first"))
    r = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("n"), "first"))
    return c.withColumn("r", r).filter("r = 1").select("conv_id", F.col("role").alias("modal_role"), "n")


@query("""
SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS r FROM conversations) WHERE r = 1
""")
def last_write_wins(spark, sf):
    rows = read(spark, sf, "conversations").withColumn("key", F.struct("conv_id", "role"))
    return incremental.last_write_wins(rows, "key", "turn").select("conv_id", "turn", "role", "text")


def versions(spark, sf):
    """Two states of the conversations: every fourth is unchanged, appended to, cut in its text, or moved; some are gone or new."""
    m = chat(spark, sf).select(F.col("conv_id").cast("string").alias("source"), F.col("turn").alias("idx"), T.sha256(F.concat_ws("/", "turn", "role", "content")).alias("message_sha256"), "conv_id")
    kind = F.col("conv_id") % 7
    last = F.max("idx").over(Window.partitionBy("source"))
    old = m.withColumn("last", last).filter((kind != 6) & ~((kind == 1) & (F.col("idx") == F.col("last")))).drop("last")
    new = m.filter(kind != 5).withColumn("source", F.when(kind == 3, F.concat("source", F.lit("-moved"))).otherwise(F.col("source")))
    new = new.withColumn("message_sha256", F.when((kind == 2) & (F.col("idx") == 1), F.lit("changed")).otherwise(F.col("message_sha256")))
    return incremental.chained(old), incremental.chained(new)


_VERSIONS_SQL = """
m AS (SELECT conv_id, conv_id::VARCHAR AS source, turn AS idx, sha256(turn || '/' || role || '/' || text) AS h, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations),
o AS (SELECT source, list(h ORDER BY idx) AS hs FROM m WHERE conv_id % 7 <> 6 AND NOT (conv_id % 7 = 1 AND idx = last) GROUP BY source),
n AS (SELECT CASE WHEN conv_id % 7 = 3 THEN source || '-moved' ELSE source END AS source, list(CASE WHEN conv_id % 7 = 2 AND idx = 1 THEN 'changed' ELSE h END ORDER BY idx) AS hs FROM m WHERE conv_id % 7 <> 5 GROUP BY 1),
e AS (SELECT hs, min(source) AS moved_from FROM o GROUP BY hs),
c AS (SELECT n.source, n.hs AS nh, o.hs AS oh, CASE WHEN o.hs = n.hs THEN 'unchanged' WHEN o.hs IS NULL AND e.moved_from IS NOT NULL THEN 'moved' WHEN o.hs IS NOT NULL AND n.hs[1:len(o.hs)] = o.hs THEN 'appended' WHEN o.hs IS NOT NULL THEN 'modified' ELSE 'new' END AS change,
 e.moved_from FROM n LEFT JOIN o USING (source) LEFT JOIN e ON e.hs = n.hs)"""


@query(f"WITH {_VERSIONS_SQL} SELECT source, change, CASE WHEN change = 'moved' THEN moved_from END AS moved_from, coalesce(len(oh), 0)::INT AS old_count, len(nh)::INT AS new_count FROM c")
def change_classification(spark, sf):
    return incremental.classify(*versions(spark, sf)).select("source", "change", "moved_from", "old_count", "new_count")


@query(f"WITH {_VERSIONS_SQL} SELECT change, count(*) AS files FROM (SELECT change FROM c UNION ALL SELECT 'deleted' FROM o WHERE source NOT IN (SELECT source FROM n) AND source NOT IN (SELECT moved_from FROM c WHERE change = 'moved')) GROUP BY change")
def change_counts(spark, sf):
    old, new = versions(spark, sf)
    changes = incremental.classify(old, new)
    gone = incremental.deleted(incremental.source_heads(old), new, changes).select(F.lit("deleted").alias("change"))
    return changes.select("change").unionByName(gone).groupBy("change").agg(F.count("*").alias("files"))


@query(f"""WITH {_VERSIONS_SQL}, s AS (SELECT source, change, CASE change WHEN 'appended' THEN greatest(0, len(oh) - 2) WHEN 'new' THEN 0 WHEN 'modified' THEN greatest(0, list_min([i FOR i IN range(0, greatest(len(oh), len(nh)) + 1) IF nh[i + 1] IS DISTINCT FROM oh[i + 1]]) - 2) END AS base FROM c),
i AS (SELECT source, unnest([0, 2, 4]) AS a, len(hs) AS k FROM o), j AS (SELECT source, a, least(a + 1, k - 1) AS b FROM i WHERE a < k)
SELECT s.source, s.change, least(base, (SELECT min(a) FROM j WHERE j.source = s.source AND j.b >= s.base))::INT AS affected_start FROM s""")
def affected_suffix(spark, sf):
    """Where recomputing starts, with an overlap of 2 and issues of two messages."""
    old, new = versions(spark, sf)
    a = F.explode(F.array(F.lit(0), F.lit(2), F.lit(4)))
    issues = incremental.source_heads(old).select("source", F.col("n").alias("k"), a.alias("start_index")).filter("start_index < k").select("source", "start_index", F.least(F.col("start_index") + 1, F.col("k") - 1).alias("end_index"), F.lit("active").alias("status"))
    return incremental.affected_start(incremental.classify(old, new), issues, overlap=2).select("source", "change", "affected_start")


@query("""
WITH e AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn, role FROM conversations),
k AS (SELECT conv_id, role, rn, turn AS idx FROM e WHERE role <> 'system')
SELECT k.conv_id, k.role, k.rn::INT AS rn, k.idx, length(c.text)::INT AS chars FROM k JOIN e c ON c.conv_id = k.conv_id AND c.role = k.role AND c.rn = k.rn
""")
def provenance_3hop(spark, sf):
    """The k-th row of a key meets the k-th record of that key, then its message."""
    e = read(spark, sf, "conversations").withColumn("rn", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")))
    k = e.filter("role <> 'system'").select("conv_id", "role", "rn", F.col("turn").alias("idx"))
    m = read(spark, sf, "conversations").select("conv_id", F.col("turn").alias("idx"), F.length("text").alias("chars"))
    return k.join(m, ["conv_id", "idx"]).select("conv_id", "role", "rn", "idx", "chars")


@query("""
SELECT conv_id, turn, list_filter([CASE WHEN length(text) < 200 THEN 'A3_SHORT_ANSWER' END, CASE WHEN conv_id % 5 = 0 THEN 'A1_LOW_CONFIDENCE' END, CASE WHEN conv_id % 9 = 0 THEN 'B1_STALE' END], lambda x: x IS NOT NULL) AS reasons
FROM conversations WHERE role = 'assistant'
""")
def hard_filter_flags(spark, sf):
    rows = read(spark, sf, "conversations").filter("role = 'assistant'")
    return rows.select("conv_id", "turn", P.flags(A3_SHORT_ANSWER=F.length("text") < 200, A1_LOW_CONFIDENCE=F.col("conv_id") % 5 == 0, B1_STALE=F.col("conv_id") % 9 == 0).alias("reasons"))


@query("""
WITH r AS (SELECT conv_id, turn, text AS answer, (conv_id % 10) / 10.0 AS confidence, CASE WHEN conv_id % 6 = 0 THEN 'low' ELSE 'high' END AS knowledge_value, CASE conv_id % 8 WHEN 0 THEN 'future_plan' WHEN 1 THEN 'historical' ELSE 'stable' END AS temporal_status,
 CASE WHEN conv_id % 4 = 0 THEN NULL ELSE '2025-0' || (1 + conv_id % 9) || '-01' END AS d FROM conversations WHERE role = 'assistant'),
f AS (SELECT conv_id, turn, unnest([{'k': 'A1_LOW_CONFIDENCE', 'h': confidence < 0.7}, {'k': 'A2_LOW_VALUE', 'h': knowledge_value = 'low'}, {'k': 'A3_SHORT_ANSWER', 'h': length(answer) < 20}, {'k': 'A4_FUTURE_PLAN', 'h': temporal_status = 'future_plan'},
 {'k': 'A5_HISTORICAL', 'h': temporal_status = 'historical'}, {'k': 'B1_STALE', 'h': coalesce(d, '9999') < '2025-08-06'}]) AS x FROM r)
SELECT x.k AS reason, count(*) AS rows FROM f WHERE x.h GROUP BY 1
""")
def funnel_counts(spark, sf):
    c = F.col("conv_id")
    rows = read(spark, sf, "conversations").filter("role = 'assistant'").select(
        F.col("text").alias("answer"), ((c % 10) / F.lit(10.0)).alias("confidence"), F.when(c % 6 == 0, "low").otherwise("high").alias("knowledge_value"),
        F.when(c % 8 == 0, "future_plan").when(c % 8 == 1, "historical").otherwise("stable").alias("temporal_status"), F.when(c % 4 != 0, F.concat(F.lit("2025-0"), (1 + c % 9).cast("string"), F.lit("-01"))).alias("issue_date"),
    )
    return rows.select(F.explode(guards.layer_a_flags("2025-08-06", missing_is_stale=True)).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@query("""
SELECT conv_id || '@r' || turn AS chunk_id, '问题：' || role || chr(10) || '答案：' || text AS text, length('问题：' || role || chr(10) || '答案：' || text)::INT AS chars FROM conversations
""")
def rag_chunks(spark, sf):
    """A chunk of every turn."""
    return chunks(read(spark, sf, "conversations"))


def chunks(rows):
    text = T.chunk_text("role", "text")
    return rows.select(F.format_string("%d@r%d", "conv_id", "turn").alias("chunk_id"), text.alias("text"), F.length(text).alias("chars"))
