"""Scalar functions over whole tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from threshmill.functions import text as T
from threshmill.operators import incremental
from threshmill.plans.base import query, read

_TURNS = "SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN NULL ELSE '　 ' || text || ' ' || chr(9) END AS x FROM conversations"


@query(f"SELECT conv_id, turn, coalesce(trim(x, ' 　' || chr(9) || chr(10) || chr(13)), '') AS clean FROM ({_TURNS})")
def clean_texts(spark, sf):
    """Null is empty, and edges lose space of any kind."""
    padded = F.when(F.col("turn") % 5 == 4, None).otherwise(F.concat(F.lit("　 "), "text", F.lit(" \t")))
    return read(spark, sf, "conversations").select("conv_id", "turn", T.clean_text(padded).alias("clean"))


_MARKS = r"，。！？；：、,.!?;:\-_()（）\[\]【】"


@query(rf"""SELECT conv_id, turn, lower(regexp_replace(text, '[\s{_MARKS}"''“”‘’]+', '', 'g')) AS compact, lower(regexp_replace(text, '[\s{_MARKS}]+', '', 'g')) AS quoted, regexp_replace(text, '[\s{_MARKS}"''“”‘’]+', '', 'g') AS cased FROM conversations""")
def compact_texts(spark, sf):
    """The comparison normalisers: without marks and quotes, with quotes, and with case kept."""
    return read(spark, sf, "conversations").select("conv_id", "turn", T.normalize_compact("text").alias("compact"), T.normalize_compact("text", quotes=False).alias("quoted"), T.normalize_compact("text", lower=False).alias("cased"))


@query("""SELECT conv_id, turn, sha256('{"content":' || to_json(text)::VARCHAR || ',"line_number":' || turn || ',"speaker":"' || role || '","timestamp":"t' || conv_id || '"}') AS message_sha256 FROM conversations""")
def message_hashes(spark, sf):
    """The identity of a message: the hash of its canonical JSON."""
    fields = {"content": F.col("text"), "line_number": F.col("turn"), "speaker": F.col("role"), "timestamp": F.concat(F.lit("t"), F.col("conv_id").cast("string"))}
    return read(spark, sf, "conversations").select("conv_id", "turn", T.sha256(T.canonical_json(**fields)).alias("message_sha256"))


_FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y/%m/%d %H:%M:%S", "%Y/%m/%d %H:%M")


@query(f"""SELECT o_orderkey, CASE o_orderkey % 5 {' '.join(f"WHEN {i} THEN strptime(strftime(o_orderdate, '{f}'), '{f}')" for i, f in enumerate(_FORMATS))} END AS at, CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m') END AS month FROM orders""")
def parsed_timestamps(spark, sf):
    """Times in four formats and in none of them."""
    k, shown = F.col("o_orderkey") % 5, F.lit("no time")
    for i, f in enumerate(T.TIMESTAMP_FORMATS):
        shown = F.when(k == i, F.date_format("o_orderdate", f)).otherwise(shown)
    rows = read(spark, sf, "orders").select("o_orderkey", T.parse_timestamp(shown).alias("at"))
    return rows.select("o_orderkey", F.col("at").cast("timestamp_ntz").alias("at"), T.month_key("at").alias("month"))


@query("SELECT o_orderkey, printf('%02d:%02d', trunc(o_totalprice)::BIGINT // 60, trunc(o_totalprice)::BIGINT % 60) AS shown, CASE WHEN o_orderkey % 4 = 0 THEN 0.0 ELSE round(o_custkey / (o_orderkey % 4)::DOUBLE, 6) END AS ratio FROM orders")
def durations_and_ratios(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", T.duration("o_totalprice").alias("shown"), F.round(T.safe_ratio(F.col("o_custkey"), F.col("o_orderkey") % 4), 6).alias("ratio"))


_ANSWER = """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '```json' || chr(10) || '{"n": ' || n_chars || '}' || chr(10) || '```' WHEN 1 THEN 'Here: [' || n_chars || ', 2] done' ELSE 'none' END AS x FROM documents"""


@query(rf"""SELECT doc_id, trim(regexp_replace(regexp_replace(x, '^```[a-z]*' || chr(10), ''), chr(10) || '```$', ''), ' ' || chr(10)) AS bare, regexp_extract(x, '(?s)\{{.*\}}') AS object, regexp_extract(x, '(?s)\[.*\]') AS list FROM ({_ANSWER})""")
def fenced_answers(spark, sf):
    """A model's answer without its fence, and the JSON in it."""
    d, n = F.col("doc_id") % 3, F.col("n_chars").cast("string")
    x = F.when(d == 0, F.concat(F.lit('```json\n{"n": '), n, F.lit("}\n```"))).when(d == 1, F.concat(F.lit("Here: ["), n, F.lit(", 2] done"))).otherwise("none")
    return read(spark, sf, "documents").select("doc_id", x.alias("x")).select("doc_id", T.strip_fences("x").alias("bare"), T.first_json("x").alias("object"), T.first_json("x", array=True).alias("list"))


@query("""SELECT doc_id, doc_id % 5 IN (0, 1, 2) AS yes, CASE doc_id % 3 WHEN 0 THEN 85.0 WHEN 1 THEN 0.7 ELSE 0.0 END::DOUBLE AS confidence, CASE WHEN source = lang THEN source ELSE source || ' | ' || lang END AS joined FROM documents""")
def loose_values(spark, sf):
    """Truth values, confidences and lists as people write them."""
    d = F.col("doc_id")
    yes = F.when(d % 5 == 0, "Yes").when(d % 5 == 1, " true ").when(d % 5 == 2, "1").when(d % 5 == 3, "no")
    confidence = F.when(d % 3 == 0, "85%").when(d % 3 == 1, " 0.7 ").otherwise("high")
    return read(spark, sf, "documents").select("doc_id", T.bool_value(yes).alias("yes"), T.confidence_value(confidence).alias("confidence"), T.join_list(T.unique_nonempty(F.array("source", F.lit(""), "source", F.lit(None).cast("string"), "lang"))).alias("joined"))


_GRAMS = "list_distinct([substring({c}, i, {n}) FOR i IN range(1, greatest(length({c}) - {n} + 2, 2), {stride})])"
_BIGRAMS = "list_filter(" + _GRAMS.format(c="{c}", n=2, stride=1) + ", lambda g: length(g) = 2 AND NOT regexp_matches(g, '[ae]'))"


@query(f"""WITH t AS (SELECT item_id, text, reverse(text) AS back, substring(text, length(text) // 4 + 1, length(text) // 2) AS inner_text FROM benchmark)
SELECT item_id, round(len(list_intersect({_GRAMS.format(c='inner_text', n=25, stride=5)}, {_GRAMS.format(c='text', n=25, stride=1)})) / len({_GRAMS.format(c='inner_text', n=25, stride=5)}), 6) AS inner_coverage,
 len({_GRAMS.format(c='text', n=3, stride=2)})::INT AS n_shingles, len({_BIGRAMS.format(c='text')})::INT AS n_content, round(len(list_intersect({_GRAMS.format(c='text', n=2, stride=1)}, {_GRAMS.format(c='back', n=2, stride=1)})) / len(list_distinct(list_concat({_GRAMS.format(c='text', n=2, stride=1)}, {_GRAMS.format(c='back', n=2, stride=1)}))), 6) AS jaccard FROM t""")
def shingle_coverage(spark, sf):
    """Shingles at a stride, how much of a text's middle the text covers, content bigrams, and bigram similarity."""
    t = read(spark, sf, "benchmark").select("item_id", "text", F.reverse("text").alias("back"), F.expr("substring(text, length(text) div 4 + 1, length(text) div 2)").alias("inner_text"))
    return t.select("item_id", F.round(T.coverage("inner_text", "text"), 6).alias("inner_coverage"), F.size(T.shingles("text", 3, 2)).alias("n_shingles"), F.size(T.content_bigrams("text", "ae")).alias("n_content"), F.round(T.bigram_jaccard("text", "back"), 6).alias("jaccard"))


_CHARS = "list_distinct(string_split({c}, ''))"


@query(rf"""WITH t AS (SELECT p_partkey, lower(regexp_replace(CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_brand END, '[\s{_MARKS}"''“”‘’]+', '', 'g')) AS p, lower(regexp_replace(p_name || p_type, '[\s{_MARKS}"''“”‘’]+', '', 'g')) AS s FROM part),
x AS (SELECT *, len(list_intersect({_CHARS.format(c='p')}, {_CHARS.format(c='s')})) / len({_CHARS.format(c='p')}) AS share, len(list_intersect({_GRAMS.format(c='p', n=2, stride=1)}, {_GRAMS.format(c='s', n=2, stride=1)})) > 0 AS bigram FROM t)
SELECT p_partkey, length(p) > 0 AND (contains(s, p) OR (length(p) >= 6 AND share >= 0.85) OR (length(p) < 6 AND share = 1.0 AND bigram)) AS grounded FROM x""")
def grounded_phrase(spark, sf):
    """Whether a part's type or brand is grounded in its name and type."""
    phrase = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(F.col("p_brand"))
    return read(spark, sf, "part").select("p_partkey", T.grounded_phrase(phrase, F.concat("p_name", "p_type")).alias("grounded"))


@query("""SELECT o_orderkey, least(o_orderpriority, o_orderstatus) || '||' || greatest(o_orderpriority, o_orderstatus) AS pair, CASE WHEN o_orderkey % 3 = 0 THEN printf('ROW-%05d', o_orderkey + 1) WHEN o_orderkey % 3 = 1 THEN 'C' || o_custkey || '#' || printf('ROW-%05d', o_orderkey + 1) ELSE 'C' || o_custkey || '#' || o_orderstatus END AS issue,
 o_orderkey % 4 <> 0 AS semver FROM orders""")
def issue_keys(spark, sf):
    """Keys of pairs and issues, and versions of three numbers."""
    k, who = F.col("o_orderkey"), F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    candidate, seq = F.when(k % 3 == 0, " ").otherwise(who), F.when(k % 3 == 2, F.col("o_orderstatus"))
    version = F.when(k % 4 == 0, F.concat(F.lit("v1."), k.cast("string"))).otherwise(F.concat(F.lit("1.0."), k.cast("string")))
    return read(spark, sf, "orders").select("o_orderkey", T.pair_key("o_orderpriority", "o_orderstatus").alias("pair"), T.issue_key(candidate, seq, "o_orderkey").alias("issue"), T.is_semver(version).alias("semver"))


@query("""WITH s AS (SELECT item_id, '概述' || item_id || '：1. ' || regexp_replace(text, '[；：]', '', 'g') || '； 原因二：' || length(text) || '；。' AS x FROM benchmark)
SELECT item_id, [trim(regexp_replace(text, '[；：]', '', 'g')), length(text)::VARCHAR] AS clauses, substring('概述' || item_id || '：1. ' || regexp_replace(text, '[；：]', '', 'g'), 1, 30) AS preview FROM benchmark""")
def summary_clauses(spark, sf):
    plain = F.regexp_replace("text", "[；：]", "")
    x = F.concat(F.lit("概述"), F.col("item_id").cast("string"), F.lit("：1. "), plain, F.lit("； 原因二："), F.length("text").cast("string"), F.lit("；。"))
    return read(spark, sf, "benchmark").select("item_id", T.summary_clauses(x).alias("clauses"), T.preview(x, 30).alias("preview"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INT AS n FROM documents), m AS (SELECT doc_id, n AS line, unnest(regexp_extract_all(line, '\d{4,}|\d{4}-\d{2}(?:-\d{2})?')) AS found, substring(line, 1, 120) AS context FROM l) SELECT * FROM m""")
def mention_lines(spark, sf):
    """Each date or long number in a text with its line."""
    found = read(spark, sf, "documents").select("doc_id", F.explode(T.mention_lines("text", r"\d{4,}|" + T.DATE_MENTION)).alias("m"))
    return found.select("doc_id", "m.line", "m.found", "m.context")


@query()
def issue_similarity(spark, sf):
    """Similarity of each answer's turn with the question before it, as issues with normalized text, text and role."""
    from threshmill.plans.conversations import asked_and_answered, spread

    rows = spread(spark, asked_and_answered(spark, sf).filter("role = 'assistant' and question is not null"))
    s = T.issue_similarity((T.normalize("text"), T.normalize("question")), ("text", "question"), (F.lit("assistant"), F.lit("user")))
    return rows.select("conv_id", "turn", F.round(s, 6).alias("similarity"))


@query("""WITH a AS (SELECT conv_id, list(sha256(text) ORDER BY turn) AS h FROM conversations GROUP BY 1), b AS (SELECT conv_id, h, CASE conv_id % 4 WHEN 0 THEN h WHEN 1 THEN list_concat(h, ['new']) WHEN 2 THEN list_concat(['new'], h) ELSE list_concat(h[1:1], h[3:]) END AS w FROM a)
SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN len(h) WHEN 1 THEN len(h) WHEN 2 THEN 0 ELSE least(1, len(h)) END::INT AS first, CASE conv_id % 4 WHEN 0 THEN len(h) WHEN 1 THEN len(w) WHEN 2 THEN 1 ELSE least(1, len(h)) END::INT AS last FROM b""")
def changed_interval(spark, sf):
    """Where a conversation differs from a copy with nothing, a last turn, a first turn, or less of its second turn."""
    k = F.col("conv_id") % 4
    a = read(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: F.sha2(x["text"], 256)).alias("h"))
    new = F.array(F.lit("new"))
    w = F.when(k == 0, F.col("h")).when(k == 1, F.concat("h", new)).when(k == 2, F.concat(new, "h")).otherwise(F.concat(F.slice("h", 1, 1), F.slice("h", 3, F.greatest(F.size("h"), F.lit(1)))))
    return a.select("conv_id", incremental.changed_interval(F.col("h"), w).alias("c")).select("conv_id", "c.first", "c.last")
