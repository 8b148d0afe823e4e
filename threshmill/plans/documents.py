"""Inventory, duplicates, lines, grounding and sensitive content over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T
from threshmill.operators import clusters, segments
from threshmill.operators.containment import contained
from threshmill.plans.base import numbered, query, read

WORD = r"[^ \t\n\x0B\f\r]+"


@query("""
SELECT doc_id, printf('D%04d', row_number() OVER (ORDER BY doc_id)) AS document_id, sha256(text) AS sha256,
       len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+'))::INT AS word_count, length(text)::INT AS chars FROM documents
""")
def doc_inventory(spark, sf):
    rows = numbered(read(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", F.format_string("D%04d", "row_no").alias("document_id"), T.sha256("text").alias("sha256"), T.count_words("text").alias("word_count"), F.length("text").alias("chars"))


@query("""
WITH k AS (SELECT doc_id, sha256(text) AS h FROM documents), g AS (SELECT h, count(*) AS n, row_number() OVER (ORDER BY h) AS no FROM k GROUP BY h HAVING count(*) > 1)
SELECT doc_id, no::INT AS group_no, n AS group_size, row_number() OVER (PARTITION BY no ORDER BY doc_id)::INT AS group_rank FROM k JOIN g USING (h)
""")
def exact_duplicate_groups(spark, sf):
    return clusters.exact_groups(read(spark, sf, "documents").select("doc_id", "text"), T.sha256("text"), "doc_id").select("doc_id", "group_no", "group_size", "group_rank")


@query("""
WITH g AS (SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1)
SELECT count(*) AS distinct_texts, sum(n)::BIGINT AS documents, sum(n - 1)::BIGINT AS extra_copies, count(*) FILTER (n > 1) AS groups, max(n) AS largest FROM g
""")
def extra_copies_summary(spark, sf):
    g = read(spark, sf, "documents").groupBy(T.sha256("text").alias("h")).agg(F.count("*").alias("n"))
    return g.agg(F.count("*").alias("distinct_texts"), F.sum("n").alias("documents"), F.sum(F.col("n") - 1).alias("extra_copies"), F.count_if(F.col("n") > 1).alias("groups"), F.max("n").alias("largest"))


@query(r"""
WITH k AS (SELECT doc_id, sha256(lower(regexp_replace(text, '[^\p{L}\p{N}]+', '', 'g'))) AS h FROM documents), g AS (SELECT h, min(doc_id) AS kept, count(*) AS n FROM k GROUP BY h)
SELECT k.doc_id, g.kept, g.n AS group_size FROM k JOIN g USING (h) WHERE g.n > 1
""")
def normalized_duplicates(spark, sf):
    k = read(spark, sf, "documents").select("doc_id", T.sha256(T.normalize("text")).alias("h"))
    g = k.groupBy("h").agg(F.min("doc_id").alias("kept"), F.count("*").alias("group_size")).filter("group_size > 1")
    return k.join(g, "h").drop("h")


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (trim(line) = '') AS blank_lines, count(*) FILTER (regexp_matches(line, '^\s*[-*+] ')) AS list_lines,
       count(*) FILTER (contains(line, '|')) AS table_lines, max(length(line))::INT AS longest FROM l GROUP BY doc_id
""")
def document_line_profile(spark, sf):
    lines = read(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(F.trim("line") == "").alias("blank_lines"), F.count_if(F.col("line").rlike(r"^\s*[-*+] ")).alias("list_lines"), F.count_if(F.contains("line", F.lit("|"))).alias("table_lines"), F.max(F.length("line")).alias("longest"))


@query("""
SELECT line, count(*) AS n, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE length(line) > 0 GROUP BY line HAVING count(*) > 1
""")
def repeated_lines(spark, sf):
    lines = read(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter("length(line) > 0")
    return lines.groupBy("line").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("documents")).filter("n > 1")


@query(r"""
SELECT doc_id, list_filter([CASE WHEN regexp_matches(text, '(^|[^0-9])1[3-9][0-9]{9}($|[^0-9])') THEN 'phone' END,
  CASE WHEN regexp_matches(text, '(?i)(api[_-]?key|secret|password)\s*[:=]\s*\S+') THEN 'api_key' END,
  CASE WHEN regexp_matches(text, '(?:^|/)\.env(?:\.|$)') THEN 'env_path' END,
  CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}') THEN 'email' END,
  CASE WHEN regexp_matches(text, '\+1 \(\d{3}\) \d{3}-\d{4}') THEN 'us_phone' END], lambda x: x IS NOT NULL) AS hits
FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}|\+1 \(\d{3}\) \d{3}-\d{4}|(?i:(api[_-]?key|secret|password)\s*[:=]\s*\S+)')
""")
def sensitive_hits(spark, sf):
    kinds = P.SENSITIVE | {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}", "us_phone": r"\+1 \(\d{3}\) \d{3}-\d{4}"}
    rows = read(spark, sf, "documents").select("doc_id", P.sensitive(F.col("text"), kinds).alias("hits"))
    return rows.filter(F.exists("hits", lambda h: h.isin("email", "us_phone", "api_key")))


@query(r"""
WITH c AS (SELECT hits.k AS kind, count(*) AS documents FROM (SELECT doc_id, unnest([{'k': 'email', 'h': regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}')},
 {'k': 'us_phone', 'h': regexp_matches(text, '\+1 \(\d{3}\) \d{3}-\d{4}')}, {'k': 'short', 'h': length(text) < 20}]) AS hits FROM documents) WHERE hits.h GROUP BY 1)
SELECT * FROM c
""")
def pre_flag_counts(spark, sf):
    text = F.col("text")
    flags = P.flags(email=text.rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}"), us_phone=text.rlike(r"\+1 \(\d{3}\) \d{3}-\d{4}"), short=F.length(text) < 20)
    return read(spark, sf, "documents").select(F.explode(flags).alias("kind")).groupBy("kind").agg(F.count("*").alias("documents"))


@query("""
SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)
""")
def benchmark_containment(spark, sf):
    """Items of which a document holds the whole text, verbatim."""
    found = contained(read(spark, sf, "benchmark"), read(spark, sf, "documents"), "item_id", "text", "doc_id", "text")
    return found.select(F.col("item").alias("item_id"), F.col("doc").alias("doc_id"))


@query(r"""
SELECT page_id, coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), url) AS title, starts_with(url, 'https://') AS is_https,
 regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages
""")
def page_titles(spark, sf):
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    return read(spark, sf, "pages").select("page_id", F.coalesce(F.when(title != "", title), "url").alias("title"), F.startswith("url", F.lit("https://")).alias("is_https"), F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1).alias("host"))


@query("""
SELECT starts_with(url, 'https://') AS is_https, count(*) AS pages, count(*) FILTER (NOT starts_with(url, 'https://')) AS refused FROM pages GROUP BY 1
""")
def url_checks(spark, sf):
    https = F.startswith("url", F.lit("https://"))
    return read(spark, sf, "pages").groupBy(https.alias("is_https")).agg(F.count("*").alias("pages"), F.count_if(~https).alias("refused"))


@query(r"""
SELECT doc_id, len(regexp_extract_all(text, '\d{4}-\d{2}(?:-\d{2})?'))::INT AS dates, len(regexp_extract_all(text, '[vV]\d+(?:\.\d+)+'))::INT AS versions FROM documents
""")
def mention_counts(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.size(T.mentions("text", T.DATE_MENTION)).alias("dates"), F.size(T.mentions("text", T.VERSION_MENTION)).alias("versions"))


@query("""
WITH p AS (SELECT doc_id, length(text) AS n, lang FROM documents), q AS (SELECT lang, n, row_number() OVER (PARTITION BY lang ORDER BY n) AS r, count(*) OVER (PARTITION BY lang) AS c FROM p)
SELECT lang, min(n)::INT AS shortest, max(n)::INT AS longest, max(n) FILTER (r = c // 2 + 1)::INT AS upper_median, max(c) AS documents FROM q GROUP BY lang
""")
def length_profile(spark, sf):
    """The upper median, by counting lengths before ranking them, so a window sees lengths and not documents."""
    from pyspark.sql import Window

    counted = read(spark, sf, "documents").groupBy("lang", F.length("text").alias("n")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("lang").orderBy("n"))
    ranked = counted.withColumn("upto", upto).withColumn("all", F.sum("c").over(Window.partitionBy("lang")))
    middle = F.min(F.when(F.col("upto") >= F.floor(F.col("all") / 2) + 1, F.col("n")))
    return ranked.groupBy("lang").agg(F.min("n").alias("shortest"), F.max("n").alias("longest"), middle.alias("upper_median"), F.sum("c").alias("documents"))


@query()
def paragraph_chunks(spark, sf):
    """Chunks of whole lines of about 400 characters."""
    lines = read(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), F.posexplode(F.split("text", "\n")).alias("para_index", "text")).filter("length(text) > 0")
    return segments.chunk_paragraphs(lines).select("document_id", "chunk", "para_start", "para_end", F.length("text").alias("chars"), T.sha256("text").alias("sha256"))


@query("""
SELECT doc_id, json_extract_string(j, '$.a') AS a, json_extract_string(j, '$.b') AS b FROM (SELECT doc_id, '{"a":"' || lang || '","b":"' || source || '"}' AS j FROM documents)
""")
def canonical_json_round_trip(spark, sf):
    j = read(spark, sf, "documents").select("doc_id", T.canonical_json(b=F.col("source"), a=F.col("lang")).alias("j"))
    return j.select("doc_id", F.from_json("j", "a string, b string").alias("r")).select("doc_id", "r.a", "r.b")
