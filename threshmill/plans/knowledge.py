"""Registry, gates and releases; orders play revisions and labels play a model's judgements."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.operators import guards, registry
from threshmill.plans.base import numbered, query, read

_REV = "r AS (SELECT printf('KB-%06d', o_custkey) AS kb_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS c, o_orderkey, o_orderpriority AS q, o_orderstatus AS a FROM orders)"
_REVISIONS = _REV + """, v AS (SELECT kb_id, CASE WHEN o_orderkey % 37 = 0 THEN n + 1 ELSE n END::INT AS revision, CASE WHEN n < c THEN (CASE WHEN o_orderkey % 41 = 0 THEN 'active' ELSE 'superseded' END) WHEN o_orderkey % 3 = 0 THEN 'retired' ELSE 'active' END AS status,
 q AS question, a AS answer, CASE WHEN n > 1 AND o_orderkey % 43 <> 0 THEN kb_id || '@r' || (n - 1) END AS supersedes, o_orderkey FROM r)"""


def revisions(spark, sf):
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = read(spark, sf, "orders").withColumn("n", F.row_number().over(order)).withColumn("c", F.count("*").over(Window.partitionBy("o_custkey")))
    kb, k = F.format_string("KB-%06d", "o_custkey"), F.col("o_orderkey")
    status = F.when(F.col("n") < F.col("c"), F.when(k % 41 == 0, "active").otherwise("superseded")).when(k % 3 == 0, "retired").otherwise("active")
    supersedes = F.when((F.col("n") > 1) & (k % 43 != 0), F.concat(kb, F.lit("@r"), (F.col("n") - 1).cast("string")))
    return o.select(kb.alias("kb_id"), F.when(k % 37 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("revision"), status.alias("status"), F.col("o_orderpriority").alias("question"), F.col("o_orderstatus").alias("answer"), supersedes.alias("supersedes"), "o_orderkey")


@query(f"WITH {_REVISIONS} SELECT kb_id, revision, status, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY kb_id ORDER BY revision DESC, o_orderkey) AS x FROM v) WHERE x = 1")
def latest_revision(spark, sf):
    order = Window.partitionBy("kb_id").orderBy(F.desc("revision"), "o_orderkey")
    return revisions(spark, sf).withColumn("x", F.row_number().over(order)).filter("x = 1").select("kb_id", "revision", "status", "o_orderkey")


@query(f"WITH {_REVISIONS} SELECT question, count(*) AS entries FROM (SELECT *, row_number() OVER (PARTITION BY kb_id ORDER BY revision DESC, o_orderkey) AS x FROM v) WHERE x = 1 AND status = 'active' GROUP BY 1")
def active_snapshot(spark, sf):
    order = Window.partitionBy("kb_id").orderBy(F.desc("revision"), "o_orderkey")
    last = revisions(spark, sf).withColumn("x", F.row_number().over(order)).filter("x = 1 and status = 'active'")
    return last.groupBy("question").agg(F.count("*").alias("entries"))


_CHAIN = _REVISIONS + """, u AS (SELECT * FROM v WHERE kb_id NOT IN (SELECT kb_id FROM v GROUP BY kb_id, revision HAVING count(*) > 1)), w AS (SELECT *, row_number() OVER k AS place, lead(revision) OVER k AS after, lag(revision) OVER k AS before FROM u WINDOW k AS (PARTITION BY kb_id ORDER BY revision)),
 x AS (SELECT kb_id, revision, list_filter([CASE WHEN revision <> place THEN 'gap' END, CASE WHEN after IS NOT NULL AND status <> 'superseded' THEN 'not_superseded' END, CASE WHEN after IS NULL AND status NOT IN ('active', 'retired') THEN 'bad_terminal' END,
 CASE WHEN supersedes IS DISTINCT FROM CASE WHEN place > 1 THEN kb_id || '@r' || before END THEN 'bad_supersedes' END], lambda z: z IS NOT NULL) AS violations FROM w)"""


def unique_revisions(spark, sf):
    v = revisions(spark, sf)
    twice = v.groupBy("kb_id", "revision").agg(F.count("*").alias("n")).filter("n > 1").select("kb_id").distinct()
    return v.join(twice, "kb_id", "left_anti")


@query(f"WITH {_CHAIN} SELECT kb_id, revision, violations FROM x WHERE len(violations) > 0")
def revision_chain_violations(spark, sf):
    return registry.chain_violations(unique_revisions(spark, sf))


@query(f"""WITH {_CHAIN}, live AS (SELECT kb_id FROM (SELECT *, row_number() OVER (PARTITION BY kb_id ORDER BY revision DESC) AS y FROM u) WHERE y = 1 AND status = 'active'),
s AS (SELECT DISTINCT printf('KB-%06d', c_custkey) AS kb_id FROM customer WHERE c_custkey % 50 = 0)
SELECT 'survivor_missing' AS gate, kb_id AS entity FROM s WHERE kb_id NOT IN (SELECT kb_id FROM live) UNION ALL SELECT 'retired_active', kb_id FROM live WHERE substring(kb_id, 4)::INT <= 645 AND kb_id NOT IN (SELECT kb_id FROM s)
UNION ALL SELECT 'broken_chain', kb_id || '@r' || revision FROM x WHERE len(violations) > 0
UNION ALL SELECT 'high_risk_pending', 'REV-' || doc_id FROM labels WHERE quality = 0 AND toxic = 1""")
def publish_gate(spark, sf):
    survivors = read(spark, sf, "customer").filter("c_custkey % 50 = 0").select(F.format_string("KB-%06d", "c_custkey").alias("kb_id"))
    reviews = read(spark, sf, "labels").filter("quality = 0").select(F.concat(F.lit("REV-"), F.col("doc_id").cast("string")).alias("review_id"), F.when(F.col("toxic") == 1, "conflict").otherwise("new").alias("relation"), F.lit("pending").alias("status"))
    return registry.publish_violations(unique_revisions(spark, sf), reviews, survivors)


@query("""WITH b AS (SELECT c_custkey AS id, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0), a AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'changed' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 5 <> 0)
SELECT coalesce(b.id, a.id) AS id, CASE WHEN b.v IS NULL THEN 'added' WHEN a.v IS NULL THEN 'removed' ELSE 'revised' END AS change FROM b FULL JOIN a USING (id) WHERE b.v IS DISTINCT FROM a.v""")
def release_changelog(spark, sf):
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("v"))
    after = c.filter("id % 5 <> 0").withColumn("v", F.when(F.col("id") % 4 == 0, "changed").otherwise(F.col("v")))
    return registry.changelog(c.filter("id % 3 <> 0"), after, "id", "v")


@query("SELECT item_id, printf('KB-%04d', 645 + row_number() OVER (ORDER BY item_id)) AS kb_id FROM benchmark")
def kb_id_allocation(spark, sf):
    rows = numbered(read(spark, sf, "benchmark").select("item_id"), "item_id")
    return rows.select("item_id", F.format_string("KB-%04d", F.col("row_no") + registry.BASELINE_ENTRIES).alias("kb_id"))


@query("""SELECT 'survivor_retired' AS gate, c_custkey AS entity FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 6 = 0
UNION ALL SELECT 'unknown', c_custkey FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 6 <> 0 AND c_custkey % 7 = 0""")
def contract_guard(spark, sf):
    """Survivors and retired must be disjoint and cover what has to be covered."""
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("entity"))
    survivors, retired = c.filter("entity % 4 = 0"), c.filter("entity % 6 = 0")
    both = survivors.intersect(retired).select(F.lit("survivor_retired").alias("gate"), "entity")
    unknown = c.filter("entity % 7 = 0").subtract(survivors).subtract(retired).select(F.lit("unknown").alias("gate"), "entity")
    return both.unionByName(unknown)


@query("""SELECT p_partkey AS entity, list_filter([CASE WHEN p_size < 10 AND p_partkey % 3 = 0 THEN 'not_verbatim' END, CASE WHEN p_partkey % 11 = 0 THEN 'resurrected' END], lambda x: x IS NOT NULL) AS violations FROM part WHERE (p_size < 10 AND p_partkey % 3 = 0) OR p_partkey % 11 = 0""")
def release_guard(spark, sf):
    k = F.col("p_partkey")
    marked = read(spark, sf, "part").select(k.alias("entity"), P.flags(not_verbatim=(F.col("p_size") < 10) & (k % 3 == 0), resurrected=k % 11 == 0).alias("violations"))
    return marked.filter(F.size("violations") > 0)


_Q = "(doc_id % 5)::INT AS n_keys, (doc_id % 7 = 0)::INT AS n_misaligned, (doc_id % 11 = 0)::INT AS n_no_answer, (doc_id % 13 = 0)::INT AS n_uncertain, (doc_id % 17 = 0)::INT AS n_missing, toxic AS n_partial"
_LADDER = "CASE WHEN n_keys = 0 THEN 'missing_source_keys' WHEN n_misaligned > 0 THEN 'contaminated' WHEN n_no_answer + n_uncertain > 0 THEN 'weak_source_used' WHEN n_missing > 0 THEN 'source_not_found' WHEN n_partial > 0 THEN 'usable_with_caution' ELSE 'clean' END"


def judged(spark, sf):
    d = F.col("doc_id")
    one = lambda m: (d % m == 0).cast("int")
    return read(spark, sf, "labels").select("doc_id", "quality", "toxic", (d % 5).cast("int").alias("n_keys"), one(7).alias("n_misaligned"), one(11).alias("n_no_answer"), one(13).alias("n_uncertain"), one(17).alias("n_missing"), F.col("toxic").alias("n_partial"))


@query(f"SELECT doc_id, {_LADDER} AS source_quality FROM (SELECT doc_id, {_Q} FROM labels)")
def source_quality_ladder(spark, sf):
    return judged(spark, sf).select("doc_id", guards.source_quality().alias("source_quality"))


@query(f"""WITH s AS (SELECT doc_id, {_LADDER} AS q, CASE WHEN quality = 1 THEN 'pass' ELSE 'fail' END AS verdict, CASE WHEN doc_id % 4 = 0 THEN 'weak' ELSE 'fully_grounded' END AS g, CASE WHEN doc_id % 9 = 0 THEN 'high' ELSE 'low' END AS tr FROM (SELECT doc_id, quality, {_Q} FROM labels))
SELECT doc_id, CASE WHEN q IN ('contaminated', 'weak_source_used') THEN 'REGENERATE' WHEN q IN ('missing_source_keys', 'source_not_found', 'usable_with_caution') OR verdict <> 'pass' OR g NOT IN ('fully_grounded', 'mostly_grounded') OR tr = 'high' THEN 'MANUAL_REVIEW' ELSE 'APPROVED' END AS final_status FROM s""")
def final_status(spark, sf):
    d = F.col("doc_id")
    rows = judged(spark, sf).withColumn("source_quality", guards.source_quality()).withColumn("verdict", F.when(F.col("quality") == 1, "pass").otherwise("fail"))
    rows = rows.withColumn("grounding", F.when(d % 4 == 0, "weak").otherwise("fully_grounded")).withColumn("temporal_risk", F.when(d % 9 == 0, "high").otherwise("low"))
    return rows.select("doc_id", guards.final_status().alias("final_status"))


@query("""SELECT doc_id, CASE WHEN quality = 1 AND (toxic = 1 OR doc_id % 5 = 0) THEN 'manual_review' WHEN quality = 1 THEN 'publish' ELSE 'reject' END AS verdict,
 CASE WHEN toxic = 1 THEN 'insufficient_evidence' WHEN doc_id % 5 = 0 THEN 'scope_mismatch' WHEN quality = 1 AND NOT (doc_id % 3 = 0 AND doc_id % 2 = 0) THEN 'publish_with_caution' WHEN quality = 1 THEN 'publish' ELSE 'reject' END AS regenerated FROM labels""")
def verdict_downgrades(spark, sf):
    d = F.col("doc_id")
    rows = read(spark, sf, "labels").withColumn("verdict", F.when(F.col("quality") == 1, "publish").otherwise("reject")).withColumn("supported", F.col("toxic") == 0).withColumn("in_scope", d % 5 != 0).withColumn("reusable", d % 3 == 0).withColumn("stable", d % 2 == 0)
    return rows.select("doc_id", guards.publishability(F.col("supported"), F.col("in_scope")).alias("verdict"), guards.regenerated_verdict().alias("regenerated"))


@query("""WITH c AS (SELECT doc_id // 4 AS cluster, CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 0 THEN 'action_fix' WHEN doc_id % 9 = 0 THEN 'duplicate' ELSE 'valid' END AS k FROM labels),
g AS (SELECT cluster, count(*) AS total, count(*) FILTER (k = 'valid') AS valid, count(*) FILTER (k = 'action_fix') AS action_fix, count(*) FILTER (k = 'rejected') AS rejected, count(*) FILTER (k = 'duplicate') AS duplicate FROM c GROUP BY 1)
SELECT *, CASE WHEN valid + action_fix + duplicate < 2 THEN 'REJECT' WHEN rejected > 0 OR action_fix > 0 THEN 'REBUILD' ELSE 'CLEAN' END AS status FROM g""")
def cluster_status(spark, sf):
    kind = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 0, "action_fix").when(F.col("doc_id") % 9 == 0, "duplicate").otherwise("valid")
    c = read(spark, sf, "labels").select(F.floor(F.col("doc_id") / 4).alias("cluster"), kind.alias("k"))
    g = c.groupBy("cluster").agg(F.count("*").alias("total"), *(F.count_if(F.col("k") == n).alias(n) for n in ("valid", "action_fix", "rejected", "duplicate")))
    return g.withColumn("status", guards.cluster_status())


@query("""WITH e AS (SELECT doc_id, quality, toxic FROM labels), a AS (SELECT doc_id FROM e WHERE quality = 1 AND toxic = 0)
SELECT doc_id, 'approved' AS sheet FROM a UNION ALL SELECT doc_id, 'review' FROM e WHERE doc_id NOT IN (SELECT doc_id FROM a)""")
def import_split(spark, sf):
    """Approved rows and, by anti-join, all others."""
    e = read(spark, sf, "labels").select("doc_id", "quality", "toxic")
    a = e.filter("quality = 1 and toxic = 0").select("doc_id")
    return a.withColumn("sheet", F.lit("approved")).unionByName(e.select("doc_id").join(a, "doc_id", "left_anti").withColumn("sheet", F.lit("review")))


_PLAIN = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"


@query(f"""WITH i AS (SELECT item_id, CASE WHEN item_id % 7 = 0 THEN 'ab?' ELSE text END AS q, CASE WHEN item_id % 8 = 2 THEN '不支持' || text WHEN item_id % 8 = 4 THEN text || ' and more' ELSE text END AS a FROM benchmark),
e AS (SELECT {_PLAIN.format('text')} AS nq, min_by(text, printf('KB-%04d', item_id)) AS ka FROM benchmark WHERE item_id % 2 = 0 GROUP BY 1), j AS (SELECT i.*, {_PLAIN.format('i.q')} AS nq, {_PLAIN.format('i.a')} AS na, e.ka FROM i LEFT JOIN e ON e.nq = {_PLAIN.format('i.q')})
SELECT item_id, CASE WHEN length(nq) < 4 OR length(na) < 4 THEN 'low_value' WHEN ka IS NULL THEN 'new' WHEN na = {_PLAIN.format('ka')} THEN 'duplicate_evidence' WHEN contains(a, '不支持') <> contains(ka, '不支持') THEN 'conflict' ELSE 'answer_supplement' END AS relation FROM j""")
def deterministic_relations(spark, sf):
    b = read(spark, sf, "benchmark")
    i, text = F.col("item_id"), F.col("text")
    answer = F.when(i % 8 == 2, F.concat(F.lit("不支持"), text)).when(i % 8 == 4, F.concat(text, F.lit(" and more"))).otherwise(text)
    issues = b.select("item_id", F.when(i % 7 == 0, "ab?").otherwise(text).alias("question"), answer.alias("answer"))
    entries = b.filter("item_id % 2 = 0").select(F.format_string("KB-%04d", "item_id").alias("kb_id"), F.col("text").alias("question"), F.col("text").alias("answer"))
    return registry.analyze(issues, entries).select("item_id", "relation")
