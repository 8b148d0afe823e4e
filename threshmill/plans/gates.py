"""Guards after a model's judgement, with labels as the judgements."""

from __future__ import annotations

from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T
from threshmill.operators import guards
from threshmill.plans.base import query, read


def labels(spark, sf):
    return read(spark, sf, "labels").select("doc_id", "quality", "toxic")


@query("""SELECT doc_id, CASE WHEN toxic = 1 THEN 'insufficient_evidence' WHEN doc_id % 5 = 0 THEN 'irrelevant' WHEN quality = 0 THEN 'not_a_cause' WHEN doc_id % 3 = 0 THEN 'action_unsupported' ELSE 'valid' END AS verdict FROM labels""")
def cause_verdicts(spark, sf):
    rows = labels(spark, sf).withColumns({"supported": F.col("toxic") == 0, "answers_question": F.col("doc_id") % 5 != 0, "is_real_cause": F.col("quality") == 1, "action_supported": F.col("doc_id") % 3 != 0})
    return rows.select("doc_id", guards.cause_verdict().alias("verdict"))


@query("""WITH r AS (SELECT doc_id, ['CURRENT_CONFIRMED', 'STALE', 'INCIDENT_TEMPORARY', 'HISTORICAL_SUPERSEDED', 'UNKNOWN'][doc_id % 5 + 1] AS d, quality AS recent, 1 - toxic AS sound, doc_id % 3 AS members, doc_id % 700 AS span FROM labels)
SELECT doc_id, CASE WHEN d = 'CURRENT_CONFIRMED' THEN (CASE WHEN recent = 0 OR recent * sound = 0 THEN 'GATE_FAILED_KEEP_BLOCKED' ELSE d END) WHEN d = 'STALE' THEN (CASE WHEN recent > 0 THEN 'GATE_FAILED_KEEP_BLOCKED' ELSE d END)
 WHEN d = 'INCIDENT_TEMPORARY' THEN (CASE WHEN sound < recent THEN 'GATE_FAILED_KEEP_BLOCKED' ELSE d END) WHEN d = 'HISTORICAL_SUPERSEDED' THEN (CASE WHEN members < 2 OR span < 365 THEN 'GATE_FAILED_KEEP_BLOCKED' ELSE d END) ELSE d END AS decision FROM r""")
def temporal_gates(spark, sf):
    decisions = F.array(*(F.lit(x) for x in ("CURRENT_CONFIRMED", "STALE", "INCIDENT_TEMPORARY", "HISTORICAL_SUPERSEDED", "UNKNOWN")))
    sound = 1 - F.col("toxic")
    rows = labels(spark, sf).withColumns({"decision": F.get(decisions, (F.col("doc_id") % 5).cast("int")), "n_recent": F.col("quality"), "n_recent_sound": F.col("quality") * sound, "annotated": F.lit(True), "n_cited": F.col("quality"), "n_cited_temporary": sound, "n_members": F.col("doc_id") % 3, "span_days": F.col("doc_id") % 700})
    return rows.select("doc_id", guards.temporal_gate().alias("decision"))


@query("""WITH f AS (SELECT doc_id, unnest([CASE WHEN toxic = 1 THEN {'flag': 'SUMMARY_UNSUPPORTED', 'severity': 'hard'} END, CASE WHEN quality = 0 THEN {'flag': 'NOTES_UNGROUNDED', 'severity': 'medium'} END, {'flag': 'CROSS_ENTRY_RELATED', 'severity': 'info'}]) AS x FROM labels)
SELECT doc_id, CASE WHEN bool_or(x.severity = 'hard') THEN 'needs_fix' WHEN bool_or(x.severity = 'medium') THEN 'manual_review' ELSE 'pass' END AS verdict FROM f WHERE x IS NOT NULL GROUP BY doc_id""")
def validation_verdicts(spark, sf):
    flag = lambda name, severity: F.struct(F.lit(name).alias("flag"), F.lit(severity).alias("severity"))
    found = F.array_compact(F.array(F.when(F.col("toxic") == 1, flag("SUMMARY_UNSUPPORTED", "hard")), F.when(F.col("quality") == 0, flag("NOTES_UNGROUNDED", "medium")), flag("CROSS_ENTRY_RELATED", "info")))
    return labels(spark, sf).withColumn("flags", found).select("doc_id", guards.build_verdict(F.col("flags")).alias("verdict"))


@query("""SELECT doc_id, CASE WHEN toxic = 1 THEN 'reject' WHEN doc_id % 4 = 0 AND quality = 0 THEN 'reject' ELSE 'candidate' END AS decision FROM labels""")
def admission_guard(spark, sf):
    rows = labels(spark, sf).withColumns({"qa_aligned": F.when(F.col("toxic") == 1, "no").otherwise("yes"), "problem_type": F.when(F.col("doc_id") % 4 == 0, "feature_request").otherwise("how_to"), "stable_limitation": F.col("quality") == 1, "decision": F.lit("candidate")})
    return rows.select("doc_id", guards.admission().alias("decision"))


@query("""SELECT source AS relation, count(*) AS n, round(avg(length(text) % 100 / 100.0), 6) AS mean, min(length(text) % 100 / 100.0)::DOUBLE AS least, max(length(text) % 100 / 100.0)::DOUBLE AS greatest FROM documents GROUP BY 1""")
def confidence_stats(spark, sf):
    rows = read(spark, sf, "documents").select(F.col("source").alias("relation"), (F.length("text") % 100 / F.lit(100.0)).alias("c"))
    return rows.groupBy("relation").agg(F.count("*").alias("n"), F.round(F.avg("c"), 6).alias("mean"), F.min("c").alias("least"), F.max("c").alias("greatest"))


@query("""WITH e AS (SELECT doc_id, doc_id // 4 AS cluster, quality, toxic FROM labels), c AS (SELECT DISTINCT cluster FROM e WHERE toxic = 1 OR doc_id % 10 < 2) SELECT e.doc_id, e.cluster FROM e WHERE cluster IN (SELECT cluster FROM c)""")
def review_cluster_members(spark, sf):
    """Members of clusters that need a review, by semi-join."""
    e = labels(spark, sf).withColumn("cluster", F.floor(F.col("doc_id") / 4))
    review = e.filter((F.col("toxic") == 1) | (F.col("doc_id") % 10 < 2)).select("cluster")
    return e.join(review, "cluster", "left_semi").select("doc_id", "cluster")


@query("""SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'other' END AS lang, least(1.0, greatest(0.0, n_chars / 3000.0))::DOUBLE AS confidence FROM documents""")
def enum_and_range_clamp(spark, sf):
    return read(spark, sf, "documents").select("doc_id", P.clamp_enum(F.col("lang"), ("en", "de"), "other").alias("lang"), T.clamp01(F.col("n_chars") / F.lit(3000.0)).alias("confidence"))


@query("""WITH u AS (SELECT conv_id, turn, unnest(string_split(text, '. ')) AS unit, generate_subscripts(string_split(text, '. '), 1)::INT - 1 AS place FROM conversations) SELECT conv_id, turn, place, length(unit)::INT AS chars FROM u""")
def explode_units(spark, sf):
    """A nested list as a child table with its place."""
    u = read(spark, sf, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\. ")).alias("place", "unit"))
    return u.select("conv_id", "turn", "place", F.length("unit").alias("chars"))


@query("""SELECT doc_id, (quality = 1) AS ready, CASE WHEN quality = 1 THEN 'generate' ELSE 'do_not_generate' END AS mode FROM labels""")
def ready_blocked_split(spark, sf):
    ready = F.coalesce(F.col("quality") == 1, F.lit(False))
    return labels(spark, sf).select("doc_id", ready.alias("ready"), F.when(ready, "generate").otherwise("do_not_generate").alias("mode"))


@query("""WITH q AS (SELECT conv_id, turn, text, string_split(text, '.')[1] AS quote FROM conversations) SELECT conv_id, turn, quote FROM q WHERE length(quote) > 0 AND contains(text, quote)""")
def verbatim_evidence(spark, sf):
    """Links of every turn, of which the quotes that stand in the text remain."""
    c = read(spark, sf, "conversations").select("conv_id", "turn", F.col("conv_id").alias("cluster_id"), F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), "text")
    links = c.select("conv_id", "turn", "cluster_id", "chunk_id", F.array(F.get(F.split("text", r"\."), 0), F.lit("not there")).alias("quotes"))
    return guards.verbatim_quotes(links, c.select("chunk_id", "text")).select("conv_id", "turn", F.get("quotes", 0).alias("quote"))
