"""Funnels and guards: what follows a model's judgement, as flags and ladders over its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T

CONFIDENCE, ANSWER_CHARS = 0.7, 20


def layer_a_flags(cutoff: str, confidence: float = CONFIDENCE, answer_chars: int = ANSWER_CHARS, missing_is_stale: bool = False) -> Column:
    """Reasons to leave a record out; dates are compared as strings."""
    date = F.coalesce(F.col("issue_date"), F.lit("")) if not missing_is_stale else F.coalesce(F.col("issue_date"), F.lit("9999"))
    return P.flags(
        A1_LOW_CONFIDENCE=F.coalesce(F.col("confidence"), F.lit(0.0)) < confidence, A2_LOW_VALUE=F.col("knowledge_value") == "low", A3_SHORT_ANSWER=F.length(F.coalesce("answer", F.lit(""))) < answer_chars,
        A4_FUTURE_PLAN=F.col("temporal_status") == "future_plan", A5_HISTORICAL=F.col("temporal_status") == "historical", B1_STALE=(date != "") & (date < cutoff),
    )


def pre_flags(text: Column, answer: Column) -> Column:
    return P.flags(PRIVACY_PHONE=text.rlike(P.SENSITIVE["phone"]), ANSWER_TOO_SHORT=F.length(answer) < ANSWER_CHARS)


def source_quality() -> Column:
    """From the counts of a knowledge entry's sources: n_keys, n_misaligned, n_no_answer, n_uncertain, n_missing, n_partial."""
    c = F.col
    return P.ladder((c("n_keys") == 0, "missing_source_keys"), (c("n_misaligned") > 0, "contaminated"), (c("n_no_answer") + c("n_uncertain") > 0, "weak_source_used"), (c("n_missing") > 0, "source_not_found"), (c("n_partial") > 0, "usable_with_caution"), otherwise="clean")


def final_status() -> Column:
    """What is not known of an entry needs a person."""
    quality, verdict, grounding, temporal = (F.col(x) for x in ("source_quality", "verdict", "grounding", "temporal_risk"))
    manual = quality.isNull() | fails(grounding.isNotNull()) | verdict.isNull() | temporal.isNull() | quality.isin("missing_source_keys", "source_not_found", "usable_with_caution") | (verdict != "pass") | ~grounding.isin("fully_grounded", "mostly_grounded") | (temporal == "high")
    return P.ladder((quality.isin("contaminated", "weak_source_used"), "REGENERATE"), (manual, "MANUAL_REVIEW"), otherwise="APPROVED")


def fails(facet: str | Column) -> Column:
    """Whether a facet is not known to hold: what is null fails."""
    return ~F.coalesce(F.col(facet) if isinstance(facet, str) else facet, F.lit(False))


def cause_verdict() -> Column:
    """The first failing facet of a cause decides."""
    return P.ladder((fails("supported"), "insufficient_evidence"), (fails("answers_question"), "irrelevant"), (fails("is_real_cause"), "not_a_cause"), (fails("action_supported"), "action_unsupported"), otherwise="valid")


def cluster_status() -> Column:
    usable = F.col("valid") + F.col("action_fix") + F.col("duplicate")
    return P.ladder((usable < 2, "REJECT"), (F.col("rejected") > 0, "REBUILD"), (F.col("action_fix") > 0, "REBUILD"), otherwise="CLEAN")


def publishability(*facets: Column) -> Column:
    """publish falls to manual_review if any facet fails; other verdicts stand."""
    bad = F.lit(False)
    for f in facets:
        bad = bad | ~F.coalesce(f, F.lit(False))
    return F.when((F.col("verdict") == "publish") & bad, "manual_review").otherwise(F.col("verdict"))


def regenerated_verdict() -> Column:
    return P.ladder((fails("supported"), "insufficient_evidence"), (fails("in_scope"), "scope_mismatch"), ((F.col("verdict") == "publish") & (fails("reusable") | fails("stable")), "publish_with_caution"), otherwise=F.coalesce("verdict", F.lit("manual_review")))


def build_verdict(flags: Column) -> Column:
    """Of structs (flag, severity): any hard one needs a fix, any medium one or one of unknown severity a person, as does a null list."""
    unknown = F.exists(flags, lambda f: f.isNull() | ~F.coalesce(f["severity"].isin("hard", "medium", "info"), F.lit(False)))
    return P.ladder((F.exists(flags, lambda f: F.coalesce(f["severity"] == "hard", F.lit(False))), "needs_fix"), (F.exists(flags, lambda f: F.coalesce(f["severity"] == "medium", F.lit(False))) | unknown | flags.isNull(), "manual_review"), otherwise="pass")


def admission() -> Column:
    """A judgement without an alignment or a decision is rejected."""
    unaligned = F.coalesce(F.col("qa_aligned") == "no", F.lit(True))
    return P.ladder((unaligned, "reject"), (F.coalesce(F.col("problem_type") == "feature_request", F.lit(True)) & fails("stable_limitation"), "reject"), otherwise=F.coalesce("decision", F.lit("reject")))


def candidate_flags(cluster: Column, threshold: float = 0.35) -> Column:
    """Checks of one unit of a candidate against its sources' text and allowed keys."""
    keys = F.size(F.array_except("unit_keys", "source_keys")) > 0
    return P.flags(INVENTED_SOURCE_KEY=keys, SINGLE_SOURCE_ENTRY=F.size("source_keys") == 1, WEAK_LEXICAL_GROUNDING=T.grounded_ratio("content", "source_text") < threshold, TEMPORAL_CAUTION_MISSING=F.col("risky") & ~P.has_any(F.col("content"), P.CAUTION), UNGROUNDED_CONDITION=~T.grounded_phrase("condition", "source_text") & (F.length(cluster) > 0))


def verbatim_quotes(links: DataFrame, chunks: DataFrame) -> DataFrame:
    """Evidence links (cluster_id, chunk_id, quotes) of known chunks, each pair once, with quotes that stand in the chunk; others go."""
    once = links.dropDuplicates(["cluster_id", "chunk_id"]).join(chunks.select("chunk_id", "text"), "chunk_id")
    kept = once.withColumn("quotes", F.filter("quotes", lambda q: (F.length(q) > 0) & F.contains(F.col("text"), q)))
    return kept.filter(F.size("quotes") > 0).drop("text")


def temporal_gate(recency_days: int = 365) -> Column:
    """The decision, unless the facts speak against it or are not known: n_members, n_recent, n_recent_sound, n_cited, n_cited_temporary, span_days, annotated."""
    c = F.col
    speaks_against = P.ladder(
        (c("decision") == "CURRENT_CONFIRMED", (c("n_recent") == 0) | (c("n_recent_sound") == 0) | ~c("annotated")), (c("decision") == "STALE", c("n_recent") > 0),
        (c("decision") == "INCIDENT_TEMPORARY", c("n_cited_temporary") < c("n_cited")), (c("decision") == "HISTORICAL_SUPERSEDED", (c("n_members") < 2) | (c("span_days") < recency_days)), (c("decision").isNotNull(), F.lit(False)), otherwise=F.lit(True),
    )
    return F.when(F.coalesce(speaks_against, F.lit(True)), "GATE_FAILED_KEEP_BLOCKED").otherwise(c("decision"))


def question_gate(pool: Column, refs: Column, question: Column, stop: str = "的了吗呢") -> Column:
    """Why a generated question goes, in order: its length, too few bigrams of the pool, none of its references."""
    own = T.content_bigrams(question, stop)
    ratio = F.size(F.array_intersect(own, T.content_bigrams(pool, stop))) / F.greatest(F.size(own), F.lit(1))
    shared = F.size(F.array_intersect(own, T.content_bigrams(refs, stop))) > 0
    return P.ladder((~F.length(question).between(8, 40), "length"), (ratio < 0.40, "pool_ratio"), (~shared, "no_reference_bigram"))


def coverage_partition(rows: DataFrame, key: str, **layers: DataFrame) -> DataFrame:
    """Each row with the first layer that has its key, or ``extract``; layers are keyed tables."""
    out, names = rows, []
    for name, layer in layers.items():
        out = out.join(layer.select(key).distinct().withColumn(f"_{name}", F.lit(True)), key, "left")
        names.append(name)
    return out.withColumn("layer", P.ladder(*((F.col(f"_{n}"), n) for n in names), otherwise="extract")).drop(*(f"_{n}" for n in names))
