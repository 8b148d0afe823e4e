"""Revisions of knowledge entries: snapshots, chains, reviews and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T

BASELINE_ENTRIES = 645
#: Characters that an answer written by a person needs.
REVISED_CHARS = 20


def latest(revisions: DataFrame) -> DataFrame:
    order = Window.partitionBy("kb_id").orderBy(F.desc("revision"))
    return revisions.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def active(revisions: DataFrame) -> DataFrame:
    return latest(revisions).filter("status = 'active'")


def chain_violations(revisions: DataFrame) -> DataFrame:
    """Rows that break a chain: revisions 1..n, all but the last superseded, each naming the one before it."""
    order = Window.partitionBy("kb_id").orderBy("revision")
    place, after = F.row_number().over(order), F.lead("revision").over(order)
    named = F.when(place == 1, F.lit(None)).otherwise(F.format_string("%s@r%d", "kb_id", F.lag("revision").over(order)))
    rules = P.flags(gap=F.col("revision") != F.col("place"), not_superseded=F.col("after").isNotNull() & (F.col("status") != "superseded"), bad_terminal=F.col("after").isNull() & ~F.col("status").isin("active", "retired"), bad_supersedes=~F.col("supersedes").eqNullSafe(F.col("named")))
    marked = revisions.select("kb_id", "revision", "status", "supersedes", place.alias("place"), after.alias("after"), named.alias("named"))
    return marked.withColumn("violations", rules).filter(F.size("violations") > 0).select("kb_id", "revision", "violations")


def allocate_ids(rows: DataFrame, revisions: DataFrame, order: str, baseline: int = BASELINE_ENTRIES) -> DataFrame:
    """Adds kb_id, going on after the greatest number in use or the baseline. Rows are counted by range first, so no task numbers all."""
    start = F.greatest(F.coalesce(F.max(F.substring("kb_id", 4, 12).try_cast("int")), F.lit(0)), F.lit(baseline))
    first = revisions.agg(start.alias("m")).first()["m"]
    dealt = rows.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id())
    sizes = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.join(sizes.select("_p", before.alias("_b")), "_p")
    n = F.col("_b") + F.row_number().over(Window.partitionBy("_p").orderBy(order)) + first
    return placed.withColumn("kb_id", F.format_string("KB-%04d", n)).drop("_p", "_b")


def analyze(issues: DataFrame, entries: DataFrame) -> DataFrame:
    """The deterministic analyzer: relation, target and confidence of each issue against the active entries."""
    nq, na = T.normalize("question"), T.normalize("answer")
    marked = issues.withColumn("_nq", nq).withColumn("_na", na)
    known = entries.select("kb_id", T.normalize("question").alias("_nq"), T.normalize("answer").alias("_kna"), F.col("answer").alias("_ka"))
    first = known.withColumn("_r", F.row_number().over(Window.partitionBy("_nq").orderBy("kb_id"))).filter("_r = 1").drop("_r")
    both = marked.join(first, "_nq", "left")
    short = (F.length("_nq") < 4) | (F.length("_na") < 4)
    differs = P.has_any(F.col("_ka"), P.CONFLICT_WORDS) != P.has_any(F.col("answer"), P.CONFLICT_WORDS)
    relation = P.ladder((short, "low_value"), (F.col("kb_id").isNull(), "new"), (F.col("_na") == F.col("_kna"), "duplicate_evidence"), (differs, "conflict"), otherwise="answer_supplement")
    out = both.withColumn("relation", relation)
    confidence = P.ladder((F.col("relation").isin("low_value", "duplicate_evidence"), 1.0), (F.col("relation") == "new", 0.8), otherwise=0.9)
    return out.withColumn("target_kb_id", F.when(~short, F.col("kb_id"))).withColumn("confidence", confidence).drop("_nq", "_na", "_kna", "_ka", "kb_id")


def review_rows(analyzed: DataFrame) -> DataFrame:
    """Pending reviews of what is neither a duplicate nor of low value."""
    key = F.concat(F.col("issue_id"), F.col("relation"), F.coalesce("target_kb_id", F.lit("")))
    kept = analyzed.filter(~F.col("relation").isin("duplicate_evidence", "low_value"))
    return kept.select(F.concat(F.lit("REV-"), T.fingerprint(key, 20)).alias("review_id"), "issue_id", "relation", "target_kb_id", F.col("question").alias("proposed_question"), F.col("answer").alias("proposed_answer"), "confidence", F.lit("pending").alias("status"))


def approve(reviews: DataFrame, revisions: DataFrame) -> DataFrame:
    """Revisions after the reviews with status ``approved``: a target gets its next revisions, others a new id; what they follow is superseded.

    Several reviews of one target are revisions of it one after the other, by their identifiers; each names the one
    before it, and the last alone is active.
    """
    accepted = reviews.filter("status = 'approved' and relation <> 'revalidation_required'")
    return revisions_after(revisions, new_revisions(accepted, revisions))


def new_revisions(accepted: DataFrame, revisions: DataFrame) -> DataFrame:
    """The revision that each accepted review makes: review_id, issue_id and the columns of revisions."""
    by = Window.partitionBy("target_kb_id").orderBy("review_id")
    now = latest(revisions).select(F.col("kb_id").alias("target_kb_id"), F.col("revision").alias("before"))
    revised = accepted.filter("target_kb_id is not null").join(now, "target_kb_id")
    revised = revised.withColumn("kb_id", F.col("target_kb_id")).withColumn("revision", (F.col("before") + F.row_number().over(by)).cast("int"))
    revised = revised.withColumn("status", F.when(F.lead("review_id").over(by).isNull(), "active").otherwise("superseded")).withColumn("supersedes", F.format_string("%s@r%d", "kb_id", F.col("revision") - 1))
    fresh = allocate_ids(accepted.filter("target_kb_id is null"), revisions, "review_id")
    fresh = fresh.withColumn("revision", F.lit(1)).withColumn("status", F.lit("active")).withColumn("supersedes", F.lit(None).cast("string"))
    columns = ["review_id", "issue_id", "kb_id", "revision", "status", F.col("proposed_question").alias("question"), F.col("proposed_answer").alias("answer"), "supersedes"]
    return revised.select(*columns).unionByName(fresh.select(*columns))


def revisions_after(revisions: DataFrame, added: DataFrame) -> DataFrame:
    """Revisions with added ones; what was the last of a revised entry is superseded."""
    followed = added.filter("supersedes is not null").groupBy("kb_id").agg((F.min("revision") - 1).alias("followed"))
    kept = revisions.select("kb_id", "revision", "status", "question", "answer", "supersedes").join(followed, "kb_id", "left")
    kept = kept.withColumn("status", F.when(F.col("revision") == F.col("followed"), "superseded").otherwise(F.col("status"))).drop("followed")
    return kept.unionByName(added.select(*kept.columns))


def decide(reviews: DataFrame, issues: DataFrame, revisions: DataFrame, decisions: DataFrame) -> dict[str, DataFrame]:
    """Reviews, revisions, evidence links and audit events after decisions (review_id, decision, note).

    A decision is refused, and changes nothing but the audit, if its review is unknown or not pending, or if its issue
    is missing or not active (a revalidation needs no active issue). A rejection closes the review; an approved
    revalidation acknowledges it; any other approval makes a revision and links it with the issue as evidence.
    Of several decisions on one review the first by (decision, note) counts.
    """
    order = Window.partitionBy("review_id").orderBy("decision", "note")
    once = decisions.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("review_id", "decision", "note")
    state = issues.select("issue_id", F.col("status").alias("_issue"), F.col("source").alias("_source")).dropDuplicates(["issue_id"])
    known = reviews.withColumnRenamed("status", "_status").join(state, "issue_id", "left")
    both = once.join(known, "review_id", "left")
    active_issue = F.coalesce(F.col("_issue") == "active", F.lit(False))
    revalidation = F.col("relation") == "revalidation_required"
    event = P.ladder(
        (F.col("_status").isNull(), "refused_unknown_review"), (F.col("_status") != "pending", "refused_already_decided"), (~F.coalesce(revalidation, F.lit(False)) & ~active_issue, "refused_inactive_issue"),
        (F.col("decision") == "rejected", "review_rejected"), (F.col("decision") != "approved", "refused_unknown_decision"), (revalidation, "revalidation_acknowledged"), otherwise="review_approved",
    )
    judged = both.withColumn("event", event)
    closed = judged.filter(~F.col("event").startswith("refused")).select("review_id", F.col("decision").alias("_decision"))
    after = reviews.join(closed, "review_id", "left")
    after = after.withColumn("status", F.coalesce("_decision", "status")).select(*reviews.columns)
    accepted = judged.filter("event = 'review_approved'")
    added = new_revisions(accepted.select(*reviews.drop("status").columns), revisions)
    sources = accepted.select("review_id", F.col("_source").alias("source"))
    evidence = added.join(sources, "review_id").select("kb_id", "revision", "issue_id", "source", F.lit("active").alias("status"))
    made = added.select("review_id", F.format_string("%s@r%d", "kb_id", "revision").alias("made"))
    audit = judged.join(made, "review_id", "left").select("event", F.col("review_id").alias("entity"), F.to_json(F.struct("note", "made")).alias("detail"))
    return {"reviews": after, "revisions": revisions_after(revisions, added), "evidence": evidence, "audit": audit}


def revise(revisions: DataFrame, proposed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(revisions, refused) after texts (kb_id, question, answer) that a person wrote for active entries.

    A text is refused with its reasons if its entry is unknown or not active, if it is empty, short or sensitive, or if
    several are proposed for one entry.
    """
    last = latest(revisions).select("kb_id", F.col("revision").alias("_before"), F.col("status").alias("_status"))
    many = F.count("*").over(Window.partitionBy("kb_id"))
    rows = proposed.select("kb_id", F.trim("question").alias("question"), F.trim("answer").alias("answer"), many.alias("_many")).join(last, "kb_id", "left")
    empty = (F.coalesce(F.length("question"), F.lit(0)) == 0) | (F.coalesce(F.length("answer"), F.lit(0)) == 0)
    text = F.concat_ws("\n", "question", "answer")
    rows = rows.withColumn("reasons", P.flags(unknown_entry=F.col("_before").isNull(), not_active=F.col("_status") != "active", empty=empty, answer_too_short=F.length("answer") < REVISED_CHARS, sensitive=F.size(P.sensitive(text)) > 0, several=F.col("_many") > 1))
    good = rows.filter(F.size("reasons") == 0)
    added = good.select(F.lit(None).cast("string").alias("review_id"), F.lit(None).cast("string").alias("issue_id"), "kb_id", (F.col("_before") + 1).alias("revision"), F.lit("active").alias("status"), "question", "answer", F.format_string("%s@r%d", "kb_id", "_before").alias("supersedes"))
    return revisions_after(revisions, added), rows.filter(F.size("reasons") > 0).select("kb_id", "reasons")


def rebaseline(revisions: DataFrame, survivors: DataFrame) -> DataFrame:
    """Revisions after a new baseline (kb_id, question, answer): changed texts are imported as the next revision, absent entries retired."""
    last = latest(revisions)
    new = survivors.select("kb_id", F.col("question").alias("_q"), F.col("answer").alias("_a"))
    live = last.filter("status = 'active'").join(new, "kb_id")
    changed = live.filter(~F.col("question").eqNullSafe(F.col("_q")) | ~F.col("answer").eqNullSafe(F.col("_a")))
    none = F.lit(None).cast("string")
    added = changed.select(none.alias("review_id"), none.alias("issue_id"), "kb_id", (F.col("revision") + 1).alias("revision"), F.lit("active").alias("status"), F.col("_q").alias("question"), F.col("_a").alias("answer"), F.format_string("%s@r%d", "kb_id", "revision").alias("supersedes"))
    fresh = new.join(last.select("kb_id"), "kb_id", "left_anti").select(none.alias("review_id"), none.alias("issue_id"), "kb_id", F.lit(1).alias("revision"), F.lit("active").alias("status"), F.col("_q").alias("question"), F.col("_a").alias("answer"), none.alias("supersedes"))
    after = revisions_after(revisions, added.unionByName(fresh))
    gone = after.join(new.select("kb_id", F.lit(True).alias("_stays")), "kb_id", "left")
    return gone.withColumn("status", F.when((F.col("status") == "active") & F.col("_stays").isNull(), "retired").otherwise(F.col("status"))).drop("_stays")


def publish_violations(revisions: DataFrame, reviews: DataFrame, survivors: DataFrame, baseline: int = BASELINE_ENTRIES) -> DataFrame:
    """(gate, entity) of everything that forbids a release; empty if it may go out."""
    live = active(revisions).select("kb_id")
    risky = reviews.filter((F.col("status") == "pending") & F.col("relation").isin("conflict", "temporal_update", "revalidation_required")).select(F.lit("high_risk_pending").alias("gate"), F.col("review_id").alias("entity"))
    missing = survivors.select("kb_id").join(live, "kb_id", "left_anti").select(F.lit("survivor_missing").alias("gate"), F.col("kb_id").alias("entity"))
    old = F.substring("kb_id", 4, 12).try_cast("int") <= baseline
    risen = live.filter(old).join(survivors.select("kb_id"), "kb_id", "left_anti").select(F.lit("retired_active").alias("gate"), F.col("kb_id").alias("entity"))
    broken = chain_violations(revisions).select(F.lit("broken_chain").alias("gate"), F.format_string("%s@r%d", "kb_id", "revision").alias("entity"))
    return risky.unionByName(missing).unionByName(risen).unionByName(broken)


def changelog(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """added, revised or removed for each key that differs between two releases."""
    b, a = before.select(key, F.col(value).alias("old")), after.select(key, F.col(value).alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "revised")
    return b.join(a, key, "full_outer").withColumn("change", change).filter("change is not null").select(key, "change")
