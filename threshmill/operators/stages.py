"""Rules that stand behind a model's stages: what a judgement may say, given its sources, as expressions over its columns.

What is not known of a judgement (null) never passes a rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.operators.guards import fails

c = F.col

# The vocabulary of the judgements.
BAD_ALIGNMENT = ("misaligned", "no_answer", "uncertain")
ACTIONS = {"duplicate": "merge", "complementary": "merge", "incomplete_vs_complete": "merge", "multiple_causes": "merge_with_care", "conflict": "manual_review", "temporal_versions": "manual_review", "unknown": "manual_review"}
MODES = {"direct_synthesis": "single_answer", "structured_howto": "howto_sections", "multiple_causes": "cause_items", "scenario_branches": "scenario_sections", "troubleshooting": "troubleshooting_steps"}
NO_GENERATION = "do_not_generate"


def with_missing(df: DataFrame, **columns: str) -> DataFrame:
    """Adds the columns that are not there, as nulls of the given type."""
    return df.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in columns.items() if name not in df.columns))


def rename_detected(df: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each name is given to the first of its candidates that is a column; without any, an error tells which are wanted."""
    for name, candidates in names.items():
        found = next((x for x in (name, *candidates) if x in df.columns), None)
        if found is None:
            raise ValueError(f"no column for {name}: none of {', '.join(candidates)}")
        if found != name:
            df = df.withColumnRenamed(found, name)
    return df


def document_class(lines: str = "non_empty_lines", chat_lines: str = "chat_lines") -> Column:
    """A title alone is a stub, and lines of chat tell that a document is none."""
    return P.ladder((F.coalesce(c(lines), F.lit(0)) <= 1, "empty_stub"), (c(chat_lines) > 0, "chat_content_detected"), otherwise="formal_document")


def risk_level(low: float = 0.45) -> Column:
    """How far two extractions of one issue differ: by question, by fields that decide, then by module and answer."""
    same = lambda f: fails(f"{f}_same")
    severe = same("resolution") | same("knowledge_value") | same("needs_followup") | same("temporal_status")
    far = lambda x: F.coalesce(c(x) < low, F.lit(True))
    return P.ladder((far("question_similarity") | severe, "high"), (same("crm_module") | far("answer_similarity"), "medium"), otherwise="low")


def cluster_action() -> Column:
    """From answer_relation and, where that is mixed, recommended_action."""
    known = F.create_map(*(F.lit(x) for pair in ACTIONS.items() for x in pair))
    asked = F.when(c("recommended_action").isin("merge_with_care", "manual_review"), c("recommended_action")).otherwise("merge_with_care")
    return F.when(c("answer_relation") == "mixed", asked).otherwise(F.coalesce(F.try_element_at(known, c("answer_relation")), F.lit("manual_review")))


def canonical_if_same_intent() -> Column:
    return F.when(c("relation") == "same_intent", c("canonical_question"))


def alignment() -> Column:
    """struct<alignment, usable, reason>: an aligned pair that is not consistent is partial, and a partial one needs support."""
    partial = (c("alignment") == "partially_aligned") | ((c("alignment") == "aligned") & fails("consistent"))
    after = F.when(partial, "partially_aligned").otherwise(F.coalesce("alignment", F.lit("uncertain")))
    supported = ~fails("supported_answer") | ~fails("supported_solution")
    usable = ~fails("usable") & ~after.isin(*BAD_ALIGNMENT) & (~partial | supported)
    return F.struct(after.alias("alignment"), usable.alias("usable"), F.when(after != "aligned", c("reason")).alias("reason"))


def mixed_is_safe() -> Column:
    """Of a mixed cluster's audit: members (array of dispositions), classification, n_sub_intents, all_keys, member_keys, sub_keys, safe."""
    whole = (F.size(F.array_except("all_keys", "member_keys")) == 0) & (F.size(F.array_except("member_keys", "all_keys")) == 0) & (F.size(F.array_except("sub_keys", "all_keys")) == 0)
    sound = ~F.array_contains("members", "uncertain") & (c("classification") != "unsafe_mixed") & ~((c("classification") == "sub_intents") & (c("n_sub_intents") < 2))
    return ~fails("safe") & F.coalesce(whole & sound, F.lit(False))


def structure_rules(rows: DataFrame) -> DataFrame:
    """Rules over a cluster's structure, in order, as new values of structure, true_conflict, ready and mode, and ``flags``.

    Needs structure, cause_count, scenario_errors, conflict_errors, consistency_errors (arrays), true_conflict, temporal,
    validity_resolved, ready and mode.
    """
    some = lambda x: F.coalesce(F.size(x) > 0, F.lit(True))
    material = F.coalesce(c("temporal") == "material", F.lit(False))
    groundless = some("conflict_errors") & ~fails("true_conflict")
    conflict = ~fails("true_conflict") & ~groundless
    temporal_alone = (c("structure") == "conflict_temporal") & ~conflict & ~material
    structure = F.when(temporal_alone | c("structure").isNull(), "insufficient_evidence").otherwise(c("structure"))
    few_causes = (c("structure") == "multiple_causes") & F.coalesce(c("cause_count") < 2, F.lit(True))
    unresolved = material & fails("validity_resolved")
    blocked = few_causes | (some("scenario_errors") & (c("structure") == "scenario_branches")) | groundless | some("consistency_errors") | structure.isin("insufficient_evidence", "conflict_temporal") | unresolved
    ready = ~fails("ready") & ~F.coalesce(blocked, F.lit(True))
    expected = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in MODES.items() for x in pair)), structure), c("mode"))
    named = lambda name, errors: F.transform(F.coalesce(c(errors), F.array(F.lit("unknown"))), lambda e: F.concat(F.lit(f"{name}: "), e))
    # What the conflict rule has already turned into insufficient evidence is not flagged once more.
    unfounded = temporal_alone & ~groundless
    flags = F.concat(
        P.flags(MULTICAUSE_COUNT_LT_2=few_causes), named("SCENARIO_GROUNDING_FAIL", "scenario_errors"), named("CONFLICT_GROUNDING_FAIL", "conflict_errors"), named("CAUSE_CONFLICT_INCONSISTENCY", "consistency_errors"),
        P.flags(CONFLICT_TEMPORAL_WITHOUT_CONFLICT_OR_MATERIAL_TEMPORAL=unfounded, MATERIAL_TEMPORAL_UNRESOLVED=unresolved),
    )
    mode = F.when(ready, expected).when(F.coalesce(blocked, F.lit(True)), NO_GENERATION).otherwise(c("mode"))
    return rows.withColumns({"structure": structure, "true_conflict": conflict, "ready": ready, "mode": mode, "flags": F.array_distinct(flags)})


def state_changes(old: Mapping[str, str], new: Mapping[str, str]) -> Column:
    """Names of the fields whose values differ between two sets of columns, null being a value."""
    return P.flags(**{name: ~c(old[name]).eqNullSafe(c(new[name])) for name in old})


def change_class(changes: Column, blocking: Sequence[str] = ("ready", "structure")) -> Column:
    """unchanged, blocked_to_ready or ready_to_blocked, structural, or minor."""
    hit = F.arrays_overlap(changes, F.array(*(F.lit(x) for x in blocking)))
    turned = F.array_contains(changes, "ready")
    return P.ladder((F.size(changes) == 0, "unchanged"), (turned & c("new_ready"), "blocked_to_ready"), (turned, "ready_to_blocked"), (hit, "structural"), otherwise="minor")


def risky_source() -> Column:
    return F.coalesce((c("temporal_status") == "temporary") | c("resolution").isin("partial", "unresolved"), F.lit(False))


def source_status(rows: DataFrame, key: str, usable: str = "usable") -> DataFrame:
    """Usable and unusable sources of each entry, and what that makes of it."""
    good = F.coalesce(c(usable), F.lit(False))
    out = rows.groupBy(key).agg(F.count_if(good).alias("n_usable"), F.count_if(~good).alias("n_unusable"))
    return out.withColumn("status", P.ladder((c("n_usable") == 0, "NO_VALID_SOURCE"), (c("n_unusable") > 0, "PARTIAL_SOURCE"), otherwise="CLEAN"))


def kept_keys(given: str, allowed: str) -> Column:
    """The given keys that are allowed, each once."""
    return F.array_distinct(F.filter(c(given), lambda k: F.array_contains(c(allowed), k)))


def survivors(rows: DataFrame, group: str, id_col: str, *better: str) -> DataFrame:
    """Of each group the row with the greatest values, the smallest identifier among equals."""
    return rows.groupBy(group).agg(F.max_by(id_col, F.struct(*better, (-c(id_col)).alias("_least"))).alias("survivor"), F.count("*").alias("members"))


def weighted_mean(value: str, weight: str) -> Column:
    """Null without weight."""
    return F.sum(c(value) * c(weight)) / F.nullif(F.sum(c(weight)), F.lit(0))


def foreign_pairs(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sides have no owner in common; owners are (node, owner), a node may have several."""
    own = owners.groupBy("node").agg(F.collect_set("owner").alias("owned"))
    left, right = own.select(c("node").alias("a"), c("owned").alias("owned_a")), own.select(c("node").alias("b"), c("owned").alias("owned_b"))
    none = F.array().cast(dict(own.dtypes)["owned"])
    both = pairs.join(left, "a", "left").join(right, "b", "left").withColumns({"owned_a": F.coalesce("owned_a", none), "owned_b": F.coalesce("owned_b", none)})
    return both.filter(~F.arrays_overlap("owned_a", "owned_b")).drop("owned_a", "owned_b")


def internal_similarity(parts: DataFrame, members: DataFrame) -> DataFrame:
    """Of each cluster: its size, its pairs inside, their least and mean similarity and least confidence; (node, cluster), and sums over pairs inside
    (cluster, pairs, least, total, least_confidence), any number of rows for a cluster."""
    found = parts.groupBy("cluster").agg(F.sum("pairs").alias("pairs"), F.min("least").alias("least"), (F.sum("total") / F.sum("pairs")).alias("mean"), F.min("least_confidence").alias("least_confidence"))
    return members.groupBy("cluster").agg(F.count("*").alias("members")).join(found, "cluster", "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))
