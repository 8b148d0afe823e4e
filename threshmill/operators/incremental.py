"""Incremental ingest: what changed in a source, what it touches, and what is retracted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threshmill.functions import text as T
from threshmill.operators.clusters import set_checkpoint_dir

OVERLAP = 30
#: Links between two that are compared first when a change is looked for.
LINKS = 4096


def chained(messages: DataFrame) -> DataFrame:
    """Messages with their place in the source and the chained hash up to there. Needs source, idx, message_sha256.

    A link is the exclusive or of 64-bit hashes of (place, message) up to a message, twice with different seeds, so two
    sources have one link at a place if and only if they are equal up to there. Rows are dealt by ranges of source and
    idx and links are made range by range, so a source of any length is spread over tasks; no array holds one. The links
    are written once (a reliable checkpoint), for whoever compares them reads them more than once.
    """
    set_checkpoint_dir(messages.sparkSession)
    dealt = messages.repartitionByRange("source", "idx", "message_sha256").withColumn("_p", F.spark_partition_id()).checkpoint()
    before = Window.partitionBy("source").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_p", "source").orderBy("idx", "message_sha256")
    sizes = dealt.groupBy("_p", "source").agg(F.count("*").alias("_n"))
    sizes = sizes.select("_p", "source", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_b"))
    placed = dealt.join(sizes, ["_p", "source"]).withColumn("place", (F.col("_b") + F.row_number().over(inside) - 1).cast("int")).drop("_b")
    hashed = placed.withColumns({f"_h{seed}": F.xxhash64("place", "message_sha256", F.lit(seed)) for seed in (1, 2)})
    sums = hashed.groupBy("_p", "source").agg(*(F.bit_xor(f"_h{s}").alias(f"_x{s}") for s in (1, 2)))
    sums = sums.select("_p", "source", *(F.coalesce(F.bit_xor(f"_x{s}").over(before), F.lit(0).cast("long")).alias(f"_x{s}") for s in (1, 2)))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    link = [F.hex(F.bit_xor(f"_h{s}").over(so_far).bitwiseXOR(F.col(f"_x{s}"))) for s in (1, 2)]
    return hashed.join(sums, ["_p", "source"]).withColumn("chain", F.concat_ws(":", *link)).select(*messages.columns, "place", "chain").checkpoint()


def source_heads(links: DataFrame) -> DataFrame:
    """Of each source of ``chained`` messages: how many there are, and the hash of the whole."""
    out = links.groupBy("source").agg(F.count("*").alias("n"), F.max_by("chain", "place").alias("head"))
    return out.select("source", "n", F.sha2(F.concat_ws(":", "n", "head"), 256).alias("content_sha256"))


def first_changes(old: DataFrame, new: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, first_changed): the place after the last equal link of the named sources.

    Links are compared at the ends of blocks first, and then within the one block where they part.
    """
    near = lambda df: df.join(sources.select("source"), "source", "left_semi").select("source", "place", "chain")
    o, n = near(old), near(new)
    end = F.col("place") % LINKS == LINKS - 1
    keys = ["source", "place", "chain"]
    equal = o.filter(end).join(n.filter(end), keys).groupBy("source").agg(F.max("place").alias("last"))
    known = sources.select("source").distinct().join(equal, "source", "left").select("source", F.coalesce("last", F.lit(-1)).alias("last"))
    block = F.floor(F.col("place") / LINKS) == F.floor((F.col("last") + 1) / LINKS)
    inside = o.join(known, "source").filter(block).join(n, keys).groupBy("source").agg(F.max("place").alias("later"))
    return known.join(inside, "source", "left").select("source", (F.coalesce("later", "last") + 1).cast("int").alias("first_changed"))


def classify(old: DataFrame, new: DataFrame, was: DataFrame | None = None, now: DataFrame | None = None) -> DataFrame:
    """unchanged, moved, appended, modified or new for each source of ``new``; both are messages as of ``chained``.

    Adds old_count, new_count and first_changed, the first place at which the messages differ. Sources that are equal as
    wholes are known by their heads; only links of the others meet. Where heads are at hand as ``was`` and ``now``, ``old``
    may hold just the sources that differ.
    """
    was, now = was if was is not None else source_heads(old), now if now is not None else source_heads(new)
    o = was.select("source", F.col("n").cast("int").alias("old_count"), F.col("content_sha256").alias("old_sha"))
    elsewhere = was.groupBy("content_sha256").agg(F.min("source").alias("moved_from"))
    both = now.join(o, "source", "left").join(elsewhere, "content_sha256", "left")
    differing = both.filter("old_sha <> content_sha256").select("source")
    both = both.join(first_changes(old, new, differing), "source", "left")
    n_old = F.coalesce("old_count", F.lit(0))
    change = (
        F.when(F.col("old_sha") == F.col("content_sha256"), "unchanged")
        .when(F.col("old_sha").isNull() & F.col("moved_from").isNotNull(), "moved")
        .when(F.col("old_sha").isNotNull() & (F.col("first_changed") == n_old), "appended")
        .when(F.col("old_sha").isNotNull(), "modified")
        .otherwise("new")
    )
    first = F.when(F.col("old_sha").isNull(), 0).otherwise(F.col("first_changed"))
    out = both.select("source", "moved_from", change.alias("change"), n_old.alias("old_count"), F.col("n").cast("int").alias("new_count"), first.alias("first_changed"))
    return out.withColumn("moved_from", F.when(F.col("change") == "moved", F.col("moved_from")))


def affected_start(changes: DataFrame, issues: DataFrame, overlap: int = OVERLAP) -> DataFrame:
    """Where recomputing starts: ``overlap`` before the change, and no later than the first active issue that it touches."""
    base = F.when(F.col("change") == "appended", F.greatest(F.lit(0), F.col("old_count") - overlap)).when(F.col("change") == "modified", F.greatest(F.lit(0), F.col("first_changed") - overlap)).when(F.col("change") == "new", 0)
    started = changes.withColumn("base", base)
    active = issues.filter("status = 'active'").select("source", "start_index", "end_index")
    touched = started.join(active, "source").filter(F.col("end_index") >= F.col("base")).groupBy("source").agg(F.min("start_index").alias("earliest"))
    return started.join(touched, "source", "left").withColumn("affected_start", F.least("base", "earliest")).drop("base", "earliest")


def deleted(old: DataFrame, new: DataFrame, changes: DataFrame) -> DataFrame:
    """Registered sources that are gone: neither there nor moved."""
    moved = changes.filter("change = 'moved'").select(F.col("moved_from").alias("source"))
    return old.join(new.select("source"), "source", "left_anti").join(moved, "source", "left_anti").select("source")


def retract(issues: DataFrame, starts: DataFrame, gone: DataFrame) -> DataFrame:
    """Issues with their status after a change: those at or past a changed place, and those of deleted sources, are invalidated."""
    hit = issues.join(starts.select("source", "affected_start"), "source", "left").join(gone.select("source", F.lit(True).alias("gone")), "source", "left")
    lost = F.coalesce(F.col("gone"), F.lit(False)) | F.coalesce(F.col("end_index") >= F.col("affected_start"), F.lit(False))
    return hit.withColumn("status", F.when((F.col("status") == "active") & lost, "invalidated").otherwise(F.col("status"))).drop("affected_start", "gone")


def obsolete_reviews(reviews: DataFrame, issues: DataFrame) -> DataFrame:
    """Pending reviews of invalidated issues become obsolete."""
    lost = issues.filter("status = 'invalidated'").select("issue_id", F.lit(True).alias("lost"))
    out = reviews.join(lost, "issue_id", "left")
    return out.withColumn("status", F.when((F.col("status") == "pending") & F.col("lost"), "obsolete").otherwise(F.col("status"))).drop("lost")


def invalidated_links(evidence: DataFrame, issues: DataFrame) -> DataFrame:
    """Evidence links with their status: those of invalidated issues are invalidated too."""
    lost = issues.filter("status = 'invalidated'").select("issue_id", F.lit(True).alias("lost")).distinct()
    out = evidence.join(lost, "issue_id", "left")
    return out.withColumn("status", F.when(F.coalesce("lost", F.lit(False)), "invalidated").otherwise(F.col("status"))).select(*evidence.columns)


def revalidations(before: DataFrame, after: DataFrame, revisions: DataFrame, reason: str = "source_changed") -> DataFrame:
    """A pending review for each entry whose evidence link has been invalidated, with the entry's text of that revision."""
    keys = ["kb_id", "revision", "issue_id"]
    lost = before.filter("status = 'active'").select(*keys).join(after.filter("status = 'invalidated'").select(*keys), keys, "left_semi").distinct()
    rows = lost.join(revisions.select("kb_id", "revision", "question", "answer"), ["kb_id", "revision"])
    key = F.concat("issue_id", "kb_id", F.lit(reason))
    return rows.select(F.concat(F.lit("REV-"), T.fingerprint(key, 20)).alias("review_id"), "issue_id", F.lit("revalidation_required").alias("relation"), F.col("kb_id").alias("target_kb_id"), F.col("question").alias("proposed_question"), F.col("answer").alias("proposed_answer"), F.lit(1.0).alias("confidence"), F.lit("pending").alias("status")).dropDuplicates(["review_id"])


def watermarks(messages: DataFrame, gone: DataFrame) -> DataFrame:
    """Of each source of ``chained`` messages: the hash of the whole, how many there are, the time of the last, and whether it is still there."""
    times = messages.groupBy("source").agg(F.max_by("timestamp", "place").alias("last_message_time"))
    rows = source_heads(messages).join(times, "source").select("source", "content_sha256", F.col("n").alias("message_watermark"), "last_message_time")
    out = rows.join(gone.select("source", F.lit("deleted").alias("status")), "source", "left")
    return out.withColumn("status", F.coalesce("status", F.lit("active")))


def changed_interval(old: Column, new: Column) -> Column:
    """struct<first, last>: positions of ``new`` outside the common beginning and end of two arrays; both its size if they are equal.

    An interval with first = last is a place where rows of ``old`` are gone.
    """
    least = F.least(F.size(old), F.size(new))
    head = F.coalesce(F.get(F.filter(F.sequence(F.lit(0), least), lambda i: (i == least) | ~F.get(old, i).eqNullSafe(F.get(new, i))), 0), F.lit(0))
    tail = F.coalesce(F.get(F.filter(F.sequence(F.lit(0), least - head), lambda i: (i == least - head) | ~F.get(old, F.size(old) - 1 - i).eqNullSafe(F.get(new, F.size(new) - 1 - i))), 0), F.lit(0))
    equal = (F.size(old) == F.size(new)) & (head == least)
    return F.struct(F.when(equal, F.size(new)).otherwise(head).cast("int").alias("first"), F.when(equal, F.size(new)).otherwise(F.size(new) - tail).cast("int").alias("last"))


def upsert(current: DataFrame, incoming: DataFrame, *keys: str) -> DataFrame:
    """Rows of both, the incoming one where a key is in both; a rewrite of the table, as plain files have no merge."""
    return current.join(incoming.select(*keys), list(keys), "left_anti").unionByName(incoming)


def insert_ignore(current: DataFrame, incoming: DataFrame, *keys: str) -> DataFrame:
    return current.unionByName(incoming.join(current.select(*keys), list(keys), "left_anti"))


def last_write_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("_r = 1").drop("_r")
