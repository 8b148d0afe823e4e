"""Conversation segments: fixed blocks, gap segments, and the stateful rules."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threshmill.functions import text as T

GAP_MINUTES, MAX_MESSAGES, FOLLOW_MINUTES = 120, 30, 20


def fixed_blocks(messages: DataFrame, key: str, order: str, size: int = MAX_MESSAGES, start: int = 0) -> DataFrame:
    """Blocks of ``size`` messages with their first question and what follows it joined; blocks without a question go.

    Messages need ``is_question`` and ``content``; the fingerprint is that of the source and the messages' hashes.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    placed = messages.withColumn("message_index", place).filter(F.col("message_index") >= start)
    block = F.floor((F.col("message_index") - start) / size).cast("int")
    listed = F.sort_array(F.collect_list(F.struct("message_index", "is_question", "content", "message_sha256")))
    grouped = placed.groupBy(key, block.alias("block")).agg(listed.alias("m"))
    asked = F.filter("m", lambda x: x["is_question"])
    grouped = grouped.withColumn("first", F.element_at(asked, 1)).filter(F.col("first").isNotNull())
    later = F.filter("m", lambda x: x["message_index"] > F.col("first.message_index"))
    hashes = F.array_join(F.transform("m", lambda x: x["message_sha256"]), "\0")
    return grouped.select(
        key, "block", F.element_at("m", 1)["message_index"].alias("start_index"), F.element_at("m", -1)["message_index"].alias("end_index"),
        F.col("first.content").alias("question"), F.array_join(F.transform(later, lambda x: x["content"]), "\n").alias("answer"),
        F.concat(F.lit("ISS-"), T.fingerprint(F.concat(F.col(key).cast("string"), F.lit("\0"), hashes), 20)).alias("issue_id"),
    )


def gap_segments(rows: DataFrame, key: str, ts: str, tie: str, minutes: float = GAP_MINUTES) -> DataFrame:
    """Adds ``segment``: a number that rises where the gap to the row before is at least ``minutes``; null times never split."""
    order = Window.partitionBy(key).orderBy(ts, tie)
    gap = T.minutes_between(F.lag(ts).over(order), F.col(ts))
    return rows.withColumn("split", F.coalesce((gap >= minutes).cast("int"), F.lit(0))).withColumn("segment", F.sum("split").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("split")


class Segmenter:
    """The rules for one document, a message at a time; small state, so it serves batch and stream alike."""

    def __init__(self):
        self.reset(None)

    def reset(self, reason: str | None) -> None:
        self.count, self.customers, self.asked, self.replied, self.start_reason = 0, set(), False, False, reason

    def split_reason(self, gap: float | None, speaker: str, role: str, question: bool) -> str | None:
        """Why this message starts a segment; the first rule that holds."""
        if not self.count:
            return None
        if gap is not None and gap >= GAP_MINUTES:
            return f"time_gap_{int(gap)}m"
        if self.count >= MAX_MESSAGES:
            return "max_messages"
        if role == "customer" and question and self.replied:
            if self.asked and gap is not None and gap >= FOLLOW_MINUTES:
                return "new_customer_question_after_reply"
            if self.customers and speaker not in self.customers:
                return "different_customer_question"
        return None

    def add(self, speaker: str, role: str, question: bool) -> None:
        self.count += 1
        if role == "customer":
            self.customers.add(speaker)
            self.asked |= question
        self.replied |= role in ("support", "internal")


def rule_segments(messages: DataFrame, key: str = "document_id") -> DataFrame:
    """Adds segment, start_reason and end_reason by all rules. Messages need key, idx, ts, speaker, role, is_question.

    Rules look at the segment so far, so no window can express them: a document's rows are read in order, one at a
    time, from a sorted partition; neither a document nor a segment is held whole.
    """
    schema = f"{key} {dict(messages.dtypes)[key]}, idx long, segment int, reason string"
    rows = messages.select(key, F.col("idx").cast("long").alias("idx"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "speaker", "role", "is_question")
    rows = rows.repartition(key).sortWithinPartitions(key, "idx")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, current, segment, before = Segmenter(), None, 0, None
        for batch in batches:
            out = []
            for k, idx, us, speaker, role, question in batch.itertuples(index=False):
                if k != current:
                    state.reset(None)
                    current, segment, before = k, 0, None
                us = None if pd.isna(us) else us
                gap = None if us is None or before is None else (us - before) / 6e7
                reason = state.split_reason(gap, speaker, role, bool(question))
                if reason:
                    state.reset(reason)
                    segment += 1
                state.add(speaker, role, bool(question))
                before = us
                out.append((k, idx, segment, reason))
            yield pd.DataFrame(out, columns=[key, "idx", "segment", "reason"])

    numbered = messages.join(rows.mapInPandas(run, schema), [key, "idx"])
    order = Window.partitionBy(key, "segment")
    starts = numbered.withColumn("start_reason", F.coalesce(F.max("reason").over(order), F.lit("document_start"))).drop("reason")
    heads = starts.select(key, (F.col("segment") - 1).alias("segment"), F.col("start_reason").alias("end_reason")).distinct()
    return starts.join(heads, [key, "segment"], "left").withColumn("end_reason", F.coalesce("end_reason", F.lit("document_end")))


def keep_segments(numbered: DataFrame, key: str = "document_id") -> DataFrame:
    """Segments of at least two messages that are no noise, with a question or both a customer and support."""
    agg = numbered.groupBy(key, "segment").agg(
        F.count("*").alias("message_count"), F.sum((~F.col("is_noise")).cast("int")).alias("content_count"), F.bool_or("is_question").alias("has_question"),
        F.bool_or(F.col("role") == "customer").alias("has_customer"), F.bool_or(F.col("role") == "support").alias("has_support"), F.first("start_reason").alias("start_reason"), F.first("end_reason").alias("end_reason"),
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.countDistinct("speaker").alias("speaker_count"),
    )
    return agg.filter((F.col("content_count") >= 2) & (F.col("has_question") | (F.col("has_customer") & F.col("has_support"))))


def chunk_paragraphs(paragraphs: DataFrame, target: int = 400) -> DataFrame:
    """Chunks of whole paragraphs that close once they hold ``target`` characters: document_id, chunk, first and last paragraph, text.

    Paragraphs need document_id, para_index and text. The running length starts anew at each close, which no window sum
    does; documents are streamed in order from sorted partitions.
    """
    rows = paragraphs.select("document_id", F.col("para_index").cast("long").alias("para_index"), "text").repartition("document_id").sortWithinPartitions("document_id", "para_index")
    schema = f"document_id {dict(paragraphs.dtypes)['document_id']}, chunk int, para_start long, para_end long, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        doc, chunk, held = None, 0, []
        columns = ["document_id", "chunk", "para_start", "para_end", "text"]

        def closed():
            return doc, chunk, held[0][0], held[-1][0], "\n".join(t for _, t in held)

        for batch in batches:
            out = []
            for d, i, text in batch.itertuples(index=False):
                if d != doc:
                    if held:
                        out.append(closed())
                    doc, chunk, held = d, 0, []
                held.append((i, text))
                if sum(len(t) for _, t in held) >= target:
                    out.append(closed())
                    chunk, held = chunk + 1, []
            yield pd.DataFrame(out, columns=columns)
        if held:
            yield pd.DataFrame([closed()], columns=columns)

    return rows.mapInPandas(run, schema)
