"""Structured Streaming: windowed counts with late data, stateful segments, and incremental ingest."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from threshmill.operators.segments import Segmenter


def stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 16) -> DataFrame:
    """Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts by window and type; rows later than the watermark are dropped, so state stays bounded."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    grouped = timed.groupBy(F.window("ts", width, slide) if slide else F.window("ts", width), "event_type")
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("window.start", "window.end", "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "120 minutes", late: str = "10 minutes") -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", "w.start", "w.end", "n")


SEGMENT = "document_id string, segment int, start_us long, end_us long, n int, start_reason string, end_reason string"
_STATE = "segment int, start_us long, last_us long, n int, customers array<string>, asked boolean, replied boolean, start_reason string"


def segment_stream(messages: DataFrame, timeout_ms: int | None = None) -> DataFrame:
    """The segment rules over a stream of document_id, us (event time in microseconds), speaker, role, is_question.

    State is one open segment a document: counts, flags and its customers. A segment is emitted when the next begins,
    or with ``timeout_ms``, for a stream that goes on, when no message comes for so long.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (document,) = key
        columns = ["document_id", "segment", "start_us", "end_us", "n", "start_reason", "end_reason"]
        if state.hasTimedOut:
            number, start, last, n, _, _, _, reason = state.get
            state.remove()
            yield pd.DataFrame([(document, number, start, last, n, reason or "document_start", "timeout")], columns=columns)
            return
        rules, number, start, last = Segmenter(), 0, None, None
        if state.exists:
            number, start, last, rules.count, customers, rules.asked, rules.replied, rules.start_reason = state.get
            rules.customers = set(customers)
        out = []
        rows = pd.concat(list(batches)).sort_values("us", kind="stable")
        for us, speaker, role, question in rows[["us", "speaker", "role", "is_question"]].itertuples(index=False):
            reason = rules.split_reason(None if last is None else (us - last) / 6e7, speaker, role, bool(question))
            if reason:
                out.append((document, number, start, last, rules.count, rules.start_reason or "document_start", reason))
                rules.reset(reason)
                number, start = number + 1, None
            rules.add(speaker, role, bool(question))
            start, last = us if start is None else start, us
        state.update((number, int(start), int(last), rules.count, sorted(rules.customers), rules.asked, rules.replied, rules.start_reason))
        if timeout_ms is not None:
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(out, columns=columns)

    return messages.groupBy("document_id").applyInPandasWithState(step, SEGMENT, _STATE, "append", GroupStateTimeout.NoTimeout if timeout_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what there is and end; the checkpoint makes a batch that broke off come again with the same number."""
    query = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def idempotent_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch to a folder of its own number, so a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
