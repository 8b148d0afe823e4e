"""Time: gaps, windows, sessions and recency over events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threshmill.functions import text as T
from threshmill.operators import segments
from threshmill.plans.base import query, read

_GAPS_SQL = """g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) >= 7200000000 THEN 1 ELSE 0 END AS cut FROM events),
s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS segment FROM g)"""


def segmented(spark, sf):
    return segments.gap_segments(read(spark, sf, "events"), "user_id", "ts", "event_id")


@query(f"WITH {_GAPS_SQL} SELECT user_id, segment, count(*) AS n, min(ts) AS start_time, max(ts) AS end_time, count(DISTINCT event_type) AS kinds, round(sum(value), 4) AS total FROM s GROUP BY 1, 2")
def event_gap_segments(spark, sf):
    out = segmented(spark, sf).groupBy("user_id", "segment").agg(F.count("*").alias("n"), F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.countDistinct("event_type").alias("kinds"), F.round(F.sum("value"), 4).alias("total"))
    return out


@query(f"""WITH {_GAPS_SQL}, z AS (SELECT user_id, segment, count(*) AS n FROM s GROUP BY 1, 2), b(bucket, low, high) AS (VALUES (0, 1, 2), (1, 2, 4), (2, 4, 7), (3, 7, 11), (4, 11, 21), (5, 21, 1000000))
SELECT b.bucket, b.low::DOUBLE AS low, b.high::DOUBLE AS high, count(z.n) AS n FROM b LEFT JOIN z ON z.n >= b.low AND z.n < b.high GROUP BY ALL""")
def segment_size_histogram(spark, sf):
    from threshmill.operators.similarity import buckets

    sizes = segmented(spark, sf).groupBy("user_id", "segment").agg(F.count("*").alias("n"))
    return buckets(sizes.withColumnRenamed("n", "size"), "size", [1.0, 2.0, 4.0, 7.0, 11.0, 21.0, 1000000.0])


@query("SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1")
def month_histogram(spark, sf):
    return read(spark, sf, "events").groupBy(T.month_key("ts").alias("month")).agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_event_counts(spark, sf):
    g = read(spark, sf, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


@query("""
WITH e AS (SELECT event_id, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start FROM events)
SELECT start, count(*) AS n FROM e GROUP BY 1
""")
def sliding_event_counts(spark, sf):
    g = read(spark, sf, "events").groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "n")


@query("""
WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 7200000000 THEN 1 ELSE 0 END AS cut FROM events),
s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS segment FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, segment
""")
def sessionized_events(spark, sf):
    """Native session windows; unlike segments, a gap as long as the duration does not split."""
    g = read(spark, sf, "events").groupBy("user_id", F.session_window("ts", "120 minutes").alias("w")).agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


@query("SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS k_sum FROM events GROUP BY 1")
def json_props_extract(spark, sf):
    rows = read(spark, sf, "events").select("event_type", F.from_json("props", "k long").alias("p"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("p.k").alias("k_sum"))


@query("""
WITH m AS (SELECT max(ts) AS last FROM events) SELECT user_id, count(*) FILTER (ts >= last - INTERVAL 7 DAY) AS recent, count(*) FILTER (ts < last - INTERVAL 7 DAY) AS stale, max(ts) AS last_seen FROM events, m GROUP BY user_id
""")
def recent_window(spark, sf):
    """Recency is measured from the corpus's last event."""
    e = read(spark, sf, "events")
    last = e.agg(F.max("ts").alias("last")).first()["last"]
    recent = F.col("ts") >= F.lit(last) - F.expr("INTERVAL 7 DAYS")
    return e.groupBy("user_id").agg(F.count_if(recent).alias("recent"), F.count_if(~recent).alias("stale"), F.max("ts").alias("last_seen"))


@query("SELECT user_id, min(ts) AS first_time, max(ts) AS last_time, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 6e7, 4) AS minutes FROM events GROUP BY user_id")
def issue_time_span(spark, sf):
    g = read(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("first_time"), F.max("ts").alias("last_time"))
    return g.withColumn("minutes", F.round(T.minutes_between("first_time", "last_time"), 4))


@query("""
SELECT event_id, user_id, round((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 6e7, 4) AS gap_minutes FROM events
""")
def event_gaps(spark, sf):
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return read(spark, sf, "events").select("event_id", "user_id", F.round(T.minutes_between(F.lag("ts").over(order), F.col("ts")), 4).alias("gap_minutes"))


def ruled(spark, sf):
    e = read(spark, sf, "events")
    kind = F.crc32(F.col("event_type").cast("binary")) % 3
    idx = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    role = F.when(kind == 0, "customer").when(kind == 1, "support").otherwise("internal")
    rows = e.select(F.col("user_id").alias("document_id"), idx.cast("long").alias("idx"), "ts", F.concat_ws("-", F.lit("s"), (F.col("event_id") % 4).cast("string")).alias("speaker"), role.alias("role"), (F.col("event_id") % 2 == 0).alias("is_question"), (F.col("event_id") % 11 == 0).alias("is_noise"))
    return segments.rule_segments(rows)


@query()
def issue_segments_full_rules(spark, sf):
    """Segments by all four rules, with why they start and end."""
    return ruled(spark, sf).groupBy("document_id", "segment", "start_reason", "end_reason").agg(F.count("*").alias("n"), F.min("ts").alias("start_time"))


@query()
def segment_keep_filter(spark, sf):
    return segments.keep_segments(ruled(spark, sf))
