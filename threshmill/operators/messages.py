"""Messages: parsing chat files, speakers, and their roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T

# Fixed value: the line grammar of a chat file.
MESSAGE = r"^【([^】]+)】([^:：]+)[:：]\s*(.*)$"


def parse_messages(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """One row for each message line: its file, 1-based line number, timestamp, speaker, content and hash."""
    numbered = files.select(F.col(path_col).alias("source"), F.posexplode(T.lines(text_col)).alias("at", "line"))
    stripped = numbered.select("source", (F.col("at") + 1).alias("line_number"), T.clean_text("line").alias("line")).filter(F.col("line").rlike(MESSAGE))
    parts = {name: F.trim(F.regexp_extract("line", MESSAGE, i)) for i, name in enumerate(("timestamp", "speaker", "content"), 1)}
    rows = stripped.select("source", "line_number", *(v.alias(k) for k, v in parts.items()))
    return rows.withColumn("message_sha256", T.sha256(T.canonical_json(**{k: F.col(k) for k in ("content", "line_number", "speaker", "timestamp")})))


def speaker_profile(messages: DataFrame) -> DataFrame:
    return messages.groupBy("speaker").agg(F.count("*").alias("message_count"), F.countDistinct("source").alias("document_count"))


def speaker_features(messages: DataFrame, pack: str = "zh") -> DataFrame:
    """Counts and ratios of each speaker's messages; combined before the shuffle."""
    c = F.col("content")
    marked = messages.select("speaker", "source", F.length(c).alias("n"), *((P.hits(c, p[pack]) > 0).cast("int").alias(k) for k, p in (("q", P.QUESTION), ("a", P.ANSWER), ("i", P.INTERNAL))))
    out = marked.groupBy("speaker").agg(
        F.count("*").alias("message_count"), F.countDistinct("source").alias("document_count"), F.avg("n").alias("avg_message_length"),
        F.sum("q").alias("question_count"), F.sum("a").alias("answer_like_count"), F.sum("i").alias("internal_like_count"),
    )
    return out.select("*", *(T.safe_ratio(f"{k}_count", "message_count").alias(f"{r}_ratio") for k, r in (("question", "question"), ("answer_like", "answer"), ("internal_like", "internal"))))


def _steps(value: Column, *steps: tuple[float, float], otherwise: Column | float = 0.0) -> Column:
    return P.ladder(*((value >= at, F.lit(float(points))) for at, points in steps), otherwise=otherwise)


def role_scores(features: DataFrame) -> DataFrame:
    """Support, customer and internal scores; of each ladder the first rung that holds counts."""
    docs, n, q, a, i = (F.col(c) for c in ("document_count", "message_count", "question_ratio", "answer_ratio", "internal_ratio"))
    support = _steps(docs, (100, 6), (50, 5), (20, 4), (10, 2.5), (5, 1)) + _steps(n, (5000, 3), (1000, 2.5), (500, 2), (200, 1)) + F.when(q <= 0.08, 1.0).otherwise(0.0) + _steps(a, (0.4, 4), (0.25, 3), (0.15, 1.5))
    customer = F.when(docs <= 2, 1.5).otherwise(0.0) + F.when(n <= 10, 0.3).otherwise(0.0) + _steps(q, (0.5, 4), (0.35, 3), (0.2, 1.5)) + F.when((docs <= 3) & (q >= 0.2), 2.0).otherwise(0.0)
    internal = _steps(i, (0.3, 5), (0.2, 4), (0.1, 2.5), (0.05, 1)) + F.when((docs >= 10) & (i >= 0.1), 2.0).otherwise(0.0)
    return features.select("*", *(F.round(s, 3).alias(f"{name}_score") for name, s in (("support", support), ("customer", customer), ("internal", internal))))


def suggested_role(support_words: tuple[str, ...] = ("客服", "support"), internal_words: tuple[str, ...] = ("产品", "研发", "internal")) -> Column:
    """The role by name first, then by the best score where it is clear; ties keep the order support, customer, internal."""
    name = F.lower(F.trim(F.col("speaker").cast("string")))
    n, docs = F.col("message_count"), F.col("document_count")
    s, c, i = (F.col(f"{x}_score") for x in ("support", "customer", "internal"))
    top = F.greatest(s, c, i)
    best = P.ladder((s == top, "support"), (c == top, "customer"), otherwise="internal")
    second = F.element_at(F.sort_array(F.array(s, c, i)), 2)
    weak_internal = (best == "internal") & ((n < 20) | (F.col("internal_ratio") < 0.15) | (i < 4) | (i - s < 1.5))
    weak = (best != "internal") & ((top < 2.0) | (top - second < 1.0) | ((best == "support") & (n < 15) & (docs < 5)))
    return P.ladder(
        (name.isin(*P.GENERIC_CUSTOMERS), "customer"), (name.isin(*P.GENERIC_SYSTEMS), "unknown"), (P.has_any(name, support_words), "support"), (P.has_any(name, internal_words), "internal"),
        (n < 5, "unknown"), (docs >= 50, "support"), (weak_internal | weak, "unknown"), otherwise=best,
    )
