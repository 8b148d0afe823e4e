"""Mixing sources to target weights by iterative proportional fitting (operator 7), in DataFrame functions alone.

Documents are counted into cells of source, language and topic, weighted by their tokens (words). The cells' weights are
raked in turn to the target shares of each of the three marginals until all hold. A cell's factor, its raked over its own
weight, times one scale gives the probability of its documents; the scale is calibrated so that the expected tokens are
``keep_share`` of all, with probabilities that would pass 1 held there. A document stays if the number that its
identifier hashes to is below its probability, so a run can be repeated and copies of a row share their fate.

The work on whole texts is one pass, combined by cell before the shuffle; raking works on cells by sums and joins. The
cells' probabilities go to the documents by broadcast if there are at most ``BROADCAST_CELLS`` of them, else by a join
that splits large keys.

Defined results: a null source or language is a value of its own; a null or empty text has no tokens, weighs nothing
and has its cell's probability (the scale alone where a cell has no tokens); targets for values that do not occur are
left out and the others scaled up; targets that the cells cannot meet together are met as far as ``ROUNDS`` go, with a
warning; rows with one identifier share their fate; of an empty table no rows come.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared

KEEP_SHARE = 0.6
ROUNDS, TOLERANCE = 60, 1e-7
BROADCAST_CELLS = 100_000
#: Power of a value's own share that is its target share: 1 leaves a marginal as it is, 0 makes it even.
POWERS = {"source": 0.5, "lang": 0.8, "topic": 0.7}
#: Topics in the order in which they are tried; the rest is prose. Each is a pattern, and strings in lower case of which
#: every text that it fits holds one, so that most texts need no regular expression.
TOPICS = {
    "legal": (r"(?i)\b(?:licen[cs]ed?|copyright|all rights reserved|warranty)\b", ("licence", "license", "copyright", "all rights reserved", "warranty")),
    "contact": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}|\+\d[\d ()-]{7,}", ("@", "+")),
    "code": (r"(?i)\b(?:token|key|password|secret)\s*[=:]\s*[\"']|[{};]\s*\n|</[a-z]+>", ("token", "key", "password", "secret", "{", "}", ";", "</")),
    "table": (r" \| [^|\n]+ \| ", (" | ",)),
}
DIMENSIONS = ("source", "lang", "topic")
SEED = "threshmill"


def topic_of(text: Column) -> Column:
    low = F.lower(text)
    found = F
    for name, (pattern, strings) in TOPICS.items():
        may = reduce(lambda a, b: a | b, (F.contains(low, F.lit(x)) for x in strings))
        found = found.when(may & text.rlike(pattern), name)
    return found.otherwise("prose")


def n_tokens(text: Column) -> Column:
    """Words: runs of anything but ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def chance(id_col: str) -> Column:
    """A number in [0, 1) from an identifier, by its MD5."""
    digits = F.substring(F.md5(F.concat_ws("/", F.lit(SEED), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, powers: dict[str, float] = POWERS, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``raked`` to cells (source, lang, topic, tokens): weights whose marginals have the target shares.

    targets: by dimension, a table (value, share); without one, the power of the dimension's own shares.
    """
    spark = cells.sparkSession
    folder = shared.work_dir(spark, "mixing")
    few = cells.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS

    def written(df: DataFrame, name: str) -> DataFrame:
        """Few cells are one partition, whose sums and joins need no shuffle; many stay dealt out."""
        df = shared.staged(spark, df.coalesce(1) if few else df, f"{folder}/{name}")
        return df.coalesce(1) if few else df

    cells = written(cells, "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    cells = cells.withColumn("raked", F.col("tokens").cast("double"))
    if not total:
        return cells
    for d in DIMENSIONS:
        own = cells.groupBy(d).agg(F.sum("tokens").alias("own")).filter("own > 0")
        if targets and d in targets:
            given = targets[d].select(F.col("value").alias(d), F.col("share").cast("double").alias("wanted"))
            own = own.join(given, d, "left").withColumn("wanted", F.coalesce("wanted", F.lit(0.0)))
        else:
            own = own.withColumn("wanted", F.pow(F.col("own") / F.lit(float(total)), F.lit(powers[d])))
        all_wanted = own.agg(F.sum("wanted")).first()[0] or 1.0
        own = own.select(d, (F.col("wanted") / F.lit(all_wanted) * F.lit(float(total))).alias(f"target_{d}"))
        cells = cells.join(own, d, "left")
    cells = written(cells, "0")
    for i in range(1, rounds + 1):
        for d in DIMENSIONS:
            sums = cells.groupBy(F.col(d).alias("value")).agg(F.sum("raked").alias("sum"))
            ratio = F.when(F.col("sum") > 0, F.col(f"target_{d}") / F.col("sum")).otherwise(1.0)
            cells = cells.join(sums, F.col(d) == F.col("value"), "left").withColumn("ratio", F.coalesce(ratio, F.lit(1.0)))
            cells = cells.withColumn("raked", F.col("raked") * F.col("ratio")).withColumn(f"off_{d}", F.abs(F.col("ratio") - 1)).drop("ratio", "value", "sum")
        cells = written(cells, str(i))
        shared.remove(spark, f"{folder}/{i - 1}")
        worst = cells.filter("raked > 0").agg(F.max(F.greatest(*(f"off_{d}" for d in DIMENSIONS)))).first()[0]
        cells = cells.drop(*(f"off_{d}" for d in DIMENSIONS))
        if worst is None or worst < tolerance:
            break
    else:
        warnings.warn(f"raking ended after {rounds} rounds with marginals off by {worst:.3g}, more than {tolerance:.3g}: the targets contradict the cells", stacklevel=2)
    return cells.drop(*(f"target_{d}" for d in DIMENSIONS))


def calibrate(cells: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Adds ``factor`` and ``probability``: min(1, scale * factor), expecting ``keep_share`` of the tokens."""
    cells = cells.withColumn("factor", F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(1.0))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    wanted, scale = keep_share * total, keep_share
    for _ in range(100):  # cells held at 1 only become more, so this ends
        full = F.col("factor") * F.lit(scale) >= 1
        held, free = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("raked")))).first()
        if not free:
            break
        better = (wanted - held) / free
        if abs(better - scale) <= 1e-12 * scale:
            break
        scale = better
    return cells.withColumn("probability", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("factor") * F.lit(scale))))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_share: float = KEEP_SHARE, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """Adds mix_topic, mix_tokens, mix_factor, mix_probability and mix_kept to documents."""
    spark = docs.sparkSession
    text = shared.text_or_empty(text_col)
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0null"))
    marked = docs.withColumns({"mix_topic": topic_of(text), "mix_tokens": n_tokens(text), "mix_source": named("source"), "mix_lang": named("lang")})
    keys = {d: f"mix_{d}" for d in DIMENSIONS}
    cells = marked.groupBy(*(F.col(k).alias(d) for d, k in keys.items())).agg(F.sum("mix_tokens").alias("tokens"))
    cells = shared.staged(spark, cells, shared.work_dir(spark, "mixing-cells"))
    cells = calibrate(rake(cells, targets), keep_share)
    cells = cells.select(*(F.col(d).alias(k) for d, k in keys.items()), F.col("factor").alias("mix_factor"), F.col("probability").alias("mix_probability"))
    cells = shared.staged(spark, cells, shared.work_dir(spark, "mixing-probabilities"))
    if cells.count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    joined = marked.join(cells, [*keys.values()], "left").drop("mix_source", "mix_lang")
    return joined.withColumn("mix_kept", chance(id_col) < F.col("mix_probability"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the calibrated probability of all ``documents`` and whether each stays."""
    out = mixed(shared.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"), F.round("mix_factor", 6).alias("factor"), F.round("mix_probability", 6).alias("probability"), F.col("mix_kept").alias("kept"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the sample stays."""
    return mixed(docs).filter("mix_kept").select(*docs.columns)
