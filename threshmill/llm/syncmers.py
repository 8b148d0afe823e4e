"""Document fingerprints of closed syncmers (operator 4), in DataFrame functions alone.

A text's tokens are pieces of up to ``PIECE`` characters of its words. An inner mer is a pair of neighbouring tokens; a
k-mer has ``WINDOW`` inner mers, that is WINDOW + 1 tokens. A k-mer is a closed syncmer if the inner mer with the
smallest hash stands at its first or last place: that depends on nothing outside it, so a stretch of text gives the
same anchors wherever it stands, and anchors carry positions for matching. Short texts have few of them or none, so single
tokens stand beside them, those whose hash falls among the first ``SHORT / n`` of all hashes for a text of n tokens:
every token of a short text and some ``SHORT`` of a longer one, wherever they stand. That is one rule for all lengths,
and texts of nearly one length sample nearly the same tokens. The fingerprint holds the ``SKETCH`` smallest distinct
hashes of the whole text in hex, and two fingerprints' likeness is the estimate of the Jaccard similarity of those sets.

Defined results: a null or empty text has an empty fingerprint, and two empty ones are alike (1.0); of rows with
one identifier, the order is that of their text's hash; a null identifier comes first; the only row is its own next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threshmill.llm import shared

PIECE = 4
WINDOW = 8
#: Tokens that a fingerprint samples beside its anchors.
SHORT = 4 * WINDOW
SKETCH = 64
#: Runs of the next-document step for each shuffle partition, and sampled identifiers for each run.
RUNS, RUN_SAMPLE = 8, 16


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(\S{{1,{PIECE}}})"), F.lit(1))


def _anchors(t: Column, position: bool) -> Column:
    def found(inner: Column) -> Column:
        def pair_min(x: Column, of: Column, i: Column, step: int) -> Column:
            return F.least(x, F.get(of, i + step))

        def chosen(low: Column) -> Column:
            last = F.size(inner) - WINDOW

            def anchor(x: Column, i: Column) -> Column:
                mer = F.hash(*(F.get(inner, i + j) for j in range(0, WINDOW, 2)), F.get(inner, i + WINDOW - 1))
                mer = F.struct(i.cast("int").alias("position"), mer.alias("hash")) if position else mer
                return F.when((i <= last) & ((x == F.get(inner, i)) | (x == F.get(inner, i + WINDOW - 1))), mer)

            return F.filter(F.transform(low, anchor), lambda a: a.isNotNull())

        twos = lambda of: F.transform(of, lambda x, i: pair_min(x, of, i, 1))
        fours = lambda of: F.transform(of, lambda x, i: pair_min(x, of, i, 2))
        eights = lambda of: F.transform(of, lambda x, i: pair_min(x, of, i, 4))
        return _let(twos(inner), lambda two: _let(fours(two), lambda four: _let(eights(four), chosen)))

    inner = F.slice(F.transform(t, lambda x, i: F.xxhash64(x, F.get(t, i + 1))), F.lit(1), F.greatest(F.size(t) - 1, F.lit(0)))
    return _let(inner, found)


def anchors(text: Column) -> Column:
    """array<struct<position, hash>>: the closed syncmers of a text by their first token's index; a text without a whole k-mer has none."""
    return _let(tokens(text), lambda t: _anchors(t, True))


def sampled_tokens(t: Column) -> Column:
    """Hashes of the tokens that fall among the first ``SHORT / n`` of all hashes, n being the tokens' number."""
    share = lambda x: F.xxhash64(x, F.lit(3)).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    return F.transform(F.filter(t, lambda x: share(x) * F.size(t) < SHORT), lambda x: F.hash(x))


def sketch(text: Column) -> Column:
    """The smallest distinct hashes of closed syncmers and sampled tokens, ascending."""
    hashes = _let(tokens(text), lambda t: F.concat(_anchors(t, False), sampled_tokens(t)))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, SKETCH)


def as_text(of: Column) -> Column:
    return F.lower(F.array_join(F.transform(of, lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Of two sketches: the share of the smallest hashes of both together that both hold."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    joint = _let(both, lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(joint)


def match_offset(a: Column, b: Column) -> Column:
    """The shift in tokens that most anchors of two position arrays agree on; null without a common anchor."""
    shifts = F.flatten(F.transform(a, lambda x: F.transform(F.filter(b, lambda y: y["hash"] == x["hash"]), lambda y: y["position"] - x["position"])))
    counted = F.transform(F.array_distinct(shifts), lambda s: F.struct((-F.size(F.filter(shifts, lambda z: z == s))).alias("n"), s.alias("shift")))
    return F.element_at(F.array_sort(counted), 1)["shift"]


#: Columns added to the documents' own, by names that those will not have.
RUN, FOLLOWED, HEAD = "_next_run", "_next_followed", "_next_head"


def run_cuts(docs: DataFrame, id_col: str, runs: int) -> list[int]:
    """Ascending identifiers at which runs begin, the smallest first, from a bounded sample of them.

    An identifier that many rows have may stand there more than once.
    """
    n, least = docs.agg(F.count(id_col), F.min(id_col)).first()
    if not n:
        return []
    sample = docs.select(id_col).filter(F.col(id_col).isNotNull() & (F.rand(17) < min(1.0, runs * RUN_SAMPLE / n)))
    found = sorted(r[0] for r in sample.limit(2 * runs * RUN_SAMPLE).collect())  # some ``RUN_SAMPLE`` for each run
    return [least, *found[RUN_SAMPLE::RUN_SAMPLE]]


def run_of(value: Column, tie: Column, cuts: list[int]) -> Column:
    """The run of a row: 0 without an identifier, else the number of cuts up to it, by binary search.

    Rows of one identifier with several cuts are dealt over their runs by ranges of the tie, a hash.
    """
    depth = len(cuts).bit_length()
    places = F.lit([*cuts, *[(1 << 63) - 1] * ((1 << depth) - len(cuts))])
    steps = F.lit([1 << i for i in reversed(range(depth))])

    def count(before) -> Column:
        return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(before(F.get(places, at + step - 1)), step).otherwise(0))

    upto = F.least(count(lambda cut: cut <= value), F.lit(len(cuts)))
    if len(set(cuts)) < len(cuts):
        below = count(lambda cut: cut < value)
        many = upto - below
        part = F.floor((tie.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64) * many).cast("int")
        upto = F.when(many > 1, below + 1 + F.least(part, many - 1)).otherwise(upto)
    return F.when(value.isNull(), 0).otherwise(upto)


def with_next(docs: DataFrame, id_col: str, tie: str, columns: list[str], derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows by (identifier, tie), the first row's to the last.

    Rows are dealt by ranges of identifiers whose cuts come from a sample, so that clustered, wide or frequent identifiers
    fill no single run; there are ``RUNS`` for each shuffle partition. One exchange brings a run together, where a window
    leads within it, and an aggregate over the same exchange finds its first row for the last of the run before. Of rows
    alike in identifier and tie, all stand in one run. ``derive`` adds columns before the exchange.
    """
    partitions = shared.parallelism(docs.sparkSession)
    cuts = run_cuts(docs, id_col, partitions * RUNS)
    run = run_of(F.col(id_col), F.col(tie), cuts)
    if len(set(cuts)) < len(cuts):  # parts of an identifier may be empty; there are as many rows as runs
        there = sorted(r[0] for r in docs.select(run.alias(RUN)).distinct().collect())
    else:
        there = [0] * bool(docs.filter(F.col(id_col).isNull()).limit(1).count()) + [*range(1, len(cuts) + 1)]
    before = [0] * (len(cuts) + 1)
    for i, r in enumerate(there):
        before[r] = there[i - 1]
    main = derive(docs.withColumn(RUN, run)).repartition(partitions, RUN)
    heads = main.groupBy(RUN).agg(F.min_by(F.struct(*main.columns), F.struct(id_col, tie)).alias(HEAD))
    # Never null, or else a filter for that would be pushed below the exchange, which could then not be shared.
    heads = heads.select(F.coalesce(F.get(F.lit(before), F.col(RUN)), F.lit(0)).alias("_next_of"), HEAD)
    order = Window.partitionBy(RUN).orderBy(F.col(id_col).asc_nulls_first(), tie)
    led = main.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns), F.lead(F.lit(True)).over(order).alias(FOLLOWED))
    joined = led.join(heads.hint("shuffle_hash"), (F.col(RUN) == F.col("_next_of")) & F.col(FOLLOWED).isNull(), "left")
    for c in columns:
        joined = joined.withColumn(f"next_{c}", F.when(F.col(FOLLOWED), F.col(f"next_{c}")).otherwise(F.col(HEAD)[c]))
    return joined.drop(RUN, FOLLOWED, HEAD, "_next_of")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``fingerprint`` to documents, without a shuffle."""
    return docs.withColumn("fingerprint", as_text(sketch(shared.text_or_empty(text_col))))


def op4_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: fingerprints of all ``documents`` and of their edited texts, and their likeness."""
    rows = shared.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), shared.text_or_empty().alias("text"))
    rows = with_next(rows.withColumn("tie", F.xxhash64("text")), "doc_id", "tie", ["text", "sketch"], lambda df: df.withColumn("sketch", sketch(F.col("text"))))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.select("*", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_sketch"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
