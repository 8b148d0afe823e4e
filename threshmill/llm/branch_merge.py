"""Three-way merge of two edited branches of a table of documents (operator 12), in DataFrame functions alone.

A document's base row holds all that its branches are made of, so a row is merged by itself: the text is split into
lines, ``transform`` with the line's index gives each line its pair of edit codes and then its merged state, counters are
aggregated over the states, and the surviving lines are flattened, joined and hashed. Lines never become rows and
nothing is shuffled. Rows that a branch adds are merged in a second scan, which reads no text.

Edits of a branch come from ``code``: crc32 of ``branch:doc_id:name`` modulo 7, for the names ``row``, ``lang``,
``source`` and each line's number. Merge rules: columns (by value), lines, and gaps after lines are merged apart; what one
branch changed, or both alike, is one clean change, and anything else one conflict that takes the right branch's
state. A dropped row counts alone: it is clean, or one conflict of edit and delete if the other branch keeps the row with
changes; the row is then as the right branch has it.

Defined results: null text, lang and source count as empty; an empty text is one empty line; a null identifier has
the empty text as its name, and so has the row added for it a null one; rows with one identifier are merged each by
itself; an added row whose identifier stands in the table already is a row of its own; other columns are ignored; of an
empty table there are no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared

LEFT, RIGHT = "L", "R"
#: Codes of edits: 0 drops, 1 and 2 append a mark, 3 and 4 insert one after it; others change nothing.
MODULUS, DROP, NONE = 7, 0, 6
MARKS = {1: "!", 2: "?", 3: "!", 4: "?"}
COUNTERS = ("n_clean", "n_edit_edit", "n_edit_delete", "n_insert_insert")
COLUMNS = ("lang", "source")


def code(branch: str, doc_id: Column, name: Column) -> Column:
    """The branch's edit of a row, column or line."""
    named = F.concat(F.lit(f"{branch}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), name.cast("string"))
    return (F.crc32(named) % MODULUS).cast("tinyint")


def _mark(of: Column, first: int) -> Column:
    return F.when(of == first, MARKS[first]).otherwise(MARKS[first + 1])


def _edits(of: Column) -> Column:
    return of <= 2


def _inserts(of: Column) -> Column:
    return of.between(3, 4)


def _counts(changed_l: Column, changed_r: Column, equal: Column, clash: Column) -> Column:
    """0: no change, 1: clean, else the number of the counter that a conflict falls under."""
    return F.when(changed_l & changed_r & ~equal, clash).when(changed_l | changed_r, 1).otherwise(0).cast("tinyint")


def _total(kinds: list[Column]) -> list[Column]:
    """Of counter numbers, how often each of ``COUNTERS`` stands there."""
    return [reduce(lambda x, y: x + y, ((k == i).cast("long") for k in kinds)) for i in range(1, len(COUNTERS) + 1)]


def merged_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base rows after the merge: doc_id, lang, source, text (null where the row is gone) and the counters."""
    key = F.col("doc_id")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in COLUMNS), shared.text_or_empty(text_col).alias("text"))
    gone = lambda b: code(b, key, F.lit("row")) == DROP
    rows = rows.withColumns({"gone_l": gone(LEFT), "gone_r": gone(RIGHT)})

    # A line: its text and what each branch does to it. A dropped row's branch changes no line.
    line = lambda x, i: F.struct(x.alias("line"), code(LEFT, key, i).alias("l"), code(RIGHT, key, i).alias("r"))
    rows = rows.withColumn("lines", F.transform(F.split("text", "\n", -1), line))
    touched = lambda side: F.exists("lines", lambda s: s[side] <= 4)

    def column(name: str, branch: str) -> Column:
        c = code(branch, key, F.lit(name))
        return F.when(c == DROP, "").when(_edits(c), F.concat(name, _mark(c, 1))).otherwise(F.col(name))

    rows = rows.withColumns({f"{c}_{b.lower()}": column(c, b) for c in COLUMNS for b in (LEFT, RIGHT)})
    differs = lambda side: reduce(lambda x, y: x | y, (F.col(f"{c}_{side}") != F.col(c) for c in COLUMNS)) | touched(side)
    # How a dropped row ends: 0 both keep it, 1 clean, 3 a conflict.
    fate = F.when(F.col("gone_l") & F.col("gone_r"), 1).when(F.col("gone_l"), F.when(differs("r"), 3).otherwise(1)).when(F.col("gone_r"), F.when(differs("l"), 3).otherwise(1)).otherwise(0)
    rows = rows.withColumn("fate", fate)

    def state(s: Column) -> Column:
        """A line's merged state: lines that stand in its place, and the counters that line and gap fall under."""
        l, r = F.when(F.col("gone_l"), NONE).otherwise(s["l"]), s["r"]
        own = F.when(_edits(r), r).when(_edits(l), l).otherwise(NONE)
        put = F.when(_inserts(r), r).when(_inserts(l), l).otherwise(NONE)
        kept = F.when(own == DROP, F.array().cast("array<string>")).when(_edits(own), F.array(F.concat(s["line"], _mark(own, 1)))).otherwise(F.array(s["line"]))
        added = F.when(_inserts(put), F.array(_mark(put, 3))).otherwise(F.array().cast("array<string>"))
        clash = F.when((l == DROP) | (r == DROP), 3).otherwise(2)
        return F.struct(F.concat(kept, added).alias("lines"), _counts(_edits(l), _edits(r), l == r, clash).alias("line"), _counts(_inserts(l), _inserts(r), l == r, F.lit(4)).alias("gap"))

    rows = rows.withColumn("states", F.transform("lines", state))
    zero = F.struct(*(F.lit(0).cast("long").alias(c) for c in COUNTERS))
    add = lambda acc, s: F.struct(*((acc[c] + n).alias(c) for c, n in zip(COUNTERS, _total([s["line"], s["gap"]]))))
    rows = rows.withColumn("counted", F.aggregate("states", zero, add))
    column_kinds = [_counts(F.col(f"{c}_l") != F.col(c), F.col(f"{c}_r") != F.col(c), F.col(f"{c}_l") == F.col(f"{c}_r"), F.lit(2)) for c in COLUMNS]
    by_parts = [F.col("counted")[c] + n for c, n in zip(COUNTERS, _total(column_kinds))]

    # The row is gone where its drop is clean or the right branch has dropped it, else kept.
    stays = (F.col("fate") == 0) | (F.col("fate") == 3) & ~F.col("gone_r")
    merged = lambda c: F.when(F.col("gone_l") | (F.col(f"{c}_r") != F.col(c)), F.col(f"{c}_r")).otherwise(F.col(f"{c}_l"))
    text = F.array_join(F.flatten(F.transform("states", lambda s: s["lines"])), "\n")
    counters = [F.when(F.col("fate") == 0, n).otherwise((F.col("fate") == i).cast("long")).alias(c) for i, (c, n) in enumerate(zip(COUNTERS, by_parts), 1)]
    return rows.select("doc_id", *(F.when(stays, merged(c)).alias(c) for c in COLUMNS), F.when(stays, text).alias("text"), *counters)


def added_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that a branch or both add, in the columns of ``merged_rows``; the right branch's if they differ."""
    key = F.col("doc_id")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in COLUMNS))
    rows = rows.withColumns({"l": code(LEFT, key, F.lit("row")), "r": code(RIGHT, key, F.lit("row"))})
    l, r = F.col("l"), F.col("r")
    kind = _counts(_inserts(l), _inserts(r), l == r, F.lit(4))
    own = F.when(_inserts(r), _mark(r, 3)).otherwise(_mark(l, 3))
    rows = rows.filter(_inserts(l) | _inserts(r))
    return rows.select((-1 - key).alias("doc_id"), *COLUMNS, own.alias("text"), *(n.alias(c) for c, n in zip(COUNTERS, _total([kind]))))


def merge_branches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every identifier that any branch ever had: doc_id, lang, source, text after the merge (null where gone), counters."""
    return merged_rows(docs, id_col, text_col).unionByName(added_rows(docs, id_col))


def op12_branch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: both branches of all ``documents`` merged, texts as digests."""
    merged = merge_branches(shared.table(spark, sf_dir, "documents"))
    return merged.select("doc_id", *COLUMNS, F.sha2("text", 256).alias("text_sha256"), *COUNTERS)
