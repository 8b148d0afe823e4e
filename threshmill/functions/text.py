"""Scalar text functions as Column expressions. Classes are Unicode, as the semantics ask for."""

from collections.abc import Iterable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Null, NaN-like and blank become ''; ideographic space is stripped as other space is."""
    return F.coalesce(F.regexp_replace(_col(c).cast("string"), _EDGES, ""), F.lit(""))


def normalize(c: Column | str) -> Column:
    """Letters and digits alone, lower case."""
    return F.lower(F.regexp_replace(_col(c), r"[^\p{L}\p{N}]+", ""))


# The characters that the comparison normalisers drop.
PUNCTUATION = "，。！？；：、,.!?;:-_()（）[]【】"
QUOTES = "\"'“”‘’"


def _without(c: Column | str, characters: str) -> Column:
    quoted = "".join("\\" + x if not x.isalnum() else x for x in characters)
    return F.regexp_replace(_col(c), rf"(?U)[\s{quoted}]+", "")


def normalize_compact(c: Column | str, quotes: bool = True, lower: bool = True) -> Column:
    out = _without(c, PUNCTUATION + (QUOTES if quotes else ""))
    return F.lower(out) if lower else out


def extract_title(text: Column | str, fallback: Column | str) -> Column:
    """The first top heading of a Markdown text, else the fallback."""
    found = F.trim(F.regexp_extract(_col(text), r"(?m)^#[ \t]+(.+)$", 1))
    return F.coalesce(F.when(found != "", found), _col(fallback))


def count_words(c: Column | str) -> Column:
    return F.regexp_count(_col(c), F.lit(r"[^ \t\n\x0B\f\r]+"))


def lines(c: Column | str) -> Column:
    """Lines at any line boundary, without an empty last one."""
    all_lines = F.split(_col(c), "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    last = F.element_at(all_lines, -1)
    return F.when(_col(c) == "", F.array().cast("array<string>")).when(last == "", F.slice(all_lines, 1, F.size(all_lines) - 1)).otherwise(all_lines)


TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm")


def parse_timestamp(c: Column | str, formats: Iterable[str] = TIMESTAMP_FORMATS) -> Column:
    return F.coalesce(*(F.try_to_timestamp(_col(c), F.lit(f)) for f in formats))


def minutes_between(earlier: Column | str, later: Column | str) -> Column:
    return (F.unix_micros(_col(later).cast("timestamp")) - F.unix_micros(_col(earlier).cast("timestamp"))) / F.lit(60_000_000.0)


def month_key(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    return F.when(F.coalesce(_col(b), F.lit(0)) == 0, 0.0).otherwise(_col(a) / _col(b))


def duration(seconds: Column | str) -> Column:
    s = _col(seconds).cast("int")
    return F.format_string("%02d:%02d", (s / 60).cast("int"), s % 60)


def sha256(c: Column | str) -> Column:
    return F.sha2(F.encode(_col(c), "utf-8"), 256)


def fingerprint(c: Column | str, length: int = 24) -> Column:
    return F.substring(sha256(c), 1, length)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with keys in alphabetical order and nulls kept."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def strip_fences(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"(?s)^\s*```[a-zA-Z]*\s*|\s*```\s*$", ""))


def first_json(c: Column | str, array: bool = False) -> Column:
    """The widest object or array in a model's answer."""
    return F.regexp_extract(_col(c), r"(?s)\[.*\]" if array else r"(?s)\{.*\}", 0)


def split_keys(c: Column | str, separator: str = r"\|") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != "")


def unique_nonempty(values: Column | str) -> Column:
    return F.array_distinct(F.filter(_col(values), lambda x: x.isNotNull() & (x != "")))


def join_list(values: Column | str, separator: str = " | ") -> Column:
    return F.array_join(_col(values), separator)


def bool_value(c: Column | str) -> Column:
    return F.lower(F.trim(F.coalesce(_col(c).cast("string"), F.lit("")))).isin("true", "1", "yes", "y")


def confidence_value(c: Column | str) -> Column:
    """'85%' is 85.0 and what is no number 0.0."""
    return F.coalesce(F.rtrim(F.regexp_replace(F.trim(_col(c).cast("string")), "%$", "")).try_cast("double"), F.lit(0.0))


def clamp01(c: Column | str, default: float = 0.5) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(_col(c).try_cast("double"), F.lit(default))))


def once(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(c: Column | str, size: int = 2, stride: int = 1) -> Column:
    """Distinct character n-grams at every ``stride``; a shorter text is its own only one.

    The text is cut into characters once, for a place in UTF-8 is found by counting from the beginning.
    """
    characters = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit("(?s)."), F.lit(0))
    gram = lambda of, i: F.array_join(F.slice(of, i, size), "")
    grams = once(characters, lambda of: F.transform(F.sequence(F.lit(1), F.greatest(F.size(of) - size + 1, F.lit(1)), F.lit(stride)), lambda i: gram(of, i)))
    return F.array_distinct(F.filter(grams, lambda g: g != ""))


def content_bigrams(c: Column | str, stop: str) -> Column:
    """Bigrams that hold none of the stop characters."""
    grams = shingles(c, 2)
    return F.filter(grams, lambda g: (F.length(g) == 2) & ~g.rlike("[" + "".join("\\" + x if not x.isalnum() else x for x in stop) + "]"))


def grounded_ratio(content: Column | str, source: Column | str, size: int = 2) -> Column:
    """Share of the content's shingles that the source has."""
    shared = lambda own: F.size(F.array_intersect(own, shingles(source, size))) / F.size(own)
    return once(shingles(content, size), lambda own: F.when(F.size(own) == 0, 0.0).otherwise(shared(own)))


def coverage(source: Column | str, target: Column | str, size: int = 25, stride: int = 5) -> Column:
    shared = lambda own: F.size(F.array_intersect(own, shingles(target, size))) / F.size(own)
    return once(shingles(source, size, stride), lambda own: F.when(F.size(own) == 0, 0.0).otherwise(shared(own)))


def grounded_phrase(phrase: Column | str, source: Column | str) -> Column:
    """A phrase of the source: verbatim, long with most of its characters, or short with all of them and a bigram."""
    p, s = normalize_compact(phrase), normalize_compact(source)
    own = F.array_distinct(F.split(p, ""))
    share = F.size(F.array_intersect(own, F.array_distinct(F.split(s, "")))) / F.greatest(F.size(own), F.lit(1))
    bigram = F.size(F.array_intersect(shingles(p), shingles(s))) > 0
    n = F.length(p)
    return (n > 0) & (F.contains(s, p) | ((n >= 6) & (share >= 0.85)) | ((n < 6) & (share == 1.0) & bigram))


def bigram_jaccard(a: Column | str, b: Column | str) -> Column:
    x, y = shingles(a), shingles(b)
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1)))


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Equal pairs of a batch are compared once."""
    known: dict = {}
    out = []
    for pair in zip(a, b):
        if pair not in known:
            known[pair] = 1.0 if pair[0] == pair[1] else SequenceMatcher(None, *pair).ratio()
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def sequence_similarity(a: Column | str, b: Column | str) -> Column:
    """Ratcliff-Obershelp ratio; no built-in gives it, so texts cross to Python in Arrow batches.

    A function made once, so that a plan that asks for the same ratio twice compares once.
    """
    return _ratio(F.coalesce(_col(a), F.lit("")), F.coalesce(_col(b), F.lit("")))


def text_similarity(a: Column | str, b: Column | str) -> Column:
    return 0.65 * sequence_similarity(a, b) + 0.35 * bigram_jaccard(a, b)


def issue_similarity(normalized: tuple, question: tuple, description: tuple) -> Column:
    """Of two issues, each given as pairs of columns: their normalized questions above all, then questions and descriptions."""
    return 0.6 * text_similarity(*normalized) + 0.3 * text_similarity(*question) + 0.1 * text_similarity(*description)


def summary_clauses(c: Column | str) -> Column:
    """Clauses of a summary after its first colon, without their numbers (fixed values: the full-width marks)."""
    text = clean_text(c)
    at = F.instr(text, "：")
    body = F.regexp_replace(F.trim(F.when(at > 0, F.substring(text, at + 1, F.length(text))).otherwise(text)), "。+$", "")
    plain = F.transform(F.split(body, "；"), lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), r"^[0-9]+\.\s*", ""), r"^原因[一二三四五六七八九十]+[:：]\s*", ""))
    return F.filter(plain, lambda x: x != "")


def preview(c: Column | str, characters: int) -> Column:
    return F.substring(_col(c), 1, characters)


def mention_lines(c: Column | str, pattern: str, characters: int = 120) -> Column:
    """array<struct<line, found, context>>: each mention with its 1-based line and that line's first characters."""
    marked = F.transform(lines(c), lambda line, i: F.transform(F.regexp_extract_all(line, F.lit(pattern), F.lit(0)), lambda m: F.struct((i + 1).alias("line"), m.alias("found"), F.substring(line, 1, characters).alias("context"))))
    return F.flatten(marked)


def pair_key(a: Column | str, b: Column | str) -> Column:
    return F.concat_ws("||", F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b)))


def issue_key(candidate: Column | str, seq: Column | str, row: Column | str) -> Column:
    c, s = clean_text(candidate), clean_text(seq)
    numbered = F.format_string("ROW-%05d", _col(row) + 1)
    return F.when((c != "") & (s != ""), F.concat_ws("#", c, s)).when(c != "", F.concat_ws("#", c, numbered)).otherwise(numbered)


def is_semver(c: Column | str) -> Column:
    return _col(c).rlike(r"^\d+\.\d+\.\d+$")


def semver_key(c: Column | str) -> Column:
    return F.transform(F.split(_col(c), r"\."), lambda x: x.cast("int"))


def chunk_text(question: Column | str, answer: Column | str) -> Column:
    return F.concat(F.lit("问题："), _col(question), F.lit("\n答案："), _col(answer))


def mentions(c: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(0))


DATE_MENTION = r"\d{4}-\d{2}(?:-\d{2})?"
VERSION_MENTION = r"[vV]\d+(?:\.\d+)+"
