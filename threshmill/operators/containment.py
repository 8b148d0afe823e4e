"""Verbatim containment of many short texts in many long ones, by keys that the long text is sure to hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threshmill.functions import text as T

#: Item keys that may be broadcast, as hashes of 64 bits.
BROADCAST_KEYS = 500_000
#: Inner words and first characters of a key at most.
WORDS, CHARS = 3, 3


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def _key(kind: str, *parts: Column) -> Column:
    return F.xxhash64(F.lit(kind), *parts)


def item_keys(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_text, kind, key), keys as hashes. An item may begin and end inside a word, so only its inner words are sure to be whole.

    Up to three of them are the key; an item without inner words has its first three characters, or all it has.
    """
    rows = items.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("item"), F.col(text_col).alias("item_text"), _words(F.col(text_col)).alias("w"))
    inner = F.least(F.size("w") - 2, F.lit(WORDS))
    chars = F.least(F.length("item_text"), F.lit(CHARS))
    kind = F.when(inner > 0, F.concat(F.lit("words "), inner.cast("string"))).otherwise(F.concat(F.lit("chars "), chars.cast("string")))
    key = _key("chars", F.substring("item_text", F.lit(1), chars))
    for n in range(1, WORDS + 1):
        key = F.when(inner == n, _key("words", *(F.get("w", F.lit(i + 1)) for i in range(n)))).otherwise(key)
    return rows.select("item", "item_text", kind.alias("kind"), key.alias("key"))


def document_keys(text: Column, kind: str) -> Column:
    """Hashes of all keys of a kind that a text holds."""
    unit, size = kind.split()[0], int(kind.split()[1])
    if unit == "words":
        starts = lambda w: F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
        return T.once(_words(text), lambda w: F.transform(starts(w), lambda i: _key(unit, *(F.get(w, i + n) for n in range(size)))))
    found = T.shingles(text, size) if size else F.array(F.lit(""))
    return F.transform(found, lambda k: _key(unit, k))


def contained(items: DataFrame, docs: DataFrame, item_id: str, item_text: str, doc_id: str, doc_text: str) -> DataFrame:
    """Pairs (item, doc) where the document's text holds the item's, character by character.

    Documents' keys are met with the items' where they are made, as long as those are few enough to be broadcast, and by a
    shuffle else; only pairs with a common key are compared whole. Null texts hold nothing and are in nothing; an
    empty item is in every text.
    """
    keys = item_keys(items, item_id, item_text)
    counted = keys.groupBy("kind").agg(F.countDistinct("key").alias("n")).collect()  # a row for each kind
    if not counted:
        return docs.sparkSession.createDataFrame([], f"item {dict(items.dtypes)[item_id]}, doc {dict(docs.dtypes)[doc_id]}")
    few = sum(r.n for r in counted) <= BROADCAST_KEYS
    texts = docs.filter(F.col(doc_text).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(doc_text).alias("doc_text"))
    spread = texts.select("doc", F.explode(F.concat(*(document_keys(F.col("doc_text"), r.kind) for r in counted))).alias("key"))
    wanted = keys.select("key").distinct()
    met = spread.join(F.broadcast(wanted) if few else wanted, "key", "left_semi").distinct()
    near = met.join(keys.select("key", "item"), "key").select("doc", "item").distinct()
    whole = near.join(keys.select("item", "item_text").distinct(), "item").join(texts, "doc")
    return whole.filter(F.contains("doc_text", F.col("item_text"))).select("item", "doc").distinct()
