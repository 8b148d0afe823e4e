"""Verbatim containment against all pairs, and character shingles against slices."""

import random

import pytest
from pyspark.sql import functions as F

from threshmill.functions import text as T
from threshmill.operators import containment


def cases():
    rng = random.Random(8)
    words = ["one", "two", "three", "é", "数据", "a", "🙂x", "foo-bar"]
    docs = [(0, "one two three four five six"), (1, None), (2, ""), (3, "  lead and\ttrail \n")]
    docs += [(i, rng.choice(["", " "]) + rng.choice([" ", "  ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(4, 60)]
    items = [(1000 + k, t) for k, t in enumerate(["two three", "three", "two three four", "two three four fiv", "wo three four five si", "one two three four five six", "t", "x", "", None, " ", "ad and\ttr", "zz top", "  lead"])]
    for k in range(300):
        text = rng.choice(docs[4:])[1]
        at = rng.randrange(len(text))
        items.append((k, text[at : at + rng.randrange(1, 30)]))
    return items, docs


@pytest.mark.parametrize("few", [True, False])
def test_items_of_any_length(spark, monkeypatch, few):
    monkeypatch.setattr(containment, "BROADCAST_KEYS", 10**6 if few else 0)
    items, docs = cases()
    i, d = spark.createDataFrame(items, "id long, text string"), spark.createDataFrame(docs, "id long, text string")
    found = containment.contained(i, d, "id", "text", "id", "text").collect()
    wanted = {(k, n) for k, item in items for n, doc in docs if item is not None and doc is not None and item in doc}
    assert len(found) == len(wanted) and {tuple(r) for r in found} == wanted
    assert {k for k, _ in wanted} >= {1000, 1001, 1002, 1003, 1004, 1005, 1008}
    assert containment.contained(i.filter("false"), d, "id", "text", "id", "text").count() == 0
    assert containment.contained(i, d.filter("false"), "id", "text", "id", "text").count() == 0


def test_shingles(spark):
    texts = ["", "a", "ab", "abcabc", "数据🙂x数据", "line\nbreak\r\n", None, "x" * 20_000 + "y"]
    for size, stride in ((2, 1), (3, 2), (25, 5)):
        got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.shingles("t", size, stride)).collect()
        for t, (own,) in zip(texts, got):
            t = t or ""
            assert sorted(own) == sorted({t[i : i + size] for i in range(0, max(len(t) - size, 0) + 1, stride)} if t else set())
    assert spark.range(1).select(T.grounded_ratio(F.lit("abcd"), F.lit("xbcy")), T.grounded_ratio(F.lit(""), F.lit("a"))).first()[:] == (1 / 3, 0.0)
