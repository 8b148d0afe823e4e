"""Chained hashes of sources against whole lists of messages."""

import random

import pytest
from pyspark.sql import functions as F

from threshmill.operators import incremental

ROWS = "source string, idx int, message_sha256 string"


def frame(spark, sources):
    rows = [(s, i * 3, h) for s, hashes in sources.items() for i, h in enumerate(hashes)]
    random.Random(1).shuffle(rows)
    return incremental.chained(spark.createDataFrame(rows, ROWS))


def by_lists(old, new):
    out = {}
    for s, hashes in new.items():
        was = old.get(s)
        same = sorted(k for k, v in old.items() if v == hashes)
        differs = next((i for i in range(max(len(was or []), len(hashes))) if (was or [])[i : i + 1] != hashes[i : i + 1]), None)
        change = "unchanged" if was == hashes else "moved" if was is None and same else "new" if was is None else "appended" if hashes[: len(was)] == was else "modified"
        out[s] = (same[0] if change == "moved" else None, change, len(was or []), len(hashes), differs)
    return out


@pytest.mark.parametrize("links", [1, 4, 4096])
def test_changes_equal_those_of_lists(spark, monkeypatch, links):
    monkeypatch.setattr(incremental, "LINKS", links)
    rng = random.Random(links)
    old, new = {}, {}
    for k in range(60):
        own = [rng.choice("abcd") for _ in range(rng.randrange(1, 14))]
        old[f"s{k}"] = own
        at = rng.randrange(len(own))
        changed = [own, own + ["x"] * rng.randrange(1, 5), own[:at] + ["y"] + own[at + 1 :], own[:at] + own[at + 1 :], own[:at] + ["z"] + own[at:], own[::-1]][k % 6]
        if k % 10 == 9:
            new[f"moved{k}"] = own
        elif changed:
            new[f"s{k}"] = changed
    new |= {"fresh": ["only", "here"], "hot": ["m"] * 3000 + ["end"]}
    old["hot"] = ["m"] * 3000
    got = {r.source: tuple(r)[1:] for r in incremental.classify(frame(spark, old), frame(spark, new)).collect()}
    assert got == by_lists(old, new)
    assert {c[1] for c in got.values()} == {"unchanged", "moved", "appended", "modified", "new"}


def test_a_source_is_spread_over_ranges(spark):
    """The links of one source come from many ranges, and no step gathers a source into an array."""
    rows = spark.range(5000).select(F.lit("hot").alias("source"), F.col("id").cast("int").alias("idx"), F.sha2(F.col("id").cast("string"), 256).alias("message_sha256"))
    links = incremental.chained(rows)
    assert links.agg(F.countDistinct("chain"), F.max("place")).first()[:] == (5000, 4999)
    plan = links._jdf.queryExecution().optimizedPlan().toString() + incremental.classify(links, links)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one range
    try:
        again = incremental.chained(rows)
        assert again.exceptAll(links).count() == 0 and again.count() == 5000
        assert rows.repartitionByRange("source", "idx", "message_sha256").select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], ROWS)
    one = frame(spark, {"a": ["x", "x", "x"]})
    assert incremental.chained(none).count() == 0
    assert [r.change for r in incremental.classify(incremental.chained(none), one).collect()] == ["new"]
    assert incremental.classify(one, incremental.chained(none)).count() == 0
    assert one.select("chain").distinct().count() == 3
