"""Operators 2 and 10 against the library's own calls."""

import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threshmill.llm import packing, shared, sstable
from threshmill.llm.tokens import BatchEncoder, default_tokenizer, utf8

ENCODER = BatchEncoder(default_tokenizer())
ODD = [None, "", "a", " ", "  two  spaces ", "end \n", "\n\n\nThen  x", "a  b", "<|endoftext|> x<|endoftext|>", "don't 1²Ⅷ _x", "中文 字。", "\r\n\t mixed\x85 x", "é \U0001f642", "x" * 5000, "word " * 3000]


def library(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


def batch(texts):
    ids, edges = ENCODER.encode(*utf8(pa.array(texts, pa.string())))
    return [ids[edges[i] : edges[i + 1]].tolist() for i in range(len(texts))]


def test_odd_texts():
    assert batch(ODD) == [library(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'abZ9éñ’_ 中½"), st.characters(codec="utf-8")), max_size=30), max_size=12))
def test_any_texts(texts):
    assert batch(texts) == [library(t) for t in texts]


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(10 * i % 7 * 100 + i, t, "x") for i, t in enumerate(ODD)] + [(3, "again", "y"), (3, "again", "y"), (None, "no id", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, start string")


def test_shards_round_trip(spark, docs):
    manifest = sstable.write_shards(docs, shared.work_dir(spark, "t"), default_tokenizer(), shards=3)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sstable.read_shards(manifest).collect()), key=lambda r: r[1])
    rows = docs.collect()
    assert [g[0] for g in got] == sorted((r.doc_id for r in rows), key=lambda i: -1 if i is None else i)
    assert sorted(g[3] for g in got) == sorted(crc([*library(r.text), 0]) for r in rows)
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    assert [len(x) for x in sstable.lookup(manifest, 3)][-2:] == [len(library("again")) + 1] * 2
    assert [x.tolist() for x in sstable.lookup(manifest, None)] == [[*library("no id"), 0]]
    assert sstable.lookup(manifest, 999_999) == []


def test_shard_blocks_and_filter(tmp_path):
    with open(tmp_path / "s.sst", "wb") as f:
        writer = sstable.ShardWriter(f)
        for i in range(0, 3000, 3):
            writer.add(sstable.key_of(i), np.arange(i, dtype=np.uint32) + 60_000)
        writer.close()
    shard = sstable.Shard(str(tmp_path / "s.sst"))
    assert len(shard.places) > 3 and shard.documents == 1000
    assert [x.tolist() for x in shard.get(2997)] == [list(range(60_000, 62_997))] and shard.get(2996) == []
    assert sum(shard.may_hold(sstable.key_of(i)) for i in range(1, 3000, 3)) < 60
    damaged = (tmp_path / "s.sst").read_bytes()
    (tmp_path / "d.sst").write_bytes(damaged[:-57] + b"\xff" + damaged[-56:])
    with pytest.raises(ValueError):
        sstable.Shard(str(tmp_path / "d.sst"))


def test_empty_table(spark, docs):
    none = docs.filter("false")
    manifest = sstable.write_shards(none, shared.work_dir(spark, "t"), default_tokenizer())
    assert sstable.read_shards(manifest).count() == 0
    assert packing.pack(none, default_tokenizer()).count() == 0


def check_packing(rows, wanted):
    """Every id in one piece; sequences gapless, not over the capacity."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert sum(r.length for r in rows) == sum(len(x) for x in wanted)
    padded = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.CAPACITY
        padded += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    return padded


def test_packing(spark, docs):
    rows = packing.pack(docs.repartition(2), default_tokenizer()).collect()
    wanted = [[*library(r.text), 1] for r in docs.collect()]
    check_packing(rows, wanted)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for r in docs.collect():
        if r.doc_id not in (3, None):
            ids = [*library(r.text), 1]
            own = sorted(by_doc[r.doc_id], key=lambda p: p.start)
            assert [p.ids_crc32 for p in own] == [crc(ids[p.start : p.start + p.length]) for p in own]
            assert sum(p.length for p in own) == len(ids) == own[0].doc_tokens


def test_packing_pads_little(spark, sf_dir):
    rows = packing.pack(shared.table(spark, sf_dir, "documents"), default_tokenizer()).collect()
    padded = check_packing(rows, [[0] * r.length for r in rows])
    assert padded == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=150))
def test_classes_take_whole_documents(lengths):
    """Full bins of class k hold k whole rests and cut pieces of fillers; every id is placed once."""
    packer = packing.Packer(3, capacity=64)
    for doc, n in enumerate(lengths):
        packer.add(doc, np.arange(n, dtype=np.uint32))
    full = list(packer.rows)
    packer.finish()
    placed = {}
    for doc, start, length, _, total, _, _ in packer.rows:
        assert total == lengths[doc]
        placed.setdefault(doc, []).append((start, length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(placed[doc]):
            assert start == at
            at += length
        assert at == n
    sequences = {}
    for row in full:
        sequences.setdefault(row[5], []).append(row)
    assert all(sum(r[2] for r in own) == 64 for own in sequences.values())
    for own in sequences.values():
        first = own[0]
        rest = first[4] - first[1]
        if first[2] < 64:  # a bin of the class of its first rest
            k = 64 // rest
            assert [64 // (r[4] - r[1]) for r in own[:k]] == [k] * k and all(r[1] + r[2] == r[4] for r in own[:k])


def test_few_documents_are_cut(spark, sf_dir):
    rows = packing.pack(shared.table(spark, sf_dir, "documents").coalesce(1), default_tokenizer()).collect()
    short = [r for r in rows if r.doc_tokens < packing.CAPACITY]
    whole = sum(r.length == r.doc_tokens for r in short)
    assert whole >= 0.6 * len({r.doc_id for r in short})

def test_filter_bits_are_independent():
    size, keys = 1 << 14, [sstable.key_of(i) for i in range(1600)]
    bits = [sstable._filter_bits(k, size) for k in keys]
    assert len({b for own in bits for b in own}) > 0.45 * size  # as many as random bits fill
    held = {b for own in bits for b in own}
    false = sum(all(b in held for b in sstable._filter_bits(sstable.key_of(i), size)) for i in range(10_000, 20_000))
    assert false < 200


@pytest.mark.parametrize("name", ["op3_chat", "op5_embedding_dedup", "op8_bwt_dedup", "op9_ngram_join"])
def test_query_equals_its_sql(spark, sf_dir, name):
    import oracle

    from threshmill.llm.queries import ORACLE_SQL, QUERIES

    got, wanted, own, theirs = oracle.compare(spark, oracle.connect(sf_dir), QUERIES[name], ORACLE_SQL[name], sf_dir)
    assert own == theirs and got == wanted
