"""Alignment of two tokenizers over a corpus (operator 11).

A text is encoded by a byte-level BPE (A) and by a piece BPE with byte fallback (B). Both token sequences spell the
same bytes, so their cumulative token ends are two rising lists of byte offsets. A two-pointer merge of the lists finds
the offsets where tokens of both sides end together: they cut the tokens into groups, and the two tokens that end
there are linked. The merge runs in Arrow batches and emits a row for each document with its groups and its distinct
links with how often each occurs.

Spark then counts each pair of ids over the corpus, finds each B id's highest count, and joins both back to the
documents' links. Pairs that make up at least one ``HOT_PAIRS``-th of all links are ``HOT_PAIRS`` at most; they are
broadcast, and all others, none of which is a hot key, meet by a shuffle.

Defined results: a text that is null or empty, or that A or B does not spell byte by byte (as with the space sign of
B itself), has no tokens and zeros everywhere; strings of special tokens are plain text; rows with one identifier, and
rows without, are documents of their own; other columns are ignored; of an empty table there are no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared
from threshmill.llm.tokens import _byte_letters, default_tokenizer, encoder, utf8

#: Pairs that may be broadcast.
HOT_PAIRS = 1 << 17
#: Bytes of text, and documents, aligned at a time.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 1 << 14
SPACE = "▁"
#: A pair of ids in one number.
SHIFT = 24


class Spelling:
    """What bytes each id of one tokenizer stands for, and its decimal text with the sign that may follow it."""

    def __init__(self, entries: list[bytes], last: str):
        self.length = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(entries), np.uint8)
        self.within, self.last = (np.array([f"{i}{sign}".encode() for i in range(len(entries))], object) for sign in (",", last))

    def spell(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        to = np.cumsum(n)
        return self.pool[np.repeat(self.start[ids] - (to - n), n) + np.arange(int(to[-1]) if len(to) else 0)]


def byte_level_entries(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes by id of a byte-level vocabulary."""
    byte_of = {shown: bytes([b]) for b, shown in _byte_letters().items()}
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for entry, i in vocabulary.items():
        out[i] = b"".join(byte_of.get(c) or c.encode() for c in entry)
    return out


def piece_entries(pieces: list[str]) -> list[bytes]:
    """Bytes by id of pieces with the space sign and byte fallback."""
    escaped = (re.fullmatch(r"<0x([0-9A-F]{2})>", p) for p in pieces)
    return [bytes([int(m[1], 16)]) if m else p.replace(SPACE, " ").encode() for p, m in zip(pieces, escaped)]


class Aligner:
    """Both tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = encoder(path_a, specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.spelled_a = Spelling(byte_level_entries(self.a.tokenizer.get_vocab()), "|")
        self.spelled_b = Spelling(piece_entries([self.b.id_to_piece(i) for i in range(len(self.b))]), ";")

    def align(self, texts: list[str]) -> pd.DataFrame:
        """A row for each text: n_a, n_b, n_groups, groups_sha256, pairs, times."""
        column = pa.array(texts, pa.large_string())
        data, offsets = utf8(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string())))
        ids_a, edges_a = self.a.encode(data, offsets)
        lists = self.b.encode(texts, num_threads=1)
        n_b = np.fromiter(map(len, lists), np.int64, len(lists))
        ids_b = np.fromiter(chain.from_iterable(lists), np.int64, int(n_b.sum()))
        return merge(data, offsets, ids_a.astype(np.int64), np.diff(edges_a), ids_b, n_b, self.spelled_a, self.spelled_b)


def faithful(data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray, spelled: Spelling) -> np.ndarray:
    """Of each text, whether the bytes of its tokens are its own."""
    doc = np.repeat(np.arange(len(sizes)), counts)
    ok = np.bincount(doc, weights=spelled.length[ids], minlength=len(sizes)).astype(np.int64) == sizes
    own, theirs = data[np.repeat(ok, sizes)], spelled.spell(ids[ok[doc]])
    at = np.flatnonzero(own != theirs)
    ok[np.repeat(np.flatnonzero(ok), sizes[ok])[at]] = False
    return ok


def merge(data: np.ndarray, offsets: np.ndarray, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, spelled_a: Spelling, spelled_b: Spelling) -> pd.DataFrame:
    """Groups and links of texts that stand in one buffer; ids of all texts in a row, with how many each text has."""
    n_docs, sizes = len(n_a), np.diff(offsets)
    ok = (sizes > 1) & faithful(data, sizes, ids_a, n_a, spelled_a) & faithful(data, sizes, ids_b, n_b, spelled_b)
    ids_a, ids_b = ids_a[np.repeat(ok, n_a)], ids_b[np.repeat(ok, n_b)]
    n_a, n_b = n_a * ok, n_b * ok
    ends_a, ends_b = np.cumsum(spelled_a.length[ids_a]), np.cumsum(spelled_b.length[ids_b])
    # Two rising runs: a stable sort merges them with a pointer in each. Ends that are equal become neighbours.
    both = np.concatenate([ends_a, ends_b])
    order = np.argsort(both, kind="stable")
    both = both[order]
    together = np.flatnonzero(both[1:] == both[:-1])
    link_a, link_b = order[together], order[together + 1] - len(ends_a)
    closes_a, closes_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    closes_a[link_a] = closes_b[link_b] = True
    group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
    # Decimal ids in the order of groups, A before B in each.
    shown = np.empty(len(ids_a) + len(ids_b), object)
    before_b = np.concatenate([[0], link_b + 1])
    shown[np.arange(len(ids_a)) + before_b[group_a]] = np.where(closes_a, spelled_a.last[ids_a], spelled_a.within[ids_a])
    shown[np.arange(len(ids_b)) + (link_a + 1)[group_b]] = np.where(closes_b, spelled_b.last[ids_b], spelled_b.within[ids_b])
    edges = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    digests = [hashlib.sha256(b"".join(shown[s:e].tolist())[:-1]).hexdigest() if e > s else "" for s, e in zip(edges, edges[1:])]
    doc = np.repeat(np.arange(n_docs), n_a)[link_a]
    keys, times = np.unique((doc << (2 * SHIFT)) | (ids_a[link_a] << SHIFT) | ids_b[link_b], return_counts=True)
    cuts = np.searchsorted(keys >> (2 * SHIFT), np.arange(1, n_docs))
    pairs = np.split(keys & ((1 << (2 * SHIFT)) - 1), cuts)
    n_groups = np.bincount(doc, minlength=n_docs).astype(np.int64)
    return pd.DataFrame({"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_groups, "groups_sha256": digests, "pairs": pairs, "times": np.split(times.astype(np.int64), cuts)})


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's pair of tokenizers, kept from task to task."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and times of its distinct links."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), shared.text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = aligner(path_a, path_b)
        for batch in batches:
            texts, start = batch["text"].tolist(), 0
            heads = batch[["row", "doc_id"]].astype({"doc_id": "Int64"}).reset_index(drop=True)
            while start < len(texts):
                till, size = start, 0
                while till < len(texts) and till - start < BLOCK_DOCS and (size < BLOCK_BYTES or till == start):
                    size += len(texts[till])
                    till += 1
                found = both.align(texts[start:till])
                yield pd.concat([heads.iloc[start:till].reset_index(drop=True), found], axis=1)
                start = till

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    return rows.mapInPandas(shared.frugal(run), schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold the pair, and whether no other A id has more with its B id."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("n")).withColumn("b", F.col("pair").bitwiseAND((1 << SHIFT) - 1))
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    return counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def align_corpus(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): each document's counts, digest of groups, n_best and count_sum; and the corpus's table of (pair, n, best)."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    folder = shared.work_dir(spark, "alignment")
    rows = shared.staged(spark, aligned(docs, path_a, path_b, id_col, text_col), f"{folder}/rows")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    counts = shared.staged(spark, pair_counts(links), f"{folder}/counts")
    total, n_pairs = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # At most HOT_PAIRS pairs can have so large a share of the total each.
    hot = counts if n_pairs <= HOT_PAIRS else counts.filter(F.col("n") >= F.lit(total / HOT_PAIRS))
    weighed = links.join(F.broadcast(hot), "pair")
    if n_pairs > HOT_PAIRS:
        cold = links.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
        weighed = weighed.unionByName(cold.join(counts.filter(F.col("n") < F.lit(total / HOT_PAIRS)).hint("shuffle_hash"), "pair"))
    sums = weighed.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = rows.drop("pairs", "times").join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"), counts


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all ``documents`` aligned between a byte-level and a piece BPE."""
    return align_corpus(shared.table(spark, sf_dir, "documents"), default_tokenizer(), default_pieces())[0]
