"""N-gram Jaccard join by T-occurrence search (operator 9).

Links texts whose shingle sets have a Jaccard similarity of at least ``THRESHOLD`` percent, with no link lost:

1. Every text's set is hashed; texts with equal sets form one class with one representative.
2. Two linked sets share one of the first fifth of their shingles in any fixed order. The order is by hash, with the
   shingles that are frequent in a bounded sample last, so a passage that many texts share does not gather them. The
   first fifths are dealt by shingle as packed blobs, and each shingle with two holders or more gives a list of holders.
3. Holders carry a parity bitmap of their set. Bits that differ bound the sets' difference from below, so pairs that
   cannot link are cut off; the lists leave spanning edges of what may link, whose components are small clusters.
4. In each cluster an exact T-occurrence search runs. DivideSkip sets a text's long inverted lists aside, heap-merges the
   short ones and probes the long ones by binary search; what reaches the required overlap is linked. A text first asks
   the lists of the texts that opened the components so far, and only texts outside the largest component ask all.

A shingle with more than ``HOLDER_BLOCK`` holders or a cluster of more than ``BLOCK`` texts is dealt as pairs of blocks,
so that any task is bounded.

No pair is listed within a group, nothing but the frequent shingles of the bounded sample is broadcast, and results
of each step are written to the shared folder.

Defined results: a null, empty or wordless text has an empty set and links with nothing, not even its like; copies
of a row are texts of their own; a null identifier is kept and never names a component; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared
from threshmill.llm.graph import components
from threshmill.llm.shingles import Hasher, mix
from threshmill.llm.tokens import utf8

WORDS = 5
THRESHOLD = 80
#: Texts and shingles of a cluster, and holders of a shingle, in a block; larger groups are dealt as pairs of blocks.
BLOCK, BLOCK_SHINGLES, HOLDER_BLOCK = 1024, 1 << 20, 256
#: Texts whose lists are asked at a time for links across components.
ASKED = 64
#: Texts in the sample that tells which shingles are frequent, from how many of them on one is, and how many are sent out.
SAMPLE_TEXTS, FREQUENT, FREQUENT_SENT = 2_000, 4, 1 << 16
#: Column of the pipeline stage that numbers the rows.
ROW = "_ngram_row"
_U = np.uint64


def prefix_length(n: int, percent: int = THRESHOLD) -> int:
    """Shingles of which a linked set must share one: n - ceil(t n) + 1."""
    return n - -(-percent * n // 100) + 1


def linked(shared_count: int, n: int, m: int, percent: int = THRESHOLD) -> bool:
    return 100 * shared_count >= percent * (n + m - shared_count)


# --- bitmaps


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the hashes that fall on each of a power of two of bits, at least as many as hashes."""
    bits = max(64, 1 << max(0, int(len(hashes) * 2 - 1)).bit_length())
    parity = np.bincount((hashes >> _U(11)).astype(np.int64) & bits - 1, minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def fold(maps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps as rows of ``size`` bytes; halves of longer ones are added without carry, which keeps parity."""
    out = np.zeros((len(maps), size // 8), np.uint64)
    for i, m in enumerate(maps):
        row = np.frombuffer(m, np.uint64)
        while len(row) > size // 8:
            row = row[: len(row) // 2] ^ row[len(row) // 2 :]
        out[i] = row
    return out


def may_link(maps: np.ndarray, sizes: np.ndarray, one_map: np.ndarray, one_size: int, percent: int = THRESHOLD) -> np.ndarray:
    """Whether sets can link with one set: shared <= (n + m - differing bits) / 2."""
    differing = np.bitwise_count(maps ^ one_map).sum(1, dtype=np.int64)
    most = np.minimum((sizes + one_size - differing) // 2, np.minimum(sizes, one_size))
    return 100 * most >= percent * (sizes + one_size - most)


class Union:
    """Union-find over 0..n-1 whose roots are the smallest members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def candidates(maps: list[bytes], sizes: np.ndarray) -> list[tuple[int, int]]:
    """Spanning edges of the pairs that may link. A text is compared with all of another component or none."""
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    maps = [maps[i] for i in order]
    union = Union(len(maps))
    folded: dict[int, np.ndarray] = {}
    for j in range(1, len(maps)):
        width = len(maps[j])
        low = int(np.searchsorted(sizes, -(-THRESHOLD * int(sizes[j]) // 100)))
        lows = [len(maps[low]), width] if low < j else [width]
        size = min(lows)
        if size not in folded:
            folded[size] = fold([m if len(m) >= size else b"\0" * size for m in maps], size)
        own = folded[size]
        hits = np.flatnonzero(may_link(own[low:j], sizes[low:j], own[j], int(sizes[j]))) + low
        for i in hits.tolist():
            if union.up[i] == i or union.root(i) != union.root(j):
                union.join(i, j)
    return [(int(order[i]), int(order[union.root(i)])) for i in range(len(maps)) if union.root(i) != i]


# --- T-occurrence


def heap_merge(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of ascending lists, ascending, and how many lists hold each."""
    found, count, last = [], [], -1
    for i in heapq.merge(*lists):
        if i == last:
            count[-1] += 1
        else:
            found.append(i)
            count.append(1)
            last = i
    return np.array(found, np.int64), np.array(count, np.int64)


def probe(ids: np.ndarray, begin: np.ndarray, size: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of each wanted id, how many of the lists ids[begin:begin+size] hold it, by binary search in all of them at once."""
    low = np.broadcast_to(begin, (len(wanted), len(begin)))
    high = low + size
    end, own = high, wanted[:, None]
    for _ in range(int(size.max()).bit_length()):
        middle = low + high >> 1
        less = ids[np.minimum(middle, end - 1)] < own
        low, high = np.where(less & (low < high), middle + 1, low), np.where(less, high, middle)
    return ((low < end) & (ids[np.minimum(low, end - 1)] == own)).sum(1)


def divide_skip(ids: np.ndarray, begin: np.ndarray, size: np.ndarray, need: int, wanted=None) -> tuple[np.ndarray, np.ndarray]:
    """Ids that at least ``need`` of the ascending lists ids[begin:begin+size] hold, none empty, and how many do.

    The longest lists, one fewer than needed, are set aside: an id that is wanted stands in another. The short ones are
    merged by a heap, and the long ones probed by binary search for what can still reach the need. ``wanted`` tells of an
    array of ids which are worth probing.
    """
    order = np.argsort(-size, kind="stable")
    long, short = order[: need - 1], order[need - 1 :]
    found, count = heap_merge([ids[b : b + n].tolist() for b, n in zip(begin[short].tolist(), size[short].tolist())])
    live = count >= need - len(long)
    if wanted is not None and live.any():
        live &= wanted(found)
    found, count = found[live], count[live]
    if len(long) and len(found):
        count = count + probe(ids, begin[long], size[long], found)
        found, count = found[count >= need], count[count >= need]
    return found, count


class InvertedLists:
    """Lists of the sets that hold a token, for tokens that two or more sets hold; filled set by set, in place."""

    def __init__(self, sets: list[np.ndarray]):
        edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        tokens, index, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.sets = [own[holders[own] > 1] for own in (index[a:b].astype(np.int32) for a, b in zip(edges[:-1], edges[1:]))]
        self.begin = np.concatenate([[0], np.cumsum(np.where(holders > 1, holders, 0))])
        self.size = np.zeros(len(tokens), np.int64)
        self.ids = np.zeros(int(self.begin[-1]), np.int32)

    def add(self, i: int) -> None:
        """Sets are added in ascending order, so lists ascend."""
        own = self.sets[i]
        self.ids[self.begin[own] + self.size[own]] = i
        self.size[own] += 1

    def clear(self) -> None:
        self.size[:] = 0

    def ask(self, i: int, need: int, wanted) -> tuple[np.ndarray, np.ndarray]:
        """Sets added that hold at least ``need`` tokens of a set, and how many."""
        own = self.sets[i]
        own = own[self.size[own] > 0]
        if len(own) < need:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return divide_skip(self.ids, self.begin[own], self.size[own], need, wanted)


def search(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning links of the sets, by T-occurrence search.

    First each set in turn asks the lists of the openers, that is of sets before it that linked to no opener or to
    several; what links to one joins it. Then each set outside the largest component asks the lists of all
    sets, ``ASKED`` of them at a time, for links across components, and is done with what it has joined.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    union, edges = Union(n), []
    lists = InvertedLists(sets)

    def ask(q: int, across: bool) -> None:
        def wanted(ids: np.ndarray) -> np.ndarray:
            fits = (ids != q) & (100 * np.minimum(sizes[ids], sizes[q]) >= THRESHOLD * np.maximum(sizes[ids], sizes[q]))
            if across and fits.any():
                own = union.root(q)
                fits &= np.array([union.root(i) != own for i in ids.tolist()])
            return fits

        need = max(1, -(-THRESHOLD * int(sizes[q]) // 100))
        for i, count in zip(*(x.tolist() for x in lists.ask(q, need, wanted))):
            if union.root(i) != union.root(q) and linked(count, int(sizes[i]), int(sizes[q])):
                union.join(i, q)
                edges.append((i, q))

    openers: list[int] = []
    for q in range(n):
        before = len(edges)
        ask(q, False)
        if len(edges) - before != 1:  # it opens a component, or joins several and speaks for them from now on
            openers.append(q)
            lists.add(q)
            one_each = {union.root(i): i for i in openers}
            if len(openers) > 2 * len(one_each):
                openers = sorted(one_each.values())
                lists.clear()
                for i in openers:
                    lists.add(i)
    roots = np.array([union.root(i) for i in range(n)])
    largest = int(np.bincount(roots).argmax())
    queries = np.flatnonzero(roots != largest).tolist()
    for a in range(0, n if queries else 0, ASKED):
        lists.clear()
        for i in range(a, min(n, a + ASKED)):
            lists.add(i)
        there = {union.root(i) for i in range(a, min(n, a + ASKED))}
        for q in queries:
            # What has joined the largest component is asked for by the sets of other components.
            if union.root(q) != union.root(largest) and there != {union.root(q)}:
                ask(q, True)
    return edges


# --- the distributed steps


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), shared.text_or_empty(text_col).alias("text"))


def frequent_shingles(rows: DataFrame, n_rows: int) -> np.ndarray:
    """The most frequent shingles that at least ``FREQUENT`` of about ``SAMPLE_TEXTS`` sampled texts hold, ``FREQUENT_SENT`` at most.

    They only order a set's prefix: one that is left out costs time and loses no link.
    """
    share = min(1.0, SAMPLE_TEXTS / max(1, n_rows))
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            hashes, _ = hasher.sets(*utf8(batch.column("text")), WORDS)
            kinds, counts = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "n"])

    counted = sample.mapInArrow(shared.frugal(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
    found = np.array([r.h for r in counted.orderBy(F.desc("n"), "h").limit(FREQUENT_SENT).select("h").collect()], np.int64).view(np.uint64)
    return np.sort(found)


def signed_sets(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Of each text: doc_id, n, a 128-bit key of its set, its bitmap and its prefix."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            hashes, edges = hasher.sets(*utf8(batch.column("text")), WORDS)
            late = np.zeros(len(hashes), bool)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
                late = frequent[at] == hashes
            n = np.diff(edges)
            sums = [np.concatenate([np.zeros(1, _U), np.cumsum(mix(hashes ^ _U(seed)))]) for seed in (0x1234567, 0x89ABCDEF01)]
            keys = [(s[edges[1:]] - s[edges[:-1]]).view(np.int64) for s in sums]
            maps, prefixes = [], []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                own = hashes[a:b]
                maps.append(bitmap(own))
                k = prefix_length(b - a) if b > a else 0
                rare = own[~late[a:b]][:k] if late[a:b].any() else own[:k]
                prefixes.append((rare if len(rare) >= k else np.concatenate([rare, own[late[a:b]][: k - len(rare)]])).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(keys[0]), pa.array(keys[1]), pa.array(maps, pa.binary()), pa.array(prefixes, pa.binary())], ["doc_id", "n", "k1", "k2", "bitmap", "prefix"])

    return rows.mapInArrow(shared.frugal(run), "doc_id long, n long, k1 long, k2 long, bitmap binary, prefix binary")


def holder_lists(signed: DataFrame, buckets: int) -> DataFrame:
    """Lists of the texts that hold a prefix shingle, equal lists once: (list key, ids)."""
    spark = signed.sparkSession

    def deal(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            own = [np.frombuffer(p, np.uint64) for p in batch.column("prefix").to_pylist()]
            if not own:
                continue
            tokens, owner = np.concatenate(own), np.repeat(ids, [len(o) for o in own])
            bucket = (mix(tokens) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            tokens, owner, bucket = tokens[order], owner[order], bucket[order]
            begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
            edges = [*begin, len(bucket)]
            rows = [(int(bucket[a]), tokens[a:b].tobytes(), owner[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["bucket", "tokens", "owners"])

    def gather(batches):
        # Rows come sorted by bucket; one bucket's shingles, bounded by the number of buckets, are in memory.
        bucket, tokens, owners = None, [], []
        for batch in batches:
            for b, t, o in zip(*(batch.column(n).to_pylist() for n in ("bucket", "tokens", "owners"))):
                if b != bucket and tokens:
                    yield from _lists(tokens, owners)
                    tokens, owners = [], []
                bucket = b
                tokens.append(t)
                owners.append(o)
        if tokens:
            yield from _lists(tokens, owners)

    dealt = signed.select("doc_id", "prefix").mapInArrow(shared.frugal(deal), "bucket long, tokens binary, owners binary")
    dealt = dealt.repartition(min(buckets, shared.parallelism(spark) * 4), "bucket").sortWithinPartitions("bucket")
    lists = dealt.mapInArrow(shared.frugal(gather), "k1 long, k2 long, ids array<long>")
    return lists.groupBy("k1", "k2").agg(F.first("ids").alias("ids"))


def _lists(tokens: list[bytes], owners: list[bytes]) -> Iterator[pa.RecordBatch]:
    t, o = np.frombuffer(b"".join(tokens), np.uint64), np.frombuffer(b"".join(owners), np.int64)
    order = np.lexsort((o, t))
    t, o = t[order], o[order]
    begin = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    end = np.append(begin[1:], len(t))
    many = end - begin > 1
    begin, end = begin[many], end[many]
    if not len(begin):
        return
    sums = [np.concatenate([np.zeros(1, _U), np.cumsum(mix(o.view(np.uint64) * _U(2) + _U(seed)))]) for seed in (1, 0xABCDEF12345)]
    keys = np.stack([s[end] - s[begin] for s in sums], 1)
    _, first = np.unique(keys, axis=0, return_index=True)
    for part in np.array_split(first, max(1, len(first) // 20_000)):
        rows = [o[begin[i] : end[i]] for i in part.tolist()]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))
        yield pa.RecordBatch.from_arrays([pa.array(keys[part, 0].view(np.int64)), pa.array(keys[part, 1].view(np.int64)), ids], ["k1", "k2", "ids"])


def _groups(batches, keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, list[list]]]:
    """Runs of rows with equal keys in sorted batches."""
    key, own = None, [[] for _ in columns]
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in keys), *(batch.column(c).to_pylist() for c in columns)):
            if row[: len(keys)] != key:
                if own[0]:
                    yield key, own
                key, own = row[: len(keys)], [[] for _ in columns]
            for values, x in zip(own, row[len(keys) :]):
                values.append(x)
    if own[0]:
        yield key, own


def _edges(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.int64())], ["a", "b"])


def _paired(blocks: Column, part: Column) -> Column:
    """The pairs of blocks (x, y) to which a row of a part goes: each with another, or its own where there is one."""
    other = F.filter(F.sequence(F.lit(0), blocks - 1), lambda o: (o != part) | (blocks == 1))
    return F.transform(other, lambda o: F.struct(F.least(o, part).alias("x"), F.greatest(o, part).alias("y")))


def candidate_edges(lists: DataFrame, signed: DataFrame) -> DataFrame:
    """Spanning edges, within each list of holders, of the pairs that the bitmaps let link; long lists by pairs of blocks."""
    spark = lists.sparkSession
    blocks = F.ceil(F.size("ids") / HOLDER_BLOCK).cast("int")
    held = lists.select("k1", "k2", blocks.alias("blocks"), F.posexplode("ids").alias("place", "doc_id")).join(signed.select("doc_id", "n", "bitmap"), "doc_id")
    held = held.select("k1", "k2", "doc_id", "n", "bitmap", F.explode(_paired(F.col("blocks"), F.pmod("place", "blocks"))).alias("at"))
    held = held.select("k1", "k2", "at.x", "at.y", "doc_id", "n", "bitmap").repartition(shared.parallelism(spark) * 2, "k1", "k2", "x", "y").sortWithinPartitions("k1", "k2", "x", "y", "doc_id")

    def run(batches):
        out = []
        for _, (ids, sizes, maps) in _groups(batches, ["k1", "k2", "x", "y"], ["doc_id", "n", "bitmap"]):
            out += [(ids[i], ids[j]) for i, j in candidates(maps, np.array(sizes, np.int64))]
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return held.mapInArrow(shared.frugal(run), "a long, b long")


def exact_edges(clusters: DataFrame, rows: DataFrame) -> DataFrame:
    """Spanning links within clusters (doc_id, n, cluster), by T-occurrence search on the whole sets."""
    spark = rows.sparkSession
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    part = F.pmod(F.xxhash64("doc_id"), F.col("blocks").cast("long")).cast("int")
    placed = clusters.join(sizes, "cluster").select("doc_id", "cluster", F.explode(_paired(F.col("blocks"), part)).alias("at"))
    placed = placed.groupBy("doc_id").agg(F.collect_list(F.struct("cluster", "at.x", "at.y")).alias("at"))  # a cluster's pairs of one block
    # Whatever the size, the clusters' rows are the side that is built, so the plan is the same at every scale.
    placed = rows.join(placed.hint("shuffle_hash"), "doc_id").select("doc_id", "text", F.explode("at").alias("at"))
    placed = placed.select("at.cluster", "at.x", "at.y", "doc_id", "text")
    placed = placed.repartition(shared.parallelism(spark) * 2, "cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "doc_id")

    def run(batches):
        hasher = Hasher()
        out = []

        def hashed():
            for batch in batches:
                hashes, edges = hasher.sets(*utf8(batch.column("text")), WORDS)
                sets = [hashes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("cluster", "x", "y", "doc_id")), pa.array(sets, pa.binary())], ["cluster", "x", "y", "doc_id", "set"])

        for _, (ids, sets) in _groups(hashed(), ["cluster", "x", "y"], ["doc_id", "set"]):
            order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
            out += [(ids[order[i]], ids[order[j]]) for i, j in search([np.frombuffer(sets[i], np.uint64) for i in order])]
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return placed.mapInArrow(shared.frugal(run), "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row of the input as doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    folder = shared.work_dir(spark, "ngram-join")
    rows = _docs(docs, id_col, text_col)
    n_rows = rows.count()
    frequent = frequent_shingles(rows, n_rows)
    signed = shared.staged(spark, signed_sets(rows, frequent), f"{folder}/signed")
    members = signed.select("doc_id", "n", "k1", "k2")
    classes = members.filter("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    classes = shared.staged(spark, classes, f"{folder}/classes")
    chosen = signed.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    buckets = max(1, n_rows // 8_000)
    lists = shared.staged(spark, holder_lists(chosen, buckets), f"{folder}/lists")
    coarse = components(spark, candidate_edges(lists, chosen.select("doc_id", "n", "bitmap")))
    shared.remove(spark, f"{folder}/lists")
    clusters = chosen.select("doc_id", "n").join(coarse.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")), "doc_id")
    links = shared.staged(spark, exact_edges(clusters, rows), f"{folder}/links")
    joined = components(spark, links)
    placed = classes.join(joined, classes["rep"] == joined["node"], "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    keys = [members[k] == placed[k] for k in ("k1", "k2")]
    out = members.join(placed, [*keys, members["n"] > 0], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: Jaccard components of all ``documents``."""
    return jaccard_components(shared.table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row stays, one with the smallest identifier.

    Rows are told apart by a number of their own, written with them, so that copies of a row and rows without an
    identifier are members like any other.
    """
    numbered = docs.withColumn(ROW, F.monotonically_increasing_id())
    numbered = shared.staged(spark, numbered, f"{shared.work_dir(spark, 'ngram-rows')}/rows")
    parts = jaccard_components(numbered, ROW).select(F.col("doc_id").alias(ROW), "component_id")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW))
    kept = numbered.select(ROW, "doc_id").join(parts, ROW).groupBy("component_id").agg(least.alias("least")).select(f"least.{ROW}")
    return numbered.join(kept, ROW, "left_semi").select(*docs.columns)
