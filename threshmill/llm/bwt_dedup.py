"""Repeated byte strings by merging shard Burrows-Wheeler transforms (operator 8).

Finds every byte that is covered by a string of ``length`` bytes which also starts elsewhere in the corpus.

1. Each start of such a window belongs to an anchor in the window: the gram (``gram_of(length)`` bytes) with the
   smallest hash. Equal windows have equal anchors at equal places, so only windows of one anchor need to be compared.
   The starts of an anchor form a run, whose bytes are its context. Contexts are dealt by anchor as packed rows of hashes.
2. An anchor that occurs once has no repeat. Contexts that are equal, copies of documents above all, are repeats in
   whole, and one of them stands for all. Only distinct contexts of one anchor go on, with their bytes.
3. Contexts are put in shards of ``SHARD_BYTES``, and shards in slots of ``SLOT_BYTES``, however many contexts there are.
   Each shard's suffixes are sorted once, by prefix doubling, and its transform, the byte before each suffix, is written
   to the shared folder. Tasks of their own read the transforms of a slot, regain from each the step to the suffix one
   byte longer (a stable sort of the bytes), and merge them by refining their interleave: the order by h bytes, sorted
   stably by the transforms' bytes and stepped back, is the order by h + 1 bytes. Where neighbours first differ is their
   common prefix; a suffix alone in its interval falls out. After ``length`` rounds the intervals left are those of the
   repeated strings. No suffix is sorted again, and no context is read again.
4. The runs of repeated starts meet their documents, and the covered bytes go.

An anchor with more than ``BLOCK`` distinct contexts is merged as pairs of blocks, so no task holds them all; a block's
transforms are made once and read by each of its pairs. Equal contexts are joined before any shuffle. Equality of
contexts in step 2 is that of two 64-bit hashes, of anchor and context, with length and place; a document is known by
128 bits; step 3 compares bytes.

Defined results: a null or empty text has no bytes and nothing removed; a text shorter than the length loses nothing;
repeated rows remove each other; a null identifier is one like any other; other columns are kept by
``remove_repeats`` and ignored by the query; of an empty table no rows come.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared
from threshmill.llm.shingles import Hasher, mix
from threshmill.llm.tokens import utf8

LENGTH = 400
#: The pipeline's stage removes passages of so many words, found by repeats of so many bytes, which few of them fall short of.
STAGE_LENGTH, STAGE_WORDS = 200, 51
#: Letters of scripts without spaces between words (Thai to Khmer, kana, Han), of which two count as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
#: Bytes of text hashed together; longer texts are taken in overlapping parts of so many.
PART = 1 << 19
#: Distinct contexts of an anchor merged at once, and those in a shard of theirs.
BLOCK, SHARD_CONTEXTS = 1024, 256
#: Bytes of contexts in a shard, and in a slot of shards that are merged together.
SHARD_BYTES, SLOT_BYTES = 1 << 17, 1 << 21
#: Rounds of a merge after which suffixes that are alone in their interval go.
DROP_EVERY = 4
_U = np.uint64


def gram_of(length: int) -> int:
    """Bytes of an anchor for windows of ``length``."""
    return max(1, min(128, length // 3))


# --- anchors


def anchor_runs(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Runs of window starts with one anchor: text (index), lo, hi (starts, both included), anchor and context hashes."""
    n = len(data)
    out = {k: np.zeros(0, t) for k, t in (("text", np.int64), ("lo", np.int64), ("hi", np.int64), ("anchor", _U), ("context", _U))}
    if n < length or not (np.diff(offsets) >= length).any():
        return out
    sums, gram = hasher.sums(data), gram_of(length)
    at = np.arange(n - gram + 1)
    grams = mix(hasher.between(sums, at, at + gram))
    # The smallest hash and, among equals, the rightmost place.
    least = (grams & _U(0xFFFFFFFF00000000)) | (_U(0xFFFFFFFF) - at.astype(_U))
    window = length - gram + 1
    size = 1
    while size * 2 <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if window > size:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    owner = (_U(0xFFFFFFFF) - (least & _U(0xFFFFFFFF))).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(owner)]
    valid = np.arange(len(owner)) + length <= offsets[1:][text]
    starts = np.flatnonzero(valid)
    owner, text = owner[starts], text[starts]
    first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])])
    lo = starts[first]
    hi = starts[np.append(np.flatnonzero(first)[1:] - 1, len(starts) - 1)]
    owner, text = owner[first], text[first]
    context = mix(hasher.between(sums, lo, hi + length) + mix((owner - lo).astype(_U) << _U(32) | (hi - lo).astype(_U)))
    return {"text": text, "lo": lo - offsets[text], "hi": hi - offsets[text], "anchor": grams[owner], "context": context}


def _parts(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in groups of about ``PART`` bytes, long ones in overlapping parts: (bytes, offsets, text index, shift)."""
    begin, end, text, shift, size = [], [], [], [], 0

    def group():
        own = np.concatenate([data[a:b] for a, b in zip(begin, end)])
        return own, np.concatenate([[0], np.cumsum(np.array(end) - begin)]), np.array(text), np.array(shift)

    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        for p in range(a, max(a + 1, b - length + 1), PART):
            q = min(b, p + PART + length - 1)
            begin.append(p), end.append(q), text.append(i), shift.append(p - a)
            size += q - p
            if size >= PART:
                yield group()
                begin, end, text, shift, size = [], [], [], [], 0
    if begin:
        yield group()


# --- transforms


def _ranks(key: np.ndarray) -> np.ndarray:
    """The dense ranks of keys."""
    order = np.argsort(key)
    own = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], own[1:] != own[:-1]]))
    return rank


def transform(contexts: list[bytes]) -> np.ndarray:
    """The bytes (plus one; 0 at a context's begin) before each sorted suffix of contexts that each have an end of their own."""
    sizes = np.array([len(c) + 1 for c in contexts], np.int64)
    ends = np.cumsum(sizes) - 1
    n = int(sizes.sum())
    symbols = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.int64) + 1  # 0 at ends, bytes from 1 on
    symbols[ends] = 0
    last = np.repeat(ends, sizes)
    # The first ranks are those of six symbols at once, then twice as many each time.
    place = np.arange(n)
    rank, step = np.zeros(n, np.int64), 6
    for j in range(6):
        rank = rank << 9 | np.where(place + j <= last, symbols[np.minimum(place + j, n - 1)] + 1, 0)
    rank = _ranks(rank)
    while step < sizes.max() and rank.max() < n - 1:
        ahead = place + step
        behind = np.where(ahead <= last, rank[np.minimum(ahead, n - 1)] + 1, 0)
        rank = _ranks(rank * (int(rank.max()) + 2) + behind)
        step *= 2
    order = np.argsort(rank * n + place)  # equal suffixes stand in the order of their contexts
    opens = np.zeros(n, bool)
    opens[ends - sizes + 1] = True
    before = np.where(opens[order], 0, symbols[order - 1])
    return before.astype(np.uint8 if symbols.max() < 256 else np.uint16)  # UTF-8 has no bytes above 0xF7


def steps_back(symbols: np.ndarray) -> np.ndarray:
    """Of each sorted suffix, the place of the suffix one byte longer; where a context begins, that of some end."""
    back = np.empty(len(symbols), np.int64)
    back[np.argsort(symbols, kind="stable")] = np.arange(len(symbols))
    return back


def repeated_starts(shards: list[tuple[np.ndarray, np.ndarray]], length: int = LENGTH) -> np.ndarray:
    """Which starts begin a string of ``length`` bytes that also begins elsewhere, from transforms and contexts' sizes.

    A context of n bytes has n - length + 1 starts; the flags of all contexts' starts come in one row, shard by shard.
    The starts are held as suffixes ``length`` bytes further on, in the interleaved order of the shards' transforms; each
    round sorts them stably by the transform's byte and steps back. ``group`` numbers the intervals with a common prefix
    of as many bytes as there were rounds.
    """
    shift = np.concatenate([[0], np.cumsum([len(symbols) for symbols, _ in shards])])
    kind = np.int32 if shift[-1] < 1 << 31 else np.int64
    symbols = np.concatenate([symbols for symbols, _ in shards])
    back = np.concatenate([steps_back(own) + shift[i] for i, (own, _) in enumerate(shards)]).astype(kind)
    sizes = np.concatenate([own for _, own in shards])
    # The last suffix of a shard's k-th context, its end alone, is the shard's k-th; a walk back from it meets the others.
    end = np.concatenate([np.arange(len(own)) + shift[i] for i, (_, own) in enumerate(shards)])
    starts = sizes - length + 1
    begin = np.concatenate([[0], np.cumsum(starts)])

    def walk(first: int, steps: int):
        at, live = end, np.arange(len(sizes))
        for step in range(steps):
            if step >= first:
                yield step, live, at
            stays = step < sizes[live]
            live, at = live[stays], back[at[stays]]

    current = []
    for step, which, at in walk(0, int(starts.max())):
        current.append(at[starts[which] > step])
    current = np.sort(np.concatenate(current)).astype(kind)
    group = np.zeros(len(current), kind)
    for h in range(1, length + 1):
        byte = symbols[current]
        order = np.argsort(byte, kind="stable")
        byte, group = byte[order], group[order]
        current = back[current[order]]
        fresh = np.empty(len(current), bool)
        fresh[:1] = True
        np.not_equal(group[1:], group[:-1], out=fresh[1:])
        fresh[1:] |= byte[1:] != byte[:-1]
        if h % DROP_EVERY == 0 or h == length:  # a suffix alone stays alone, so it need not go at once
            stays = ~fresh
            stays[:-1] |= ~fresh[1:]
            current, fresh = current[stays], fresh[stays]
            if not len(current):
                break
        group = np.cumsum(fresh, dtype=kind)
    out = np.zeros(int(begin[-1]), bool)
    if len(current):
        found = np.zeros(int(shift[-1]), bool)
        found[current] = True
        for step, which, at in walk(length, int(sizes.max()) + 1):  # the start ``step`` bytes before the end
            out[begin[which] + sizes[which] - step] = found[at]
    return out


# --- the distributed steps


#: Columns added to the documents' own, by names that those will not have.
KEY, KEY2, LOWS, HIGHS = "_repeat_key", "_repeat_key2", "_repeat_lows", "_repeat_highs"
_KEYS = ("row_key", "row_key2")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = shared.text_or_empty(text_col)
    return docs.withColumns({KEY: F.xxhash64(F.col(id_col), text), KEY2: F.xxhash64(F.lit(KEY2), text, F.col(id_col))})


_RUNS = "row_key long, row_key2 long, anchor long, lo int, hi int, kind int, number int, contexts int"


def _rows(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    types = {"row_key": np.int64, "row_key2": np.int64, "anchor": np.int64, "lo": np.int32, "hi": np.int32, "kind": np.int32, "number": np.int32, "contexts": np.int32}
    return pa.RecordBatch.from_arrays([pa.array(columns[k].astype(t) if columns[k].dtype != _U else columns[k].view(np.int64)) for k, t in types.items()], list(types))


REPEAT, COMPARE = 1, 2
_PACKED = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("row_key", "<i8"), ("row_key2", "<i8"), ("lo", "<u4"), ("hi", "<u4"), ("many", "<u1")])


def anchor_table(rows: DataFrame, buckets: int, length: int = LENGTH) -> DataFrame:
    """Runs that repeat in whole (kind REPEAT) and distinct contexts to compare (COMPARE, numbered within the anchor)."""
    spark = rows.sparkSession

    def deal(batches):
        # bucket -1 carries runs that repeat in whole already; the rest are packed by bucket.
        hasher = Hasher()
        for batch in batches:
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in _KEYS]
            packed = []
            for data, offsets, text, shift in _parts(*utf8(batch.column("text")), length):
                runs = anchor_runs(hasher, data, offsets, length)
                own = np.zeros(len(runs["lo"]), _PACKED)
                if len(own):
                    own["anchor"], own["context"] = runs["anchor"], runs["context"]
                    own["row_key"], own["row_key2"] = (k[text[runs["text"]]] for k in keys)
                    own["lo"], own["hi"] = runs["lo"] + shift[runs["text"]], runs["hi"] + shift[runs["text"]]
                    packed.append(own)
            if not packed:
                continue
            own = np.concatenate(packed)
            one, again = _joined(own)
            out = [(-1, again.tobytes())] if len(again) else []
            bucket = (mix(one["anchor"]) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            one, bucket = one[order], bucket[order]
            begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            out += [(int(bucket[a]), one[a:b].tobytes()) for a, b in zip(begin, np.append(begin[1:], len(one)))]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int64()), pa.array([r for _, r in out], pa.binary())], ["bucket", "runs"])

    def gather(batches):
        bucket, held = None, []
        for batch in batches:
            for b, runs in zip(batch.column("bucket").to_pylist(), batch.column("runs").to_pylist()):
                own = np.frombuffer(runs, _PACKED)
                if b == -1:
                    yield _whole(own)
                    continue
                if b != bucket and held:
                    yield from _compared(np.concatenate(held))
                    held = []
                bucket = b
                held.append(own)
        if held:
            yield from _compared(np.concatenate(held))

    dealt = rows.select(*_KEYS, "text").mapInArrow(shared.frugal(deal), "bucket long, runs binary")
    # Runs that repeat already have any bucket: they are spread evenly.
    spread = F.when(F.col("bucket") < 0, F.xxhash64("runs")).otherwise(F.col("bucket"))
    dealt = dealt.repartition(min(buckets, shared.parallelism(spark) * 4), spread).sortWithinPartitions("bucket")
    return dealt.mapInArrow(shared.frugal(gather), _RUNS)


def _joined(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One run of each context, marked if there are more, and all runs of contexts with more than one."""
    order = np.lexsort((own["lo"], own["row_key2"], own["row_key"], own["context"], own["anchor"]))
    own = own[order]
    first = np.concatenate([[True], (own["anchor"][1:] != own["anchor"][:-1]) | (own["context"][1:] != own["context"][:-1])])
    size = np.diff(np.append(np.flatnonzero(first), len(own)))
    many = np.repeat(size > 1, size)
    own = own.copy()
    own["many"] |= many.astype(np.uint8)
    marked = np.repeat(np.maximum.reduceat(own["many"], np.flatnonzero(first)), size)
    own["many"] = marked
    one = own[first]
    return one, own[many]


def _whole(own: np.ndarray) -> pa.RecordBatch:
    zero = np.zeros(len(own), np.int32)
    return _rows({"row_key": own["row_key"], "row_key2": own["row_key2"], "anchor": own["anchor"], "lo": own["lo"], "hi": own["hi"], "kind": zero + REPEAT, "number": zero, "contexts": zero})


def _compared(own: np.ndarray) -> Iterator[pa.RecordBatch]:
    one, again = _joined(own)
    if len(again):
        yield _whole(again)
    first = np.concatenate([[True], one["anchor"][1:] != one["anchor"][:-1]])
    size = np.diff(np.append(np.flatnonzero(first), len(one)))
    number = np.arange(len(one)) - np.repeat(np.flatnonzero(first), size)
    contexts = np.repeat(size, size)
    some = contexts > 1
    one = one[some]
    if len(one):
        yield _rows({"row_key": one["row_key"], "row_key2": one["row_key2"], "anchor": one["anchor"], "lo": one["lo"], "hi": one["hi"], "kind": np.full(len(one), COMPARE), "number": number[some], "contexts": contexts[some]})


_SHARDS = "slot long, shard int, blocks int, part int, symbols binary, contexts binary"
_PLACES = np.dtype([("row_key", "<i8"), ("row_key2", "<i8"), ("lo", "<i4"), ("hi", "<i4")])


def shard_transforms(runs: DataFrame, rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row for each shard of the contexts to compare: its transform and where its contexts stand.

    An anchor with more than ``BLOCK`` contexts is a slot of its own, whose parts are its blocks; the others share slots.
    """
    spark = rows.sparkSession
    wanted = runs.filter(F.col("kind") == COMPARE)
    size = wanted.agg(F.sum(F.col("hi") - F.col("lo") + length)).first()[0] or 0
    slots, per_slot = max(1, -(-size // SLOT_BYTES)), SLOT_BYTES // SHARD_BYTES
    per_block = BLOCK // SHARD_CONTEXTS
    blocks = F.ceil(F.col("contexts") / BLOCK).cast("int")
    hot = F.col("blocks") > 1
    shuffled = F.xxhash64("row_key", "lo")
    wanted = wanted.select(*_KEYS, "lo", "hi", "anchor", blocks.alias("blocks"), F.pmod("number", blocks).alias("part"), F.floor(F.col("number") / blocks).cast("int").alias("in_part"))
    slot = F.when(hot, F.xxhash64("anchor", F.lit("hot"))).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(slots)))
    shard = F.when(hot, F.col("part") * per_block + F.pmod("in_part", F.lit(per_block))).otherwise(F.pmod(shuffled, F.lit(per_slot)).cast("int"))
    wanted = wanted.select(*_KEYS, F.struct("anchor", "lo", "hi", slot.alias("slot"), shard.alias("shard"), "blocks", "part").alias("w"))
    wanted = wanted.groupBy(*_KEYS).agg(F.collect_list("w").alias("wanted"))  # no more than a text has anchors
    joined = rows.join(wanted.hint("shuffle_hash"), [*_KEYS]).select(*_KEYS, F.col("text").cast("binary").alias("bytes"), F.explode("wanted").alias("w"))
    cut = joined.select(*_KEYS, "w.*", F.substring("bytes", F.col("w.lo") + 1, F.col("w.hi") - F.col("w.lo") + length).alias("context"))
    cut = cut.dropDuplicates([*_KEYS, "anchor", "lo"]).drop("anchor")
    order = ["slot", "shard", "row_key", "row_key2", "lo"]
    cut = cut.repartition(shared.parallelism(spark) * 2, "slot", "shard").sortWithinPartitions(*order)

    def build(batches):
        pack = zstandard.ZstdCompressor(level=1).compress

        def shard_row(held):
            symbols = transform([h[4] for h in held])
            places = np.array([h[:4] for h in held], _PLACES)
            return pa.RecordBatch.from_pylist([{"slot": key[0], "shard": key[1], "blocks": key[2], "part": key[3], "symbols": pack(symbols.astype("<u2").tobytes() if symbols.itemsize == 2 else symbols.tobytes()), "contexts": places.tobytes()}], schema=schema)

        schema = pa.schema([("slot", pa.int64()), ("shard", pa.int32()), ("blocks", pa.int32()), ("part", pa.int32()), ("symbols", pa.binary()), ("contexts", pa.binary())])
        key, held, size = None, [], 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("slot", "shard", "blocks", "part", "row_key", "row_key2", "lo", "hi", "context"))):
                if held and (row[:4] != key or size > 2 * SHARD_BYTES):  # a full one is closed, and its rest is another
                    yield shard_row(held)
                    held, size = [], 0
                key = row[:4]
                held.append(row[4:])
                size += len(row[8])
        if held:
            yield shard_row(held)

    return cut.mapInArrow(shared.frugal(build), _SHARDS)


def compare(shards: DataFrame, length: int = LENGTH) -> DataFrame:
    """Repeated starts (row keys, lo, hi) among distinct contexts of one anchor, by merged transforms."""
    spark = shards.sparkSession
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = shards.select("*", other)
    x, y = F.least("part", "other"), F.greatest("part", "other")
    paired = paired.select("slot", F.when(F.col("blocks") > 1, x).otherwise(0).alias("x"), F.when(F.col("blocks") > 1, y).otherwise(0).alias("y"), "shard", "symbols", "contexts")
    paired = paired.repartition(shared.parallelism(spark) * 2, "slot", "x", "y").sortWithinPartitions("slot", "x", "y", "shard")

    def merge(batches):
        key, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("slot", "x", "y", "symbols", "contexts"))):
                if row[:3] != key and held:
                    yield _merged(held, length)
                    held = []
                key = row[:3]
                held.append(row[3:])
        if held:
            yield _merged(held, length)

    return paired.mapInArrow(shared.frugal(merge), "row_key long, row_key2 long, lo int, hi int")


def _merged(held: list[tuple[bytes, bytes]], length: int) -> pa.RecordBatch:
    unpack = zstandard.ZstdDecompressor().decompress
    shards, places = [], []
    for symbols, contexts in held:
        own = np.frombuffer(contexts, _PLACES)
        sizes = own["hi"].astype(np.int64) - own["lo"] + length
        raw = unpack(symbols)
        shards.append((np.frombuffer(raw, np.uint8 if len(raw) == int(sizes.sum()) + len(own) else "<u2"), sizes))
        places.append(own)
    found, places = repeated_starts(shards, length), np.concatenate(places)
    starts = places["hi"].astype(np.int64) - places["lo"] + 1
    which = np.repeat(np.arange(len(places)), starts)
    at = np.arange(len(found)) - np.repeat(np.cumsum(starts) - starts, starts) + places["lo"][which]
    hit = np.flatnonzero(found)
    first = np.ones(len(hit), bool)
    first[1:] = (np.diff(hit) > 1) | (np.diff(which[hit]) > 0)
    last = np.append(first[1:], True)[: len(hit)]
    own = places[which[hit[first]]]
    return pa.RecordBatch.from_arrays([pa.array(own["row_key"]), pa.array(own["row_key2"]), pa.array(at[hit[first]].astype(np.int32)), pa.array(at[hit[last]].astype(np.int32))], ["row_key", "row_key2", "lo", "hi"])


def _n_words(raw: bytes) -> int:
    """Words by white space; letters of scripts that set none are counted apart."""
    text, letters = raw.decode(errors="ignore"), 0
    if not text.isascii():
        text, letters = _UNSPACED.subn(" ", text)
    return len(text.split()) + letters // 2


def _kept(raw: bytes, lows: list[int], highs: list[int], length: int = LENGTH, least_words: int = 0) -> tuple[bytes, int, int]:
    """Bytes that no repeated string covers, and how many went in how many runs; runs of fewer words stay."""
    runs: list[list[int]] = []
    for lo, hi in sorted(zip(lows, highs)):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi + length)
        else:
            runs.append([lo, hi + length])
    if least_words:
        runs = [r for r in runs if _n_words(raw[r[0] : r[1]]) >= least_words]
    kept, at = [], 0
    for lo, end in runs:
        kept.append(raw[at:lo])
        at = end
    kept.append(raw[at:])
    left = b"".join(kept)
    return left, len(raw) - len(left), len(runs)


def repeat_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents with ``LOWS`` and ``HIGHS``: runs of starts of repeated strings of ``length``; null where there is none."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    folder = shared.work_dir(spark, "bwt-dedup")
    keyed = _keyed(docs, id_col, text_col)
    rows = keyed.select(F.col(KEY).alias("row_key"), F.col(KEY2).alias("row_key2"), shared.text_or_empty(text_col).alias("text"))
    n_rows = rows.count()
    runs = shared.staged(spark, anchor_table(rows, max(1, n_rows // 8_000), length), f"{folder}/runs")
    shards = shared.staged(spark, shard_transforms(runs, rows, length), f"{folder}/shards")
    found = shared.staged(spark, compare(shards, length), f"{folder}/found")
    shared.remove(spark, f"{folder}/shards")
    spans = runs.filter(F.col("kind") == REPEAT).select(*_KEYS, "lo", "hi").unionByName(found).distinct()
    # Both lists are collected in one aggregate, so they stand in one order.
    spans = spans.groupBy(F.col("row_key").alias(KEY), F.col("row_key2").alias(KEY2)).agg(F.collect_list("lo").alias(LOWS), F.collect_list("hi").alias(HIGHS))
    return keyed.join(spans.hint("shuffle_hash"), [KEY, KEY2], "left")


def op8_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: digests of all ``documents`` without their repeated strings."""
    marked = repeat_runs(shared.table(spark, sf_dir, "documents")).select(F.col("doc_id").cast("long").alias("doc_id"), shared.text_or_empty().alias("text"), F.col(LOWS).alias("lows"), F.col(HIGHS).alias("highs"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, lows, highs in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "lows", "highs"))):
                raw = text.encode()
                left, removed, spans = _kept(raw, lows or [], highs or [])
                rows.append((doc, len(raw), removed, spans, hashlib.sha256(left).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return marked.mapInArrow(shared.frugal(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, least_words: int = 0) -> DataFrame:
    """The documents with the covered bytes gone from their text; bytes that no longer form a character go too.

    With ``least_words``, only runs of covered bytes that hold or touch so many words go; of scripts without spaces, two
    letters are a word.
    """

    @F.pandas_udf("string")
    def cut(text, lows, highs):
        import pandas as pd

        whole = lambda x: [] if x is None else list(x)
        return pd.Series([t if lo is None else _kept(t.encode(), whole(lo), whole(hi), length, least_words)[0].decode(errors="ignore") for t, lo, hi in zip(text, lows, highs)])

    marked = repeat_runs(docs, id_col, text_col, length)
    text = F.when(F.col(LOWS).isNull(), F.col(text_col)).otherwise(cut(shared.text_or_empty(text_col), LOWS, HIGHS))
    return marked.withColumn(text_col, text).select(*docs.columns)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages of more than 50 words go; a document that had nothing else goes too.

    Passages are found as repeated strings of ``STAGE_LENGTH`` bytes and go if they have ``STAGE_WORDS`` words; n_chars
    follows the text.
    """
    had = docs.withColumn("_had_text", F.length(shared.text_or_empty()) > 0)
    left = remove_repeats(had, length=STAGE_LENGTH, least_words=STAGE_WORDS).filter(~F.col("_had_text") | (F.length(shared.text_or_empty()) > 0))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*docs.columns)
