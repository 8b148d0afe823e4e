"""Sorted-string-table shards of token ids (operator 2).

A shard holds documents in ascending order of their key: data blocks of prefix-compressed keys and values, a Bloom
filter, a sparse index with the first key of each block, and a footer of fixed length. ``write_shards`` makes them
in one range shuffle; ``Shard.get`` finds a document by the filter, a binary search of the index and one block.

Layout of a shard (little-endian)::

    block*    zstd of records: varint shared, varint own, own key bytes, varint bytes, width u8, ids
    filter    bits
    index     per block: varint key length, first key, u64 offset, u32 length
    footer    u64 filter offset, u64 index offset, u64 documents, u64 ids, u32 blocks, u32 filter hashes, u32 crc of index, magic

Defined results: a null or empty text is a document of the end id alone; a null identifier has the smallest key;
rows with one identifier stand beside each other, ordered by their text's hash; other columns are ignored; of an
empty table there are no shards.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threshmill.llm import shared
from threshmill.llm.tokens import default_tokenizer, encoder, utf8

MAGIC = b"TMSST001"
FOOTER = struct.Struct("<QQQQIII8s")
BLOCK_TARGET = 256 << 10
#: Bytes of text in a shard, whose index and filter stay in proportion; with little text, there are as many shards as tasks.
SHARD_TEXT = 256 << 20
BITS_PER_KEY = 10
FILTER_HASHES = 7


def key_of(doc_id: int | None) -> bytes:
    """Bytes in the order of the identifiers, null first."""
    return b"\x00" if doc_id is None else b"\x01" + struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)


def id_of(key: bytes) -> int | None:
    return None if key == b"\x00" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _filter_bits(key: bytes, size: int) -> list[int]:
    """Double hashing from the two halves of a digest of the key."""
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    return [(a + i * b) % size for i in range(FILTER_HASHES)]


class ShardWriter:
    """Writes one shard in order; memory holds a block, the sparse index and the keys' hashes."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.block, self.block_first, self.last_key = bytearray(), None, b""
        self.index: list[tuple[bytes, int, int]] = []
        self.keys: list[bytes] = []
        self.documents = self.ids = 0
        self.pack = zstandard.ZstdCompressor(level=1).compress

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.documents and key < self.last_key:
            raise ValueError("keys must ascend")
        common = 0
        if self.block_first is None:
            self.block_first = key
        else:
            for x, y in zip(self.last_key, key):
                if x != y:
                    break
                common += 1
        width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
        value = ids.astype(f"<u{width}").tobytes()
        self.block += _varint(common) + _varint(len(key) - common) + key[common:] + _varint(len(value)) + bytes([width]) + value
        self.last_key = key
        self.keys.append(key)
        self.documents += 1
        self.ids += len(ids)
        if len(self.block) >= BLOCK_TARGET:
            self._flush()

    def _put(self, data: bytes) -> int:
        self.stream.write(data)
        self.at += len(data)
        return self.at - len(data)

    def _flush(self) -> None:
        if self.block_first is not None:
            data = self.pack(bytes(self.block))
            self.index.append((self.block_first, self._put(data), len(data)))
            self.block, self.block_first = bytearray(), None

    def close(self) -> None:
        self._flush()
        size = max(64, len(self.keys) * BITS_PER_KEY + 7 & ~7)
        bits = np.zeros(size, bool)
        for key in set(self.keys):
            bits[_filter_bits(key, size)] = True
        filter_at = self._put(np.packbits(bits).tobytes())
        index = b"".join(_varint(len(k)) + k + struct.pack("<QI", o, n) for k, o, n in self.index)
        index_at = self._put(index)
        self._put(FOOTER.pack(filter_at, index_at, self.documents, self.ids, len(self.index), FILTER_HASHES, zlib.crc32(index), MAGIC))


class Shard:
    """Reads one shard by random access; nothing but the footer, filter and index stays in memory."""

    def __init__(self, uri: str):
        system, path = shared.filesystem(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        footer = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        self.filter_at, index_at, self.documents, self.ids, blocks, self.hashes, crc, magic = footer
        index = self.file.read_at(size - FOOTER.size - index_at, index_at)
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError(f"{uri} is not a whole shard")
        self.filter = np.frombuffer(self.file.read_at(index_at - self.filter_at, self.filter_at), np.uint8)
        self.first_keys, self.places, at = [], [], 0
        for _ in range(blocks):
            n, at = _read_varint(index, at)
            self.first_keys.append(index[at : at + n])
            self.places.append(struct.unpack_from("<QI", index, at + n))
            at += n + 12
        self.unpack = zstandard.ZstdDecompressor().decompress

    def may_hold(self, key: bytes) -> bool:
        size = len(self.filter) * 8
        return all(self.filter[b >> 3] >> (7 - (b & 7)) & 1 for b in _filter_bits(key, size))

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        offset, length = self.places[i]
        data, at, key = self.unpack(self.file.read_at(length, offset)), 0, b""
        while at < len(data):
            common, at = _read_varint(data, at)
            own, at = _read_varint(data, at)
            key = key[:common] + data[at : at + own]
            at += own
            n, at = _read_varint(data, at)
            width = data[at]
            yield key, np.frombuffer(data, f"<u{width}", n // width, at + 1).astype("<u4")
            at += 1 + n

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.places)):
            yield from self.block(i)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """Ids of all documents with an identifier."""
        key, found = key_of(doc_id), []
        if not self.may_hold(key):
            return found
        i = max(0, bisect_right(self.first_keys, key) - 1)
        while i and self.first_keys[i] == key:  # copies of a key may begin in an earlier block
            i -= 1
        while i < len(self.places) and self.first_keys[i] <= key:
            found += [ids for k, ids in self.block(i) if k == key]
            i += 1
        return found

    def close(self) -> None:
        self.file.close()


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Encode texts, append ``end_id`` to each, and write shards in key order; returns the manifest, a row for each shard.

    One shuffle deals the documents by ranges of their identifier (and text hash, so that one identifier cannot fill
    a shard). A task writes its shard under a name of its own attempt and then renames it: a lost executor leaves no
    half shard, and a second attempt makes the same bytes.
    """
    spark = docs.sparkSession
    shared.small_batches(spark)
    size = 0 if shards else docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    parts = shards or max(shared.parallelism(spark), -(-size // SHARD_TEXT))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), shared.text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def write(batches):
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        system, path = shared.filesystem(folder)
        name, writer, sink, first = f"shard-{part:06d}.sst", None, None, b""
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            ids, edges = encode(*utf8(batch.column("text")))
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                if writer is None:
                    system.create_dir(path, recursive=True)
                    sink = system.open_output_stream(f"{path}/_{name}.{attempt}")
                    writer, first = ShardWriter(sink), key_of(doc)
                writer.add(key_of(doc), np.append(ids[edges[i] : edges[i + 1]], np.uint32(end_id)))
        if writer is not None:
            writer.close()
            sink.close()
            system.move(f"{path}/_{name}.{attempt}", f"{path}/{name}")
            yield pa.RecordBatch.from_pylist([{"shard": part, "path": f"{folder}/{name}", "n_docs": writer.documents, "n_tokens": writer.ids, "first_key": first, "last_key": writer.last_key}], schema=_MANIFEST)

    manifest = rows.mapInArrow(shared.frugal(write), "shard int, path string, n_docs long, n_tokens long, first_key binary, last_key binary")
    return shared.staged(spark, manifest, f"{folder}-manifest")


_MANIFEST = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_key", pa.binary()), ("last_key", pa.binary())])


def read_shards(manifest: DataFrame) -> DataFrame:
    """Each document of the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    parts = shared.parallelism(manifest.sparkSession)
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = manifest.select("shard", "path", before.alias("start")).repartition(parts, "shard")

    def read(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                shard, rows = Shard(path), []
                for key, ids in shard:
                    rows.append((id_of(key), start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                shard.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return placed.mapInArrow(shared.frugal(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, doc_id: int | None) -> list[np.ndarray]:
    """Token ids of the documents with an identifier, by the manifest's key ranges and the shards' filter and index."""
    key = key_of(doc_id)
    hits = manifest.filter((F.col("first_key") <= F.lit(key)) & (F.col("last_key") >= F.lit(key))).select("path").collect()
    return [ids for row in hits for ids in Shard(row.path).get(doc_id)]


def op2_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: token shards of all ``documents`` with end id 0, read back."""
    folder = shared.work_dir(spark, "sstable")
    return read_shards(write_shards(shared.table(spark, sf_dir, "documents"), folder, default_tokenizer(), end_id=0))
