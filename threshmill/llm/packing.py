"""Harmonic packing of documents into sequences (operator 10).

Lengths are partitioned into classes of reciprocals of the capacity C: class k has those above C/(k+1) up to C/k, and a
bin of class k holds exactly k of them. Each worker fills the bins of its own documents, so nothing is shuffled. A
document of C ids or more gives whole sequences first; what is left of it, its rest, goes whole to its class. A full bin
still has a gap of less than C/(k+1) ids and some; it is filled by fillers: rests of more classes than ``CLASSES``, and
whole documents that are set aside whenever fewer than C ids of fillers are in stock, which alone are cut. So a full bin
has no padding, and a worker holds a bin of each class and the stock. What stands in half-filled bins at the end of a
worker's documents is cut into whole sequences and at last into powers of two, which need no padding.

Defined results: a null or empty text has the end id alone; rows with one identifier are documents of their own;
other columns are ignored; of an empty table there are no pieces.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared
from threshmill.llm.tokens import default_tokenizer, encoder, utf8

CAPACITY = 2048
#: Reciprocal classes; smaller rests are fillers.
CLASSES = 64
_SCHEMA = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


class Packer:
    """One worker's bins. A piece is (doc_id, start, ids, doc_tokens); ``rows`` are those of filled sequences."""

    def __init__(self, worker: int, capacity: int = CAPACITY):
        self.capacity = capacity
        self.next_id = worker << 36
        self.bins: dict[int, list[tuple]] = {}
        self.fillers: deque[tuple] = deque()
        self.stock = 0
        self.rows: list[tuple] = []

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        at, total = 0, len(ids)
        while total - at >= self.capacity:
            self._sequence([(doc, at, ids[at : at + self.capacity], total)])
            at += self.capacity
        rest = total - at
        if not rest:
            return
        piece, k = (doc, at, ids[at:].copy(), total), self.capacity // rest
        if k > CLASSES or self.stock < self.capacity:
            self.fillers.append(piece)
            self.stock += rest
            return
        own = self.bins.setdefault(k, [])
        own.append(piece)
        if len(own) == k:
            self._sequence(own + self._fill(self.capacity - sum(len(p[2]) for p in own)))
            del self.bins[k]

    def _fill(self, gap: int) -> list[tuple]:
        """Pieces of fillers of ``gap`` ids together; there are as many in stock."""
        out = []
        self.stock -= gap
        while gap:
            doc, start, ids, total = self.fillers.popleft()
            out.append((doc, start, ids[:gap], total))
            if len(ids) > gap:
                self.fillers.appendleft((doc, start + gap, ids[gap:], total))
            gap -= len(out[-1][2])
        return out

    def finish(self) -> None:
        """Cut what is left over into whole sequences and powers of two."""
        left = [p for k in sorted(self.bins) for p in self.bins[k]] + [*self.fillers]
        self.bins, self.fillers, self.stock = {}, deque(), 0
        ids_left = sum(len(p[2]) for p in left)
        while left:
            room = min(self.capacity, 1 << ids_left.bit_length() - 1)
            ids_left -= room
            own = []
            while room:
                doc, start, ids, total = left.pop(0)
                own.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    left.insert(0, (doc, start + room, ids[room:], total))
                room -= len(own[-1][2])
            self._sequence(own)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place in a sequence; memory holds one batch and a bin of each class."""
    shared.small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), shared.text_or_empty(text_col).alias("text"))

    def run(batches):
        packer = Packer(TaskContext.get().partitionId(), capacity)
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            ids, edges = encode(*utf8(batch.column("text")))
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                packer.add(doc, np.append(ids[edges[i] : edges[i + 1]], np.uint32(end_id)))
            if packer.rows:
                yield _batch(packer.rows)
                packer.rows = []
        packer.finish()
        if packer.rows:
            yield _batch(packer.rows)

    return rows.mapInArrow(shared.frugal(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_SCHEMA)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all ``documents`` packed into sequences of 2048 with end id 1."""
    return pack(shared.table(spark, sf_dir, "documents"), default_tokenizer(), end_id=1)
