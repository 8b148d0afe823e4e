"""Token ids of the ``tokenizers`` library for whole batches of texts.

A byte-level BPE splits a text into pre-tokens and merges within each, and no pre-token holds a space but as its
first character or among white space. So a text cut before every space that stands alone between two characters
which are not white space falls into chunks whose ids do not depend on their neighbours; so it does if also cut
between a letter and a full stop, comma or line break, and between a single line break and a letter. Words repeat, so a batch
is encoded by its distinct chunks: their 64-bit hashes are sorted and looked up among those that the worker has
met; a new chunk goes to the library, and its ids are kept. All ids come from the library. Texts with other white
space beside a space, and tokenizer files of another kind, go to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

#: Characters for which ``re`` and the library's pre-tokenizer are known to agree on letters, digits and spaces.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-©«-±´¶-¸»¿-ɏ‐-‧‰-⁞€]*")
#: The pre-token pattern of byte-level BPE (a fixed value), with letters and digits as ``re`` spells them.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Entries that a worker keeps of each kind; beyond it, texts cost more time but give the same ids.
PIECES_KEPT, CHUNKS_KEPT = 200_000, 800_000
#: Bytes of text encoded together.
BLOCK_BYTES = 1 << 20
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_STOP = np.isin(np.arange(256), list(b".,;:!?\n"))
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level BPE vocabularies: printable Latin-1 as it is, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class BatchEncoder:
    """One tokenizer file; ``encode`` takes texts as UTF-8 in one buffer with offsets.

    Without ``specials`` the strings of special tokens in a text are plain text.
    """

    def __init__(self, tokenizer_path: str, specials: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = not specials
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.added = [t["content"].encode() for t in spec.get("added_tokens", []) if specials or not t["special"]]
        self.cacheable = (
            spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
            and spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and not any(re.search(rb"\s", t) for t in self.added)
        )
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        self.known = np.zeros(0, np.uint64)  # sorted hashes of chunks
        self.start = np.zeros(0, np.int64)  # of their ids in the pool
        self.length = np.zeros(0, np.int32)
        self.unsafe = np.zeros(0, np.int8)  # 1: never to stand alone; 2: not before a space
        self.pool = np.zeros(1 << 20, np.uint32)
        self.pooled = 0
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def whole(self, text: str) -> bytes:
        """The library's own call."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            shown = piece.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(self.pieces) < PIECES_KEPT:
                self.pieces[piece] = ids
        return ids

    def _some(self, raw: bytes) -> bytes:
        text = raw.decode()
        if any(t in raw for t in self.added) or not _PLAIN.fullmatch(text):
            return self.whole(text)
        return b"".join(map(self._piece, _PIECES.findall(text)))

    def _grow_powers(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers = np.full(n, _BASE, np.uint64)
            self.inverse = np.full(n, _BASE_INVERSE, np.uint64)
            self.powers[0] = self.inverse[0] = 1
            np.cumprod(self.powers, out=self.powers)
            np.cumprod(self.inverse, out=self.inverse)

    def _learn(self, hashes: np.ndarray, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of new chunks into the pool; (start, length, unsafe) of each."""
        ids = [self._some(r) for r in raws]
        length = np.fromiter((len(i) >> 2 for i in ids), np.int32, len(ids))
        new = np.frombuffer(b"".join(ids), np.uint32)
        if self.pooled + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.pooled], np.zeros(max(len(new), self.pooled // 2), np.uint32)])
        self.pool[self.pooled : self.pooled + len(new)] = new
        start = self.pooled + np.cumsum(length, dtype=np.int64) - length
        self.pooled += len(new)
        unsafe = np.fromiter((self._unsafe(r) for r in raws), np.int8, len(raws))
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.start = np.insert(self.start, at, start)
        self.length = np.insert(self.length, at, length)
        self.unsafe = np.insert(self.unsafe, at, unsafe)
        return start, length, unsafe

    @staticmethod
    def _unsafe(raw: bytes) -> int:
        text = raw.decode()
        if text[0] == " " and (len(text) == 1 or text[1].isspace()):
            return 1
        return 2 if text[-1].isspace() else 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin and end (one offset more than texts)."""
        sizes = np.diff(offsets)
        out, counts = [], []
        i = 0
        while i < len(sizes):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, "right")) - 1)
            ids, n = self._block(data[offsets[i] : offsets[j]], (offsets[i : j + 1] - offsets[i]).astype(np.int64))
            out.append(ids)
            counts.append(n)
            i = j
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), np.concatenate([[0], np.cumsum(n)])

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n_docs = len(offsets) - 1
        if not self.cacheable:
            ids = [self.whole(data[a:b].tobytes().decode()) for a, b in zip(offsets[:-1], offsets[1:])]
            return np.frombuffer(b"".join(ids), np.uint32), np.fromiter((len(x) >> 2 for x in ids), np.int64, n_docs)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_docs, np.int64)
        self._grow_powers(len(data) + 1)
        opens = data == 32
        letter = _LETTER[data]
        opens[1:] |= letter[:-1] & _STOP[data[1:]]
        opens[2:] |= (data[1:-1] == 10) & letter[2:] & ~_SPACE[data[:-2]] & (data[:-2] < 128)
        opens[offsets[:-1][offsets[:-1] < len(data)]] = True
        begin = np.flatnonzero(opens)
        end = np.append(begin[1:], len(data))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)])])
        hashes = (sums[end] - sums[begin]) * self.inverse[begin]
        hashes ^= hashes >> np.uint64(29)
        order = np.argsort(hashes)
        ranked = hashes[order]
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        kinds = ranked[first]
        kind = np.empty(len(hashes), np.int64)
        kind[order] = np.cumsum(first) - 1
        at = np.minimum(np.searchsorted(self.known, kinds), max(0, len(self.known) - 1))
        new = self.known[at] != kinds if len(self.known) else np.ones(len(kinds), bool)
        if len(self.known) + int(new.sum()) > CHUNKS_KEPT:  # begin anew: frequent chunks come back at once
            self.known, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.length, self.unsafe, self.pooled = np.zeros(0, np.int32), np.zeros(0, np.int8), 0
            new = np.ones(len(kinds), bool)
        if new.any():
            places = order[first][new]
            raw = data.tobytes()
            self._learn(kinds[new], [raw[a:b] for a, b in zip(begin[places].tolist(), end[places].tolist())])
        at = np.searchsorted(self.known, kinds)
        start, length, unsafe = self.start[at][kind], self.length[at][kind].astype(np.int64), self.unsafe[at][kind]
        doc = np.searchsorted(offsets[1:], begin, "right")
        last = np.append(doc[1:] != doc[:-1], True)
        spaced = np.append(data[begin[1:]] == 32, False)
        odd = np.unique(doc[(unsafe == 1) | (unsafe == 2) & ~last & spaced])
        counts = np.bincount(doc, weights=length, minlength=n_docs).astype(np.int64)
        if len(odd):
            length[np.isin(doc, odd)] = 0
        to = np.cumsum(length)
        ids = self.pool[np.repeat(start - (to - length), length) + np.arange(int(to[-1]) if len(to) else 0)]
        if len(odd):
            raw = data.tobytes()
            counts[odd] = 0
            edges = np.concatenate([[0], np.cumsum(counts)])
            parts, done = [], 0
            for d in odd.tolist():
                own = np.frombuffer(self._some(raw[offsets[d] : offsets[d + 1]]), np.uint32)
                parts += [ids[done : edges[d]], own]
                done = edges[d]
                counts[d] = len(own)
            ids = np.concatenate([*parts, ids[done:]])
        return ids, counts


_ENCODERS: dict[tuple[str, bool], BatchEncoder] = {}


def encoder(tokenizer_path: str, specials: bool = True) -> BatchEncoder:
    """This worker's encoder for a file, kept from task to task."""
    if (tokenizer_path, specials) not in _ENCODERS:
        _ENCODERS[tokenizer_path, specials] = BatchEncoder(tokenizer_path, specials)
    return _ENCODERS[tokenizer_path, specials]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1, column.offset * 8)
    own = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return own, offsets - offsets[0]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
