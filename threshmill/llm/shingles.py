"""Word shingles of whole batches of texts as sorted sets of 64-bit hashes.

A text's A-Z are lowered and its words are runs of bytes other than space and tab to carriage return. Its set is that
of its distinct shingles of ``words`` words; with fewer words, the whole sequence is one; without any, it is empty.
"""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0xD1342543DE82EF95
_U = np.uint64
#: Bytes of text hashed together.
PART = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hasher:
    """Keeps the powers that hashing a batch needs."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, _U)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums from which ``between`` has the polynomial hash of any slice."""
        if len(self.powers) <= len(data):
            n = len(data) * 3 // 2 + 1
            self.powers, self.inverse = np.full(n, _U(_MULTIPLIER)), np.full(n, _U(pow(_MULTIPLIER, -1, 1 << 64)))
            self.powers[0] = self.inverse[0] = 1
            np.cumprod(self.powers, out=self.powers)
            np.cumprod(self.inverse, out=self.inverse)
        return np.concatenate([np.zeros(1, _U), np.cumsum((data.astype(_U) + _U(1)) * self.powers[: len(data)])])

    def between(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[begin]) * self.inverse[begin]

    def sets(self, data: np.ndarray, offsets: np.ndarray, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, edges): the sorted set of text i is ``hashes[edges[i]:edges[i+1]]``; about ``PART`` bytes at a time."""
        found, counts, i = [np.zeros(0, _U)], [np.zeros(1, np.int64)], 0
        while i < len(offsets) - 1:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PART, "right")) - 1)
            hashes, edges = self._sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
            found.append(hashes)
            counts.append(np.diff(edges))
            i = j
        return np.concatenate(found), np.cumsum(np.concatenate(counts))

    def _sets(self, data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        n_docs = len(offsets) - 1
        if not len(data):
            return np.zeros(0, _U), np.zeros(n_docs + 1, np.int64)
        low = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
        inside = (low != 32) & ((low < 9) | (low > 13))
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        starts = offsets[:-1][offsets[:-1] < len(data)]
        opens[starts] = inside[starts]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        ends = offsets[1:][offsets[1:] > 0] - 1
        closes[ends] = inside[ends]
        begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        word = mix(self.between(self.sums(low), begin, end) + (end - begin).astype(_U))
        first = np.searchsorted(begin, offsets[:-1])
        count = np.searchsorted(begin, offsets[1:]) - first
        if len(word) >= words:
            rolled = np.zeros(len(word) - words + 1, _U)
            for j in range(words):
                rolled = mix(rolled + word[j : len(word) - words + 1 + j])
        else:
            rolled = np.zeros(0, _U)
        kept = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
        edges = np.concatenate([[0], np.cumsum(kept)])
        out = np.zeros(int(edges[-1]), _U)
        for i in range(n_docs):
            a, b, f, c = edges[i], edges[i + 1], first[i], count[i]
            if c >= words:
                out[a:b] = rolled[f : f + c - words + 1]
                out[a:b].sort()
            elif c:
                h = np.full(1, c, _U)
                for w in word[f : f + c]:
                    h = mix(h + w + _U(0x51ED270B))
                out[a] = h[0]
        fresh = np.ones(len(out), bool)
        fresh[1:] = out[1:] != out[:-1]
        fresh[edges[:-1][edges[:-1] < len(out)]] = True
        return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[edges]
