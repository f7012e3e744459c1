"""Whole-batch text work on UTF-8 bytes with numpy: words, word hashes, shingle hashes.

All functions take the bytes of many texts laid end to end plus their bounds, as Arrow holds them, so that no Python
string is made for a word. Words end at ASCII white space only, which is safe on UTF-8 bytes.

The 64-bit hashes here are fast and no proof of equality: different words can share one. Whoever needs a proof compares the
bytes (``tally``, ``spans_differ``) or takes the digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, _U64), _INVERSE: np.ones(1, _U64)}

#: Space and the bytes 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the result."""
    x = x ^ (x >> _U64(30))
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


#: A random-looking odd 64-bit number for each byte.
_BYTE = mix64(np.arange(1, 257, dtype=_U64) * _U64(0xD6E8FEB86659FD93)) | _U64(1)


def _power(base: int, n: int) -> np.ndarray:
    have = _powers[base]
    if len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, _U64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair; equal runs get equal hashes wherever they stand."""
    n = len(values)
    total = np.zeros(n + 1, _U64)
    np.cumsum(values * _power(_BASE, n), out=total[1:])
    h = (total[end] - total[start]) * _power(_INVERSE, n + 1)[start]
    return mix64(h ^ ((end - start).astype(_U64) * _U64(0xA0761D6478BD642F)))


def places(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """at[i], at[i] + 1 … of size[i] places, for all i end to end."""
    return np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def spans_differ(one: np.ndarray, a: np.ndarray, a_size: np.ndarray, two: np.ndarray, b: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Whether the bytes one[a:a + a_size] differ from two[b:b + b_size], for each pair of spans."""
    differ = a_size != b_size
    size = np.where(differ, 0, a_size)
    wrong = one[places(a, size)] != two[places(b, size)]
    if wrong.any():
        differ[np.repeat(np.arange(len(a)), size)[wrong]] = True
    return differ


def slices(batch: pa.RecordBatch, column: str, most: int, step: int = 1) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, bounds) for runs of rows of about ``most`` bytes; a null text has no bytes.

    Every ``step`` rows stay together. A row larger than ``most`` is a run of its own, so memory follows the longest text and not the batch.
    """
    col = batch.column(column).cast(pa.large_string()).fill_null("")
    if not len(col):
        return
    buffers = col.buffers()
    bounds = np.frombuffer(buffers[1], np.int64, len(col) + 1, 8 * col.offset)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        to = int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1
        to = at + max(step, (to - at) // step * step)
        yield at, to, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def word_spans(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the range of its words (bounds into the two)."""
    n = len(data)
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = after[-1] = True
        np.logical_not(inside[:-1], out=before[1:])
        np.logical_not(inside[1:], out=after[:-1])
        before |= edge[:-1]
        after |= edge[1:]
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    return start, end, np.searchsorted(start, bounds)


_FACTORS = mix64(np.arange(101, 165, dtype=_U64)) | _U64(1)


class Shingles:
    """The runs of k words of many texts, A-Z in lower case, repeats included.

    A text of fewer than k words has one shingle, the whole sequence; a text without words has none. ``bounds`` gives each
    text's range in ``hashes``, ``at`` and ``size``: a hash, the first word and the number of words of each shingle.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, k: int):
        self.data, self.k = LOWER[data], k
        self.start, self.end, self.per_text = word_spans(data, bounds)
        words = span_hashes(_BYTE[self.data], self.start, self.end)
        m = np.diff(self.per_text)
        n = np.where(m == 0, 0, np.maximum(1, m - k + 1))
        self.bounds = np.concatenate([[0], np.cumsum(n)])
        self.at = np.repeat(self.per_text[:-1] - self.bounds[:-1], n) + np.arange(self.bounds[-1])
        self.size = np.repeat(np.minimum(m, k), n)
        if not len(words):
            self.hashes = np.zeros(0, _U64)
            return
        padded = np.concatenate([words, np.zeros(k - 1, _U64)])
        runs = words * _FACTORS[0]
        for j in range(1, k):
            runs += padded[j : j + len(words)] * _FACTORS[j]
        h = runs[self.at] ^ _U64(k)
        for i in np.flatnonzero((m > 0) & (m < k)):
            own = words[self.per_text[i] : self.per_text[i + 1]]
            h[self.bounds[i]] = (own * _FACTORS[: len(own)]).sum(dtype=_U64) ^ _U64(len(own))
        self.hashes = mix64(h)

    def words(self, i: int) -> tuple[bytes, ...]:
        """Shingle i itself."""
        return tuple(self.data[self.start[w] : self.end[w]].tobytes() for w in range(self.at[i], self.at[i] + self.size[i]))

    def differ(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether shingles x and y differ, word by word and byte by byte."""
        out = self.size[x] != self.size[y]
        for j in range(self.k):
            i = np.flatnonzero(~out & (j < self.size[x]))
            a, b = self.at[x[i]] + j, self.at[y[i]] + j
            out[i] = spans_differ(self.data, self.start[a], self.end[a] - self.start[a], self.data, self.start[b], self.end[b] - self.start[b])
        return out

    def tally(self, sides: int = 1) -> np.ndarray:
        """(texts / sides, 2 ** sides): of every ``sides`` neighbouring texts, how many distinct shingles stand in which of
        them. Column 3 of two sides counts those that both have, 1 and 2 those of the first and the second alone.

        Shingles are sorted by their hash; those with equal hashes are compared in full, and where two differ, the sets of
        these texts are made of the words themselves.
        """
        owners = (len(self.bounds) - 1) // sides
        text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        owner, side = text // sides, (1 << (text % sides)).astype(np.int64)
        order = np.lexsort((self.hashes, owner))
        h, o = self.hashes[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        again = np.flatnonzero(~new)
        wrong = np.unique(o[again][self.differ(order[again], order[again - 1])])
        first = np.flatnonzero(new)
        marks = np.bitwise_or.reduceat(side[order], first) if len(first) else first
        out = np.bincount(o[first] << sides | marks, minlength=owners << sides).reshape(owners, 1 << sides)
        for i in wrong.tolist():
            kinds: dict[tuple, int] = {}
            for s in range(sides):
                for j in range(self.bounds[i * sides + s], self.bounds[i * sides + s + 1]):
                    kinds[w] = kinds.get(w := self.words(j), 0) | 1 << s
            out[i] = np.bincount(list(kinds.values()), minlength=1 << sides)
        return out


def sequence_digests(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, 2): 128 bits of the SHA-256 of each text's words, A-Z in lower case, with one space between words."""
    space = SPACE[data]
    after = np.zeros(len(data), bool)
    after[1:] = ~space[:-1]
    after[bounds[:-1][bounds[:-1] < len(data)]] = False
    keep = ~space | after
    low = np.where(space, np.uint8(0x20), LOWER[data])[keep].tobytes()
    ends = np.concatenate([[0], np.cumsum(keep)])[bounds].tolist()
    digests = b"".join(hashlib.sha256(low[a:b].rstrip(b" ")).digest()[:16] for a, b in zip(ends[:-1], ends[1:], strict=True))
    return np.frombuffer(digests, np.int64).reshape(-1, 2)
