"""A static range asymmetric numeral system over token ids, with many interleaved lanes so that numpy codes a row at a time.

States are 64-bit integers in [2^31, 2^63), renormalised by 32-bit words; token t of a block belongs to lane t mod lanes.
A block stands alone: it needs the shared frequency table and nothing from its neighbours. Every ``every`` rows it holds a
checkpoint, that is the states and the place in the word stream, from which decoding can start in parallel.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

LOW = np.uint64(1 << 31)
MAGIC = b"RNS1"
_HEAD = struct.Struct("<4sBIIQQQIQI")
_U64 = np.uint64


@dataclass(frozen=True)
class Model:
    bits: int
    freq: np.ndarray  #: uint64 for each id; sums to 2^bits, 0 for an id that never occurs

    @staticmethod
    def fit(counts: np.ndarray) -> Model:
        """Frequencies in proportion to the counts, at least 1 for every id that occurs."""
        counts = np.asarray(counts, np.int64)
        used = int((counts > 0).sum())
        bits = max(16, min(24, used.bit_length() + 4))
        whole = 1 << bits
        freq = np.where(counts > 0, np.maximum(1, (counts * (whole / max(1, counts.sum()))).astype(np.int64)), 0)
        order = np.argsort(-freq, kind="stable")
        excess = int(freq.sum()) - whole
        if used and excess < 0:
            freq[order[0]] -= excess
        for i in order:
            if excess <= 0:
                break
            less = min(excess, int(freq[i]) // 2)
            freq[i] -= less
            excess -= less
        return Model(bits, freq.astype(_U64))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """First slot of each id, and the id of each slot."""
        start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(_U64)
        return start, np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))

    def to_bytes(self) -> bytes:
        return struct.pack("<B", self.bits) + self.freq.astype("<u4").tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> Model:
        return Model(raw[0], np.frombuffer(raw, "<u4", offset=1).astype(_U64))


class Coder:
    def __init__(self, model: Model, lanes: int = 1024, every: int = 128):
        self.model, self.lanes, self.every = model, lanes, every
        self.start, self.symbol = model.tables()

    def _encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lanes, bits = self.lanes, _U64(self.model.bits)
        n = len(ids)
        freq, start = self.model.freq[ids], self.start[ids]
        if n and not freq.all():
            raise ValueError("an id has no frequency in the shared table")
        limit = freq << (_U64(63) - bits)
        x = np.full(lanes, LOW, _U64)
        chunks, emitted, marks = [], 0, []
        for step in range((n + lanes - 1) // lanes - 1, -1, -1):
            a, b = step * lanes, min(n, (step + 1) * lanes)
            xs = x[: b - a]
            over = xs >= limit[a:b]
            if over.any():
                chunks.append(xs[over].astype("<u4"))
                emitted += len(chunks[-1])
                xs = np.where(over, xs >> _U64(32), xs)
            q, r = np.divmod(xs, freq[a:b])
            x[: b - a] = (q << bits) + r + start[a:b]
            if step % self.every == 0:
                marks.append((emitted, x.copy()))
        marks = marks[::-1] or [(0, x)]
        words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
        return words, np.array([len(words) - e for e, _ in marks], "<u8"), np.array([s for _, s in marks], "<u8")

    def _decode(self, x: np.ndarray, words: np.ndarray, at: int, n: int) -> np.ndarray:
        lanes, bits, freq, start = self.lanes, _U64(self.model.bits), self.model.freq, self.start
        low = _U64((1 << self.model.bits) - 1)
        out = np.empty(n, np.uint32)
        x = x.astype(_U64)
        for a in range(0, n, lanes):
            b = min(n, a + lanes)
            xs = x[: b - a]
            slot = xs & low
            out[a:b] = s = self.symbol[slot.astype(np.int64)]
            xs = freq[s] * (xs >> bits) + slot - start[s]
            under = xs < LOW
            if m := int(under.sum()):
                xs[under] = (xs[under] << _U64(32)) | words[at : at + m]
                at += m
            x[: b - a] = xs
        return out

    def pack(self, ids: np.ndarray, lengths: np.ndarray, doc_ids: np.ndarray, absent: np.ndarray, first: int) -> bytes:
        """A block of whole documents; ``first`` is the number of ids before it in the whole corpus."""
        words, places, states = self._encode(ids)
        body = b"".join([
            _HEAD.pack(MAGIC, self.model.bits, self.lanes, self.every, len(lengths), len(ids), first, len(places), len(words), zlib.crc32(ids.astype("<u4").tobytes())),
            doc_ids.astype("<i8").tobytes(), lengths.astype("<u8").tobytes(), absent.astype(np.uint8).tobytes(), places.tobytes(), states.tobytes(), words.tobytes(),
        ])
        return body + struct.pack("<I", zlib.crc32(body))

    def unpack(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """What ``pack`` was given. Raises ValueError if a checksum differs."""
        parts = self._parts(raw)
        _, bits, lanes, every, _, n, first, _, _, crc = parts[0]
        _, doc_ids, lengths, absent, places, states, words = parts
        span = every * lanes
        ids = [self._decode(states[i], words, int(places[i]), min(span, n - i * span)) for i in range(len(places))]
        ids = np.concatenate(ids) if n else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("the decoded ids don't match their checksum")
        return ids, lengths.astype(np.int64), doc_ids, absent.astype(bool), first

    def segment(self, raw: bytes, i: int) -> np.ndarray:
        """The ids from checkpoint i to the next alone."""
        head, _, _, _, places, states, words = self._parts(raw)
        span = self.every * self.lanes
        return self._decode(states[i], words, int(places[i]), min(span, head[5] - i * span))

    def _parts(self, raw: bytes):
        if raw[:4] != MAGIC or zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("not a block, or a damaged one")
        head = _HEAD.unpack_from(raw)
        _, bits, lanes, every, n_docs, _, _, n_marks, n_words, _ = head
        if (bits, lanes, every) != (self.model.bits, self.lanes, self.every):
            raise ValueError("the block was written with other parameters")
        at, out = _HEAD.size, [head]
        for kind, count in (("<i8", n_docs), ("<u8", n_docs), ("u1", n_docs), ("<u8", n_marks), ("<u8", n_marks * lanes), ("<u4", n_words)):
            out.append(np.frombuffer(raw, kind, count, at))
            at += out[-1].nbytes
        out[5] = out[5].reshape(n_marks, lanes)
        return out
