"""Token ids of whole batches with the tokenizers library.

Natural text repeats its words, so a text is cut where byte-level pre-tokenisation certainly cuts, and each distinct piece
is encoded once and remembered with its bytes. A piece is looked up by a hash, and every find is compared byte by byte; what
differs is encoded by itself. The ids are those of encoding the whole text: a cut is made only
  - before a space that a printable character follows (the space opens that character's pre-token),
  - round a line feed that a printable character follows (it is a pre-token of its own), and
  - between an ASCII letter and ASCII punctuation.
Characters that could start a Unicode space are not taken as printable. Vocabulary files with another pre-tokeniser or a
normaliser, and texts that hold an added token, are encoded whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from . import textbytes as tb
from .shared import CACHES

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_VISIBLE = np.ones(256, bool)
_VISIBLE[: 0x20 + 1] = False
_VISIBLE[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False

#: Slots of the cache of pieces, and ids and bytes kept before it starts afresh.
SLOTS, STORED, KEPT = 1 << 21, 1 << 23, 1 << 25


class Store:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.values, self.size = np.zeros(1 << 16, dtype), 0

    def add(self, more: np.ndarray) -> int:
        """Appends; returns the place of the first new value."""
        at, end = self.size, self.size + len(more)
        if end > len(self.values):
            self.values = np.concatenate([self.values[:at], np.zeros(at + 2 * len(more), self.values.dtype)])
        self.values[at:end], self.size = more, end
        return at


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.added = [t["content"].encode() for t in added]
        self.pieces = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
            and not spec.get("post_processor") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.reset()

    def reset(self) -> None:
        self.key = np.zeros(SLOTS, np.uint64)
        self.at, self.len, self.byte_at, self.bytes = (np.zeros(SLOTS, np.uint32) for _ in range(4))
        self.store, self.texts = Store(self.dtype), Store(np.uint8)

    def _whole(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        ids = [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([*ids, np.zeros(0, self.dtype)]), np.cumsum([0, *map(len, ids)])

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and their bounds."""
        n = len(data)
        raw = data.tobytes()
        if not self.pieces or not n or any(t in raw for t in self.added):
            return self._whole(data, bounds)
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        visible = _VISIBLE[data[1:]] & ~cut[1:n]  # the next character, of the same text
        cut[: n - 1] |= visible & (data[:-1] == 0x20)
        line = np.flatnonzero(visible & (data[:-1] == 0x0A))
        cut[line] = cut[line + 1] = True
        cut[1:n] |= _LETTER[data[:-1]] & _PUNCT[data[1:]]
        edges = np.flatnonzero(cut)
        start, end = edges[:-1], edges[1:]
        h = tb.span_hashes(tb._BYTE[data], start, end)
        slot = (h >> np.uint64(64 - 21)).astype(np.int64)
        at, size, byte_at, n_bytes = (x[slot] for x in (self.at, self.len, self.byte_at, self.bytes))
        if len(miss := np.flatnonzero(self.key[slot] != h)):
            new, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            first = miss[first]
            ids, sizes = self._pieces(raw, start[first], end[first])
            own = data[tb.places(start[first], end[first] - start[first])]
            if self.store.size + len(ids) > max(STORED, 2 * len(ids)) or self.texts.size + len(own) > max(KEPT, 2 * len(own)):
                return self._afresh(data, bounds)
            n_own = (end[first] - start[first]).astype(np.uint32)
            new_at = (np.cumsum(sizes) - sizes + self.store.add(ids)).astype(np.uint32)
            new_byte = (np.cumsum(n_own, dtype=np.int64) - n_own + self.texts.add(own)).astype(np.uint32)
            at[miss], size[miss], byte_at[miss], n_bytes[miss] = new_at[back], sizes[back], new_byte[back], n_own[back]
            s = (new >> np.uint64(64 - 21)).astype(np.int64)
            self.key[s], self.at[s], self.len[s], self.byte_at[s], self.bytes[s] = new, new_at, sizes, new_byte, n_own
        at, size = at.astype(np.int64), size.astype(np.int64)
        wrong = n_bytes != end - start
        length = np.where(wrong, 0, end - start)
        differ = self.texts.values[tb.places(byte_at.astype(np.int64), length)] != data[tb.places(start, length)]
        if differ.any():
            wrong[np.repeat(np.arange(len(start)), length)[differ]] = True
        if len(other := np.flatnonzero(wrong)):  # pieces that only share their hash with the one remembered
            ids, sizes = self._pieces(raw, start[other], end[other])
            at[other], size[other] = np.cumsum(sizes) - sizes + self.store.size, sizes
            values = np.concatenate([self.store.values[: self.store.size], ids])
        else:
            values = self.store.values
        total = np.concatenate([[0], np.cumsum(size)])
        return values[tb.places(at, size)], total[np.searchsorted(edges, bounds)]

    def _pieces(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces end to end, and how many each has."""
        texts = [raw[a:b].decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
        return np.fromiter((i for x in ids for i in x), self.dtype, int(sizes.sum())), sizes

    def _afresh(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.reset()
        return self.encode(data, bounds)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker."""
    return Encoder(path)


CACHES["encoder"] = encoder.cache_clear


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same, with ``end_id`` after each text."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
