"""Byte-pair merging of many words at once, in order of rank: the packing operator's ids."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np

from roadsift.llm.int_table import IntTable
from roadsift.llm.pretokens import Vocabulary, byte_symbols

#: Widths of the tables in which words are merged; longer words go alone, by a heap, in time that grows hardly faster than they.
WIDTHS = (6, 10, 16, 32, 64)
_NONE = np.int32(1 << 30)


class RankMerger:
    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.ids
        inner = [ids[c] for c in byte_symbols()]
        last = [ids[c + vocabulary.suffix] for c in byte_symbols()]
        self.symbol = np.array([*inner, *last], np.int32)
        self.suffix = bool(vocabulary.suffix)
        pairs = np.array([ids[a] << 20 | ids[b] for a, b in vocabulary.merges], np.int64)
        self.ranks = IntTable(pairs, np.arange(len(pairs), dtype=np.int64))
        self.made = np.array([ids[a + b] for a, b in vocabulary.merges], np.int32)
        self.rank_of = {int(p): k for k, p in enumerate(pairs)}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.ranks.get(left.astype(np.int64) << 20 | right.astype(np.int64), int(_NONE)).astype(np.int32)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(x) for x in raw])
        out: list[bytes] = [b""] * len(words)
        low = 0
        for width in (*WIDTHS, None):
            which = np.flatnonzero((sizes > low) & (sizes <= (width or sizes.max(initial=0))))
            if width is not None:
                self._merge([raw[k] for k in which], which, sizes[which], width, out)
                low = width
            else:
                for k in which:
                    out[k] = self.encode_long(raw[k])
        return out

    def encode_long(self, word: bytes) -> bytes:
        """The same for one word, with a heap of the pairs that may merge."""
        codes = np.frombuffer(word, np.uint8).astype(np.int64)
        if self.suffix:
            codes[-1] += 256
        symbol, made, ranks = self.symbol[codes].tolist(), self.made.tolist(), self.rank_of
        n = len(symbol)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbol[i], symbol[i + 1]) for i in range(n - 1) if (r := ranks.get(symbol[i] << 20 | symbol[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i, a, b = heappop(heap)
            j = right[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue  # one of the two is merged already
            symbol[i], symbol[j] = made[rank], -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
            for x, y in ((left[i], i), (i, k)):
                if x >= 0 and y < n and (r := ranks.get(symbol[x] << 20 | symbol[y])) is not None:
                    heappush(heap, (r, x, symbol[x], symbol[y]))
        return np.array([s for s in symbol if s >= 0], "<u4").tobytes()

    def _merge(self, raw: list[bytes], which: np.ndarray, sizes: np.ndarray, width: int, out: list[bytes]) -> None:
        if not raw:
            return
        n = len(raw)
        codes = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in raw), np.uint8).reshape(n, width).astype(np.int32)
        if self.suffix:
            codes[np.arange(n), sizes - 1] += 256
        table = self.symbol[codes]
        column = np.arange(width + 1, dtype=np.int64)
        after = np.minimum(column[None, 1:], sizes[:, None])  # the next symbol's place, or the word's end
        before = np.tile(column[None, :-1] - 1, (n, 1))
        rank = np.full((n, width), _NONE)
        row, at = np.nonzero(column[None, 1:-1] < sizes[:, None])
        rank[row, at] = self._rank(table[row, at], table[row, at + 1])
        live = np.flatnonzero(sizes > 1)
        while len(live):
            at = rank[live].argmin(axis=1)
            best = rank[live, at]
            on = best < _NONE
            live, at, best = live[on], at[on], best[on]
            gone = after[live, at]
            table[live, at] = self.made[best]
            rank[live, gone] = _NONE
            rank[live, at] = _NONE
            table[live, gone] = -1
            then = after[live, gone]
            after[live, at] = then
            inner = np.flatnonzero(then < sizes[live])
            r, i, k = live[inner], at[inner], then[inner]
            before[r, k] = i
            rank[r, i] = self._rank(table[r, i], table[r, k])
            inner = np.flatnonzero(before[live, at] >= 0)
            r, i = live[inner], at[inner]
            h = before[r, i]
            rank[r, h] = self._rank(table[r, h], table[r, i])
        stays = (table >= 0) & (column[None, :-1] < sizes[:, None])
        flat = table[stays].astype("<u4").tobytes()
        ends = (4 * np.cumsum(stays.sum(axis=1))).tolist()
        for k, a, b in zip(which.tolist(), [0, *ends], ends, strict=False):
            out[k] = flat[a:b]
