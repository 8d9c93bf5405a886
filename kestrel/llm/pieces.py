"""Token ids of pieces of text, remembered by the bytes of the piece.

Tokenizers that cut a text into pieces and encode each by itself spend most of
their time on pieces that they have seen before.  :class:`PieceIds` looks up
many pieces at a time: a piece of up to 15 bytes *is* its two 64-bit keys
(its bytes and its length), so nothing is trusted to a hash; longer ones are
keys of a dictionary.  Only pieces that are new go to ``learn``.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

GROUP_BYTES = 1 << 20              # of texts that are cut together
CACHED = (1 << 20) - GROUP_BYTES // 4
SHORT = 15                         # bytes of a piece that fit its keys
_LOW = np.array([(1 << 8 * n) - 1 if n < 8 else (1 << 64) - 1 for n in range(17)], np.uint64)
_HIGH = np.array([(1 << 8 * max(0, n - 8)) - 1 if n < 16 else (1 << 64) - 1 for n in range(17)], np.uint64)


class _Rows:
    """Row numbers of pairs of 64-bit keys: open addressing, looked up many at a time."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.low, self.high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.rows = np.zeros(1 << bits, np.int32)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ high * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        return ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The rows of the keys, -1 where there is none; a high key is never zero."""
        slot, out = self._slots(low, high), np.full(len(low), -1, np.int32)
        left = np.arange(len(low))
        while len(left):
            at = slot[left]
            there = self.high[at]
            hit = (there == high[left]) & (self.low[at] == low[left])
            out[left[hit]] = self.rows[at[hit]]
            left = left[~hit & (there != 0)]
            slot[left] = (slot[left] + 1) & self.mask
        return out

    def add(self, low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> None:
        """Give different, unknown keys their rows."""
        slot, left = self._slots(low, high), np.arange(len(low))
        while len(left):
            free = left[self.high[slot[left]] == 0]
            self.rows[slot[free]] = rows[free]                      # of several for a slot the last one has it
            mine = free[self.rows[slot[free]] == rows[free]]
            self.low[slot[mine]], self.high[slot[mine]] = low[mine], high[mine]
            left = left[(self.high[slot[left]] != high[left]) | (self.low[slot[left]] != low[left])]
            slot[left] = (slot[left] + 1) & self.mask


class PieceIds:
    """``learn`` takes the bytes of new pieces and returns the ids of each."""

    def __init__(self, learn: Callable[[list[bytes]], list], cached: int = CACHED):
        self.learn, self.cached = learn, cached
        self._forget()

    def _forget(self, room: int = 0) -> None:
        # at most half full with what is cached and ``room`` new pieces
        self.size, self.known, self.long = 0, _Rows((2 * (self.cached + max(room, GROUP_BYTES // 4)) - 1).bit_length()), {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)        # piece k: flat[starts[k]:starts[k + 1]]

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        ids, first = self.learn(pieces), self.size
        if first + len(ids) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts) + len(ids), np.int64)])
        ends = self.starts[first] + np.cumsum([len(i) for i in ids])
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(self.flat), ends[-1]), np.uint32)])
        self.flat[self.starts[first]:ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32)
        self.starts[first + 1:first + 1 + len(ids)] = ends
        self.size += len(ids)
        return np.arange(first, self.size, dtype=np.int32)

    def rows(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Row of each piece; a piece ends where the next one starts."""
        if self.size > self.cached or 2 * (self.size + len(starts)) > len(self.known.rows):
            self._forget(len(starts))
        ends = np.append(starts[1:], len(data))
        length = ends - starts
        words = np.ndarray(len(data) + 8, "<u8", np.concatenate([data, np.zeros(16, np.uint8)]), strides=(1,))
        short = np.flatnonzero(length <= SHORT)
        size, at = length[short], starts[short]
        low = words[at] & _LOW[size]
        high = words[at + 8] & _HIGH[size] | size.astype(np.uint64) << np.uint64(56)
        out = np.full(len(starts), -1, np.int32)
        out[short] = self.known.find(low, high)
        new = np.flatnonzero(out[short] < 0)
        if len(new):
            order = np.lexsort((low[new], high[new]))
            a, b = low[new][order], high[new][order]
            head = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            rows = self._learn([data[s:e].tobytes() for s, e in zip(
                at[new][order][head].tolist(), (at + size)[new][order][head].tolist())])
            self.known.add(a[head], b[head], rows)
            there = np.empty(len(new), np.int32)
            there[order] = rows[np.cumsum(head) - 1]
            out[short[new]] = there
        if len(short) < len(starts):
            which = np.flatnonzero(length > SHORT)
            pieces = [data[s:e].tobytes() for s, e in zip(starts[which].tolist(), ends[which].tolist())]
            unknown = list(dict.fromkeys(p for p in pieces if p not in self.long))
            if unknown:
                self.long.update(zip(unknown, self._learn(unknown).tolist()))
            out[which] = [self.long[p] for p in pieces]
        return out

    def ids(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces one after another, and where each piece's end."""
        row = self.rows(data, starts)
        begin = self.starts[row]
        count = self.starts[row + 1] - begin
        into = np.cumsum(count)
        shift = begin - into + count
        return self.flat[np.arange(into[-1] if len(into) else 0) + np.repeat(shift, count)], into
