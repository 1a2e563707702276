"""Tables of words by the hashes of their bytes, read and filled in bulk."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Sums run over so many bytes at a time; they take some 30 bytes each.
BLOCK = 1 << 20
#: Hashes tell words of up to so many bytes; longer ones must be told otherwise.
LONGEST_WORD = 200


class ByteHashes:
    """64-bit polynomial hashes of many stretches of bytes at once, from running sums."""

    def __init__(self):
        self.powers = self.inverses = np.empty(0, np.uint64)

    def of(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(sum up to the end - sum up to the start) / base^start, modulo 2^64; never 0, and the same for all that are too long."""
        lengths = np.where(lengths > LONGEST_WORD, 0, lengths)
        out = np.empty(len(starts), np.uint64)
        low = 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + BLOCK)))
            first, last = int(starts[low]), int((starts[low:high] + lengths[low:high]).max())
            out[low:high] = self._of(data[first:last], starts[low:high] - first, lengths[low:high])
            low = high
        return out

    def _of(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(data):
            self.powers, self.inverses = (_powers(b, len(data) + BLOCK // 8) for b in (_BASE, _INVERSE))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        return (sums[starts + lengths] - sums[starts]) * self.inverses[starts] | np.uint64(1) << np.uint64(63)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordTable:
    """Rows by 64-bit hashes: an open-addressed table that is read and filled in bulk."""

    def __init__(self):
        self.bits, self.used = 16, 0
        self.keys, self.rows = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)

    def _at(self, keys: np.ndarray, step: int) -> np.ndarray:
        slot = (keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)
        return ((slot + np.uint64(step)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's row, -1 if it has none."""
        out = np.full(len(keys), -1, np.int64)
        left, step = np.arange(len(keys)), 0
        while len(left):
            at = self._at(keys[left], step)
            there = self.keys[at]
            hit = there == keys[left]
            out[left[hit]] = self.rows[at[hit]]
            left = left[~hit & (there != 0)]
            step += 1
        return out

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """New, distinct keys."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.keys != 0
            all_keys, all_rows = np.concatenate([self.keys[old], keys]), np.concatenate([self.rows[old], rows])
            self.bits, self.used = max(self.bits, int(4 * len(all_keys)).bit_length()), 0
            self.keys, self.rows = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
            return self.add(all_keys, all_rows)
        self.used += len(keys)
        step = 0
        while len(keys):
            at = self._at(keys, step)
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]
            mine = free & (self.keys[at] == keys)
            self.rows[at[mine]] = rows[mine]
            keys, rows = keys[~mine], rows[~mine]
            step += 1


def gather(pool: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The pool's stretches one after another."""
    ends = np.cumsum(counts)
    return pool[np.repeat(starts - ends + counts, counts) + np.arange(int(ends[-1]) if len(ends) else 0)]
