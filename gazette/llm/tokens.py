"""Words of UTF-8 texts as numpy arrays: places and 64-bit hashes.

Works on the concatenated bytes of many rows; a word never crosses a row.  The
hash of a word is a polynomial of its bytes read off one running sum, so the
cost is a few vector operations per byte, whatever the word lengths.
"""

from __future__ import annotations

import numpy as np

SLAB = 1 << 19  # bytes handled at once; one longer row is cut between words

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """``base ** i`` modulo 2^64 for ``i < n``, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < len(out):
        k = min(done, len(out) - done)
        out[done:done + k] = out[:k] * np.uint64(pow(int(base), done, 1 << 64))
        done += k
    return out


def inverse(odd: np.uint64) -> np.uint64:
    """Inverse of an odd number modulo 2^64."""
    return np.uint64(pow(int(odd), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


class Tokenizer:
    """Finds words: bytes marked in ``is_word``, mapped by ``lower`` (256 entries each)."""

    def __init__(self, is_word: np.ndarray, lower: np.ndarray):
        self.is_word, self.lower = is_word, lower
        self._up = self._down = np.zeros(0, np.uint64)

    def _tables(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(n, SLAB + 1)
            self._up, self._down = powers(size), powers(size, inverse(_BASE))
        return self._up, self._down

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """``(start, end, hash, row)`` of each word, in order, over rows ``offsets``."""
        parts, base = [], int(offsets[0])
        end = int(offsets[-1])
        while base < end:
            stop = min(end, base + SLAB)
            if stop < end:  # cut at a row start or at a byte outside words
                row = int(offsets[np.searchsorted(offsets, stop, side="right") - 1])
                if row > base:
                    stop = row
                else:
                    gaps = np.flatnonzero(~self.is_word[data[base:stop]])
                    while not len(gaps) and stop < end:
                        more = min(end, stop + SLAB)
                        gaps = np.flatnonzero(~self.is_word[data[stop:more]]) + (stop - base)
                        stop = more
                    stop = base + int(gaps[-1]) + 1 if len(gaps) and stop < end else stop
            parts.append(self._piece(data, offsets, base, stop))
            base = stop
        if not parts:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(0, np.uint64), z
        start, last, h = (np.concatenate(x) for x in zip(*parts))
        return start, last, h, np.searchsorted(offsets, start, side="right") - 1

    def _piece(self, data, offsets, base, stop):
        raw = data[base:stop]
        n = len(raw)
        on = self.is_word[raw]
        cut = np.zeros(n + 1, bool)
        rows = offsets[(offsets >= base) & (offsets <= stop)] - base
        cut[rows] = True
        cut[0] = cut[n] = True
        head = on.copy()
        head[1:] &= ~on[:-1] | cut[1:n]
        tail = on.copy()
        tail[:-1] &= ~on[1:] | cut[1:n]
        start, last = np.flatnonzero(head), np.flatnonzero(tail) + 1
        up, down = self._tables(n + 1)
        run = np.zeros(n + 1, np.uint64)
        np.cumsum((self.lower[raw].astype(np.uint64) + np.uint64(1)) * up[:n], out=run[1:])
        h = mixed((run[last] - run[start]) * down[start])
        return start + base, last + base, h


def ascii_lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def marked(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry mask of the byte ranges, both ends included."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b + 1] = True
    return table
