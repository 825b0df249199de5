"""Many texts as one array of UTF-8 bytes: words, owners and substring hashes."""

from __future__ import annotations

import numpy as np

#: An odd multiplier and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a difference in any bit over all 64 (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class TextBytes:
    """``begin`` and ``end`` of each text, ``starts`` and ``ends`` of all words
    (runs without space or \\t to \\r) and the ``owner`` (text) of each word."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.array([len(t) for t in texts], np.int64)
        self.end = np.cumsum(lengths + 1) - 1  # the line end behind each text
        self.begin = self.end - lengths
        self.space = _SPACE[self.data]
        edge = np.diff(self.space.view(np.int8), prepend=1)
        self.starts = np.flatnonzero(edge == -1)
        self.ends = np.flatnonzero(edge == 1)
        self.owner = np.searchsorted(self.end, self.starts)
        self._sums: np.ndarray | None = None

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes from ``start`` up to ``end``.

        Prefix sums of a polynomial in the bytes give any substring's hash.
        """
        if self._sums is None:
            size = len(self.data)
            terms = (self.data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, size - 1)
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
            self._back = _powers(_INVERSE, size)
        value = (self._sums[end] - self._sums[start]) * self._back[start]
        return mix(value + np.uint64(BASE) * (end - start).astype(np.uint64))
