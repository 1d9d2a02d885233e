"""Vectorised hashes of words and of runs of words, over a batch of texts.

A word hash is a polynomial over the word's (tabulated) bytes, a run's hash a
polynomial over its (mixed) word hashes, both modulo 2**64 and from prefix sums,
so a batch costs a few numpy passes whatever the texts look like. Two
independent seeds give 128 bits, enough to stand for the words themselves.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tables(seed: int) -> tuple[np.ndarray, int, int]:
    table = mixed(np.arange(1, 257, dtype=np.uint64) * U(seed))
    step = int(mixed(np.array([seed + 2], np.uint64))[0]) | 1
    return table, step, pow(step, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of a batch of texts (bytes), in order."""

    def __init__(self, texts: list[bytes], lower: bool = False, space: np.ndarray = _SPACE):
        """``space``: which bytes (256 flags) separate words; a line feed must."""
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        self.data = data
        word = ~space[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        #: words of text d: first[d] to first[d + 1]
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)

    def hashes(self, seed: int) -> np.ndarray:
        table, step, back = _tables(seed)
        n = len(self.data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(table[self.data] * _powers(step, n), out=total[1:])
        h = (total[self.ends] - total[self.starts]) * _powers(back, n + 1)[self.starts]
        return mixed(h + U(seed) * (self.ends - self.starts).astype(np.uint64))

    def runs(self, hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
        """Hash of ``size`` consecutive words from each word on (garbage where
        fewer follow in the whole batch; callers mask by ``has_run``)."""
        n = len(hashes)
        out = np.zeros(n, np.uint64)
        if n >= size:
            _, step, back = _tables(seed + 2 * size)
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(step, n))))
            m = n - size + 1
            out[:m] = mixed((total[size:] - total[:m]) * _powers(back, m))
        return out

    def has_run(self, size: int) -> np.ndarray:
        """Whether ``size`` words of the same text start at each word."""
        last = np.repeat(self.first[1:], self.counts)
        return np.arange(len(self.starts)) + size <= last

    def whole(self, hashes: np.ndarray, seed: int) -> np.ndarray:
        """One hash per text: its whole word sequence."""
        n = len(hashes)
        _, step, back = _tables(seed + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(step, n))))
        a, b = self.first[:-1], self.first[1:]
        return mixed((total[b] - total[a]) * _powers(back, n + 1)[a] + self.counts.astype(np.uint64))
