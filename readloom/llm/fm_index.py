"""An FM-index over a sequence of symbols: suffix array, wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every so many text positions one is kept; others are found by walking back to one.
SAMPLE = 32


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by prefix doubling; a suffix that ends first comes first."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    order = np.argsort(rank, kind="stable")
    while n:
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - width)] = rank[width:]
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        rank, width = new, width * 2
        if rank[order[-1]] == n or width >= n:
            break
    return order


class WaveletMatrix:
    """Access and rank over symbols, one bit level after the other, for many places at once."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        rest = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (rest >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(len(rest) - self.ones[-1][-1]))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the symbol's occurrences before `at` end in the last level; minus place(symbol, 0) it is their number."""
        for level in range(self.bits):
            one = self.ones[level][at]
            up = (symbol >> (self.bits - 1 - level)) & 1
            at = np.where(up == 1, self.zeros[level] + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self.place(symbol, at) - self.place(symbol, np.zeros_like(at))

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the places."""
        symbol = np.zeros_like(at)
        for level in range(self.bits):
            one, behind = self.ones[level][at], self.ones[level][at + 1]
            up = behind - one
            symbol = symbol * 2 + up
            at = np.where(up == 1, self.zeros[level] + one, at - one)
        return symbol


class FMIndex:
    """Of a sequence of symbols from 1 to n_symbols - 1; 0 is taken for its end."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        text = np.concatenate([np.asarray(text, np.int64), [0]])
        positions = suffix_array(text)
        bwt = text[positions - 1]
        self.wavelet = WaveletMatrix(bwt, n_symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=n_symbols))]).astype(np.int64)
        kept = positions % SAMPLE == 0
        self.sampled = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])
        self.positions = positions[kept]
        self.n = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase (phrases x length)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            s = phrases[alive, column]
            low[alive] = self.before[s] + self.wavelet.rank(s, low[alive])
            high[alive] = self.before[s] + self.wavelet.rank(s, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: each walks back until it meets a sampled one."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        while True:
            walking = np.flatnonzero(self.sampled[rows + 1] == self.sampled[rows])
            if not len(walking):
                return self.positions[self.sampled[rows]] + steps
            at = rows[walking]
            s = self.wavelet.access(at)
            rows[walking] = self.before[s] + self.wavelet.rank(s, at)
            steps[walking] += 1
