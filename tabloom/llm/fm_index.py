"""FM-index over a sequence of word symbols: backward search through wavelet ranks, positions by sampled suffixes."""

import numpy as np


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length until all ranks differ. The last symbol must be unique."""
    n, width = len(ranks), 1
    _, ranks = np.unique(ranks, return_inverse=True)
    while True:
        following = np.zeros(n, np.int64)
        following[:n - width] = ranks[width:] + 1
        keys = ranks * (n + 1) + following
        order = np.argsort(keys, kind="stable")
        ranked = np.cumsum(np.concatenate([[0], keys[order][1:] != keys[order][:-1]]))
        ranks[order] = ranked
        if ranked[-1] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector per bit of the symbol, highest first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.shifts, self.zeros, current = list(range(bits - 1, -1, -1)), [], symbols
        for shift in self.shifts:
            zero = (current >> shift) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]))
            current = np.concatenate([current[zero], current[~zero]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        first = np.zeros_like(at)
        for shift, zeros in zip(self.shifts, self.zeros):
            one, total = (symbols >> shift) & 1 == 1, zeros[-1]
            at = np.where(one, total + at - zeros[at], zeros[at])
            first = np.where(one, total + first - zeros[first], zeros[first])
        return at - first

    def symbols(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the positions."""
        found = np.zeros_like(at)
        for shift, zeros in zip(self.shifts, self.zeros):
            zero, total = zeros[at + 1] > zeros[at], zeros[-1]
            found = np.where(zero, found, found | (1 << shift))
            at = np.where(zero, zeros[at], total + at - zeros[at])
        return found


class FMIndex:
    """Index of stretches of symbols (1 and above), each followed by a 0."""

    STEP = 16            # a suffix position is kept for each 16th symbol and for the first of each stretch

    def __init__(self, sequence: np.ndarray):
        separators = sequence == 0
        ranks = sequence + int(separators.sum())
        ranks[separators] = np.arange(separators.sum())
        order = suffix_order(ranks)
        before = sequence[order - 1]
        self.size = int(sequence.max()) + 1
        self.wavelet = WaveletMatrix(before, max(1, (self.size - 1).bit_length()))
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=self.size))])
        starts = np.concatenate([[True], separators[:-1]])
        sampled = (order % self.STEP == 0) | starts[order]
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]

    def search(self, patterns: np.ndarray):
        """Row ranges [low, high) of the suffixes that begin with each pattern (one pattern per matrix row)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.smaller[-1])
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbols = patterns[alive, k]
            known = symbols < self.size
            alive, symbols = alive[known], symbols[known]
            low[alive] = self.smaller[symbols] + self.wavelet.rank(symbols, low[alive])
            high[alive] = self.smaller[symbols] + self.wavelet.rank(symbols, high[alive])
            alive = alive[low[alive] < high[alive]]
        found = np.zeros(len(patterns), bool)
        found[alive] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in the given rows: backward steps to the next kept position."""
        out, steps, left = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            at = rows[left]
            kept = self.sampled[at + 1] > self.sampled[at]
            out[left[kept]] = self.positions[self.sampled[at[kept]]] + steps
            left, at, steps = left[~kept], at[~kept], steps + 1
            symbols = self.wavelet.symbols(at)
            rows[left] = self.smaller[symbols] + self.wavelet.rank(symbols, at)
        return out
