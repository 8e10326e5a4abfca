"""A compressed FM-index over word sequences: a wavelet matrix of packed bits over the
Burrows-Wheeler transform, with backward search for many patterns at once."""

from __future__ import annotations

import numpy as np

U = np.uint64


class WaveletMatrix:
    """rank of any symbol before any place, in one bit vector per bit of the symbols. Bits are packed in
    64-bit words, with a count before each word."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.n = len(symbols)
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        x = symbols.astype(np.int64)
        for level in reversed(range(self.levels)):
            bit = (x >> level & 1).astype(bool)
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            packed[: -(-self.n // 8)] = np.packbits(bit, bitorder="little")
            words = packed.view(U)
            self.words.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.int32))
            self.zeros.append(self.n - int(bit.sum()))
            x = np.concatenate([x[~bit], x[bit]])
        # Where each symbol's stretch begins on the last level.
        self.first = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, level in enumerate(reversed(range(self.levels))):
            word = at >> 6
            ones = self.before[i][word] + np.bitwise_count(self.words[i][word] & ((U(1) << (at & 63).astype(U)) - U(1))).astype(np.int64)
            at = np.where(symbols >> level & 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, at) - self.first[symbols]


def suffix_order(symbols: np.ndarray, longest: int, ranks_at: tuple[int, ...] = ()) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Suffixes in order, by prefix doubling until all differ; longest: no two agree in more symbols. Also
    the dense ranks by the first k symbols, for the powers of two k in ranks_at."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    kept, k = {}, 1
    while True:
        if k in ranks_at:
            kept[k] = rank
        after = np.zeros(n, np.int64)
        after[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        new = np.zeros(n, np.int64)
        new[1:] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = new
        k *= 2
        if k > longest and all(x in kept for x in ranks_at) or n == 0:
            return order, kept


class FMIndex:
    """Index of texts (arrays of symbols from 0), each with an owner. Texts end in separators that differ from
    each other and are never searched for."""

    def __init__(self, texts: np.ndarray, bounds: np.ndarray, owners: np.ndarray, window: int):
        """texts: all symbols; bounds: n+1 offsets; owners: a number per text; window: length of patterns."""
        m, size = len(owners), max(1, int(texts.max(initial=0)) + 1)
        lengths = np.diff(bounds)
        ends = bounds[1:] + np.arange(m)
        n = len(texts) + m
        body = np.ones(n, bool)
        body[ends] = False
        joined = np.empty(n, np.int64)
        joined[body] = texts + m
        joined[ends] = np.arange(m)
        power = 1 << (window.bit_length() - 1)
        order, ranks = suffix_order(joined, int(lengths.max(initial=0)) + 1, (power,))
        low = ranks[power]
        self.window, self.size = window, size
        before = joined[order - 1]
        self.bwt = WaveletMatrix(np.where(before >= m, before - m + 1, 0), size + 1)
        # Symbols are shifted by one; 0 stands for all separators.
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(np.where(joined >= m, joined - m + 1, 0), minlength=size + 1))])

        def classes(k: int) -> np.ndarray:
            """starts of the runs of neighbouring suffixes that agree in k symbols, as 0, ..., n"""
            same = np.zeros(n + 1, bool)
            if n > 1:
                a, b = order[1:], order[:-1]
                far = lambda x: low[np.minimum(x + k - power, n - 1)]
                inside = (a + k <= n) & (b + k <= n)
                same[1:n] = inside & (low[a] == low[b]) & (far(a) == far(b))
            return np.flatnonzero(~same)

        shorter = classes(window - 1) if window - 1 >= power else None
        self.shorter = shorter
        owner = np.repeat(owners, lengths + 1)[order]
        full = classes(window)
        self.starts = full
        self.least = np.minimum.reduceat(owner, full[:-1]) if n else owner

    def _step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = self.smaller[symbols + 1]
        both = self.bwt.rank(np.concatenate([symbols, symbols]) + 1, np.concatenate([low, high]))
        return base + both[: len(low)], base + both[len(low) :]

    def least_owners(self, texts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of query texts, cut off at the window: (text, offset, least owner) of each place
        of a query from which `window` symbols occur in the index. Queries are read from right to left, all at
        once. Where a window matched, its last symbol is dropped (the suffix interval widens to all that
        agree in window - 1 symbols) and the next symbol to the left is taken; where a symbol fails, the match begins
        anew to the left of the failing window's end. Symbols unknown to the index are -1."""
        n = len(bounds) - 1
        end = bounds[1:].copy()  # exclusive end of the current match
        at = bounds[1:].copy()  # its start
        low, high = np.zeros(n, np.int64), np.full(n, len(self.starts) and self.starts[-1], np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        live = np.flatnonzero(np.diff(bounds) >= self.window)
        total = int(self.starts[-1]) if len(self.starts) else 0
        while len(live):
            full = live[end[live] - at[live] == self.window]
            if len(full):  # drop the last symbol
                if self.shorter is not None:
                    i = np.searchsorted(self.shorter, low[full], "right") - 1
                    low[full], high[full] = self.shorter[i], self.shorter[i + 1]
                    end[full] -= 1
                else:
                    low[full], high[full], end[full], at[full] = 0, total, end[full] - 1, end[full] - 1
            symbol = texts[at[live] - 1]
            known = (symbol >= 0) & (symbol < self.size)
            a, b = self._step(np.clip(symbol, 0, self.size - 1), low[live], high[live])
            good = known & (a < b)
            hit = live[good]
            low[hit], high[hit] = a[good], b[good]
            at[hit] -= 1
            bad = live[~good]
            # The failing symbol stands at at - 1: any window over it and up to `end` fails too.
            end[bad] = np.where(known[~good], end[bad] - 1, at[bad] - 1)
            at[bad], low[bad], high[bad] = end[bad], 0, total
            done = hit[end[hit] - at[hit] == self.window]
            if len(done):
                found.append((done, at[done] - bounds[done], self.least[np.searchsorted(self.starts, low[done], "right") - 1]))
            live = live[end[live] - bounds[live] >= self.window]
            live = live[at[live] > bounds[live]]
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))
