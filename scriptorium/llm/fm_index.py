"""A compressed full-text index over sequences of words: suffix order, Burrows-Wheeler transform in a wavelet tree, matching statistics.

Everything works on whole arrays: many patterns take a backward step at once.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


class WaveletTree:
    """Bit vectors of a sequence of small integers, one a level (most significant bit first, each level sorted by the
    bits before), with the ones before every 64 bits counted: rank in one step a level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.shifts = range(max(1, (sigma - 1).bit_length()) - 1, -1, -1)
        self.words, self.before, self.zeros = [], [], []
        seq = symbols.astype(np.uint32)
        for shift in self.shifts:
            bits = (seq >> np.uint32(shift)) & np.uint32(1)
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            words = np.zeros(len(bits) // 64 + 1, dtype=U)
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.bitwise_count(words).astype(np.int32)
            self.words.append(words)
            self.before.append(np.cumsum(counts, dtype=np.int32) - counts)
            ones = bits.astype(bool)
            self.zeros.append(len(bits) - int(ones.sum()))
            seq = np.concatenate([seq[~ones], seq[ones]])
        self.base = self._descend(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, words, before, zeros in zip(self.shifts, self.words, self.before, self.zeros):
            word = at >> 6
            ones = before[word] + np.bitwise_count(words[word] & ((U(1) << (at & 63).astype(U)) - U(1)))
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._descend(symbol, at) - self.base[symbol]


class FMIndex:
    """Index of texts (sequences of 64-bit word hashes, laid end to end) with a weight each: how often it occurs.

    An end mark of its own closes every text, so no match spans two. Suffixes are ordered by doubling; what two
    neighbours have in common comes from the orders of the rounds.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        self.alphabet, code = np.unique(words, return_inverse=True)
        count, n = len(sizes), len(words) + len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        is_end = np.zeros(n, dtype=bool)
        is_end[ends] = True
        symbols = np.zeros(n, dtype=np.int64)  # 0: an end mark
        symbols[~is_end] = code + 1
        rank = symbols + count - 1
        rank[is_end] = np.arange(count)
        ranks = []
        k = 1
        while True:
            after = np.zeros(n, dtype=np.int64)
            after[: n - k if n > k else 0] = rank[k:] + 1
            key = rank * (n + 1) + after
            order = np.argsort(key, kind="stable")
            ranks.append(rank.astype(np.int32))
            sorted_key = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(np.append(False, sorted_key[1:] != sorted_key[:-1]))
            k *= 2
            if rank[order[-1]] == n - 1:
                break
        self.n, self.end_marks = n, count
        self.first = count + np.concatenate([[0, 0], np.cumsum(np.bincount(code, minlength=len(self.alphabet)))])  # where a symbol's suffixes begin
        self.tree = WaveletTree(symbols[order - 1], len(self.alphabet) + 1)
        self.weight = np.concatenate([[0], np.cumsum(np.repeat(weights, sizes + 1)[order])])
        self.common = self._common(order, ranks)
        self.minima = self._minima()

    def _common(self, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Words that each suffix shares with the one before it in order; -1 at both ends."""
        out = np.full(self.n + 1, -1, dtype=np.int32)
        if self.n > 1:
            x, y = order[:-1].copy(), order[1:].copy()
            shared = np.zeros(self.n - 1, dtype=np.int32)
            for k in range(len(ranks) - 1, -1, -1):
                equal = ranks[k][x] == ranks[k][y]
                shared += equal.astype(np.int32) << k
                x += equal.astype(np.int64) << k
                y += equal.astype(np.int64) << k
            out[1:-1] = shared
        return out

    def _minima(self) -> list[np.ndarray]:
        """Minima of the shared lengths over 2**k positions, by their first."""
        out = [self.common]
        while 2 ** len(out) <= len(self.common):
            half = 2 ** (len(out) - 1)
            out.append(np.minimum(out[-1][:-half], out[-1][half:]))
        return out

    def _widened(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that share the first ``depth`` words with those in [lo, hi)."""
        for k in range(len(self.minima) - 1, -1, -1):
            step, least = 1 << k, self.minima[k]
            can = lo - step + 1 >= 0
            lo = np.where(can & (least[np.maximum(lo - step + 1, 0)] >= depth), lo - step, lo)
            can = hi + step - 1 <= self.n
            hi = np.where(can & (least[np.minimum(hi, len(least) - 1)] >= depth), hi + step, hi)
        return lo, hi

    def matching_statistics(self, words: np.ndarray, sizes: np.ndarray, weight: int) -> np.ndarray:
        """For every position of the streamed texts, how many words from there on occur with this weight at least.

        Backward search from each text's end: a step takes the word before into the match; where too little
        is left, the match gives up words at its end until the step succeeds.
        """
        code = np.searchsorted(self.alphabet, words)
        code[code == len(self.alphabet)] = 0
        symbol = np.where(self.alphabet[code] == words, code + 1, 0) if len(self.alphabet) else np.zeros(len(words), dtype=np.int64)
        out = np.zeros(len(words), dtype=np.int32)
        stop = np.cumsum(sizes) - sizes
        at = stop + sizes - 1
        live = at >= stop
        at, stop = at[live], stop[live]
        lo, hi, size = np.zeros(len(at), dtype=np.int64), np.full(len(at), self.n, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        while len(at):
            c = symbol[at]
            ranks = self.tree.rank(np.concatenate([c, c]), np.concatenate([lo, hi]))
            new_lo, new_hi = self.first[c] + ranks[: len(c)], self.first[c] + ranks[len(c) :]
            taken = (c > 0) & (self.weight[np.minimum(new_hi, self.n)] - self.weight[np.minimum(new_lo, self.n)] >= weight)
            lo[taken], hi[taken] = new_lo[taken], new_hi[taken]
            size[taken] += 1
            out[at[taken]] = size[taken]
            short = np.flatnonzero(~taken & (size > 0))
            if len(short):
                depth = np.maximum(np.maximum(self.common[lo[short]], self.common[hi[short]]), 0).astype(np.int64)
                depth[c[short] == 0] = 0
                lo[short], hi[short] = self._widened(lo[short], hi[short], depth)
                root = short[depth == 0]
                lo[root], hi[root] = 0, self.n
                size[short] = depth
                taken[short] = True
                at[short] += 1
            at -= 1
            live = at >= stop
            if not live.all():
                at, stop, lo, hi, size = at[live], stop[live], lo[live], hi[live], size[live]
        return out
