"""Greedy merging of neighbouring symbols, for many words at once.

As long as neighbours in a word have a merge, the one of least rank is made, the leftmost on ties. A
round makes the next merge of every word of a group, so it is a few array operations whatever the
number of words; words of like length form a group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_BITS = 6  # of a place in a word
LONGEST = 1 << _BITS  # symbols of a word
_NONE = np.iinfo(np.int32).max
_WIDTHS = np.array([*range(2, 17), 20, 24, 32, 48, LONGEST])  # a group's words have up to so many symbols
_ODD = 0x9E3779B97F4A7C15


class Merges:
    """Pairs of symbols with the rank of their merge, and the symbol that it makes.

    The last symbol, `edge`, stands for nothing and is in no pair.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, made: np.ndarray, edge: int):
        if len(rank) and rank.max() >= _NONE >> _BITS:
            raise ValueError("too many ranks")
        self.edge = edge
        self.rank = np.append(rank, _NONE).astype(np.int32)  # by number of the pair; the last: no pair
        self.made = made.astype(np.int32)
        self.only = np.full(rank.max(initial=0) + 1, -1, np.int32)  # what a rank makes; -1: not the same for all its pairs
        self.only[rank] = made
        self.only[rank[self.only[rank] != made]] = -1
        keys, todo = left.astype(np.int64) * (edge + 1) + right, np.arange(len(left), dtype=np.int32)
        self.levels: list[tuple] = []  # a pair whose place is taken is in a later table
        while len(todo):
            bits = max(4, int(4 * len(todo)).bit_length())
            odd, shift = np.uint64((_ODD * (2 * len(self.levels) + 1)) & (1 << 64) - 1), np.uint64(64 - bits)
            slots, first = np.unique((keys.astype(np.uint64) * odd) >> shift, return_index=True)
            held, pairs = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
            held[slots], pairs[slots] = keys[first], todo[first]
            self.levels.append((odd, shift, held, pairs))
            keys, todo = np.delete(keys, first), np.delete(todo, first)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of each pair, -1 without a merge."""
        keys = left.astype(np.int64) * (self.edge + 1) + right
        out = np.full(len(keys), -1, np.int32)
        at = np.arange(len(keys))
        for odd, shift, held, pairs in self.levels:
            slots = ((keys.view(np.uint64) * odd) >> shift).view(np.int64)
            there = held[slots]
            same = there == keys
            out[at[same]] = pairs[slots[same]]
            other = np.flatnonzero(~same & (there >= 0))
            if not len(other):
                break
            keys, at = keys[other], at[other]
        return out

    def merge(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, skipped: Callable | None = None, words: int = 1 << 14) -> None:
        """Merge the words symbols[start : start + size] in place.

        A merged symbol stands at its first place, -1 at the others. `skipped`, of arrays of the word's
        number, the place in it and the length in places, tells which merges are not made.
        `words` are taken at a time.
        """
        if len(sizes) and sizes.max() > LONGEST:
            raise ValueError("a word is too long")
        width = _WIDTHS[np.searchsorted(_WIDTHS, sizes)]
        some = np.flatnonzero(sizes > 1)
        order = some[np.argsort(width[some], kind="stable")]
        ends = np.flatnonzero(np.diff(width[order], append=0))
        begin = 0
        for end in (ends + 1).tolist():
            for i in range(begin, end, words):
                chosen = order[i : min(end, i + words)]
                self._group(symbols, starts[chosen], sizes[chosen], chosen, int(width[chosen[0]]), skipped)
            begin = end

    def _keys(self, left, right, numbers, place, length, skipped) -> np.ndarray:
        rank = self.rank[self.pairs(left, right)]
        out = rank << _BITS | place.astype(np.int32)
        out[rank == _NONE] = _NONE
        if skipped is not None:
            able = np.flatnonzero(rank != _NONE)
            out[able[skipped(numbers[able], place[able], length[able])]] = _NONE
        return out

    def _group(self, symbols, starts, sizes, numbers, n, skipped) -> None:
        count = len(starts)
        places = np.arange(n)[:, None]
        inside = places < sizes
        sym = np.full((n + 2, count), self.edge, np.int32)  # row n: behind the last symbol; n + 1: before the first
        sym[:n][inside] = symbols[(starts + places)[inside]]
        stop = np.repeat(np.arange(1, n + 3)[:, None], count, 1)  # the place behind a symbol
        before = np.repeat(np.arange(-1, n + 1)[:, None], count, 1)  # the place of the symbol before
        before[0] = n + 1
        key = np.full((n + 2, count), _NONE, np.int32)
        place = np.repeat(np.arange(n - 1), count)
        key[: n - 1] = self._keys(sym[: n - 1].ravel(), sym[1:n].ravel(), np.tile(numbers, n - 1), place, np.full(len(place), 2), skipped).reshape(n - 1, count)

        def write(columns) -> None:
            inside = places < sizes[columns]
            symbols[(starts[columns] + places)[inside]] = sym[:n, columns][inside]

        while True:
            best = key[: n - 1].min(axis=0)
            live = np.flatnonzero(best != _NONE)
            if len(live) < 0.75 * count:
                write(np.flatnonzero(best == _NONE))
                if not len(live):
                    return
                sym, stop, before, key = (a.take(live, axis=1) for a in (sym, stop, before, key))  # in row order, as the views below need
                starts, sizes, numbers, best = starts[live], sizes[live], numbers[live], best[live]
                count = len(live)
                live = np.arange(count)
            else:
                best = best[live]
            syms, stops, befores, keys = sym.reshape(-1), stop.reshape(-1), before.reshape(-1), key.reshape(-1)
            place = (best & (LONGEST - 1)).astype(np.int64)
            made = self.only[best >> _BITS]
            here = place * count + live
            second = stops[here] * count + live
            if made.min() < 0:
                tied = np.flatnonzero(made < 0)
                made[tied] = self.made[self.pairs(syms[here[tied]], syms[second[tied]])]
            after = stops[second]
            ahead = after * count + live
            previous = befores[here]
            behind = previous * count + live
            syms[here], stops[here], befores[ahead] = made, after, place
            syms[second], keys[second] = -1, _NONE
            owner = numbers[live]
            follows, precedes = syms[ahead], syms[behind]
            reach = np.where(follows == self.edge, after, stops[ahead])
            keys[here] = self._keys(made, follows, owner, place, reach - place, skipped)
            keys[behind] = self._keys(precedes, made, owner, previous, after - previous, skipped)
