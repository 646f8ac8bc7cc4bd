"""Exact BPE merging: many short words at once in arrays, a long word with a heap."""

from __future__ import annotations

import heapq

import numpy as np

#: The rank of two tokens that no merge joins, and the token behind the end of a word.
NEVER, NOTHING = 1 << 30, 65535
#: Words of up to so many symbols are merged in arrays, so many symbols at a time.
WIDEST, CELLS = 48, 1 << 18


class Merges:
    """The merges of a vocabulary as a hash table over pairs of tokens (ids below 65,535)."""

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]):
        self.merged = np.array([*merged, 0], np.int32)
        self.by_pair = {pair: rank for rank, pair in reversed(list(enumerate(pairs)))}
        self.bits = max(4, int(8 * len(pairs)).bit_length())
        keys = np.array([(left << 16) | right for left, right in self.by_pair], np.int64)
        ranks = np.array(list(self.by_pair.values()), np.int64)
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NEVER, np.int64)
        slots = self._slots(keys)
        while len(keys):
            # One key wins each free place; the others move on to the next.
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            won = self.keys[slots] == keys
            self.ranks[slots[won]] = ranks[won]
            keys, ranks, slots = keys[~won], ranks[~won], (slots[~won] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NEVER`` where no merge joins it."""
        keys = ((left.astype(np.int64) << 16) | right).ravel()
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NEVER)
        missed = np.flatnonzero((found != keys) & (found >= 0))
        slots = slots[missed]
        while len(missed):
            slots = (slots + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots]
            hit = found == keys[missed]
            out[missed[hit]] = self.ranks[slots[hit]]
            still = ~hit & (found >= 0)
            missed, slots = missed[still], slots[still]
        return out.reshape(left.shape)

    # One word.

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the lowest-ranked merge, leftmost first, until none is left; n log n for n symbols.

        A heap holds the possible merges; symbols are linked to their neighbours, and an entry
        whose symbols have changed since is passed over.
        """
        rank, merged = self.by_pair.get, self.merged
        tokens = list(symbols)
        size = len(tokens)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, at, tokens[at], tokens[at + 1]) for at in range(size - 1)
                if (r := rank((tokens[at], tokens[at + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            best, at, left, right = heapq.heappop(heap)
            other = after[at]
            if tokens[at] != left or other >= size or tokens[other] != right:
                continue
            tokens[at], tokens[other] = int(merged[best]), -1
            follow = after[at] = after[other]
            if follow < size:
                before[follow] = at
                if (r := rank((tokens[at], tokens[follow]))) is not None:
                    heapq.heappush(heap, (r, at, tokens[at], tokens[follow]))
            if (previous := before[at]) >= 0 and (r := rank((tokens[previous], tokens[at]))) is not None:
                heapq.heappush(heap, (r, previous, tokens[previous], tokens[at]))
        return [t for t in tokens if t >= 0]

    # Many words.

    def merge_all(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many words: their symbols one after another, and how many each has; the same of the tokens."""
        out, sizes = symbols.astype(np.int32), lengths.copy()
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(lengths, kind="stable")
        order = order[np.searchsorted(lengths[order], 1):]
        at = 0
        while at < len(order):
            shortest = int(lengths[order[at]])
            if shortest > WIDEST:
                for i in order[at:].tolist():
                    found = self.merge(out[starts[i]:starts[i] + lengths[i]].tolist())
                    out[starts[i]:starts[i] + len(found)] = found
                    sizes[i] = len(found)
                break
            width = min(WIDEST, max(4, shortest + shortest // 4))
            stop = min(int(np.searchsorted(lengths[order], width, "right")), at + max(1, CELLS // width))
            rows = order[at:stop]
            width = int(lengths[rows[-1]])
            cells = starts[rows][:, None] + np.arange(width)
            inside = np.arange(width) < lengths[rows][:, None]
            matrix = np.where(inside, out[np.minimum(cells, len(out) - 1)], NOTHING).astype(np.int32)
            found = self._merge_rows(matrix)
            sizes[rows] = (found != NOTHING).sum(axis=1)
            out[cells[inside]] = found[inside]
            at = stop
        ends = np.cumsum(sizes)
        kept = np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return out[kept], sizes

    def _merge_rows(self, tokens: np.ndarray) -> np.ndarray:
        """One merge a turn in every row that has one left; finished rows are set aside."""
        out, width = tokens.copy(), tokens.shape[1]
        if width < 2:
            return out
        live, columns = np.arange(len(tokens)), np.arange(width)
        ranks = self.rank_of(tokens[:, :-1], tokens[:, 1:])
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            going = best < NEVER
            if not going.all():
                out[live[~going]] = tokens[~going]
                live, tokens, ranks, at, best = live[going], tokens[going], ranks[going], at[going], best[going]
            if not len(live):
                return out
            rows = np.arange(len(live))
            # Everything behind the pair moves one place to the left.
            behind = np.minimum(columns + (columns > at[:, None]), width - 1)
            tokens = np.take_along_axis(tokens, behind, axis=1)
            tokens[:, -1] = NOTHING
            tokens[rows, at] = self.merged[best]
            gaps = np.minimum(columns[:-1] + (columns[:-1] >= at[:, None]), width - 2)
            ranks = np.take_along_axis(ranks, gaps, axis=1)
            ranks[:, -1] = NEVER
            inside = at < width - 1
            ranks[rows[inside], at[inside]] = self.rank_of(tokens[rows[inside], at[inside]], tokens[rows[inside], at[inside] + 1])
            left = at > 0
            ranks[rows[left], at[left] - 1] = self.rank_of(tokens[rows[left], at[left] - 1], tokens[rows[left], at[left]])
