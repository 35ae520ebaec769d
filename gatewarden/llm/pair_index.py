"""Byte-pair merges of many words at once by an index of pair occurrences.

All words of a batch lie in one array of symbols, linked to their neighbours. An index
maps each pair that has a rank to all its positions in the batch. The active ranks are
applied in ascending order: a rank's pair is merged wherever it still stands, from left
to right where occurrences overlap, and the pairs this makes are entered into the lists
of their own ranks. Entries that a merge has made void are recognised when their rank
comes up. A word takes as many steps as it has merges, so a word of a million letters
is no special case.
"""

from __future__ import annotations

import heapq

import numpy as np

#: Stands between words; no pair with it has a rank.
GAP = -1


class PairMerges:
    """The merges of a vocabulary: ``left[r] + right[r] -> made[r]`` at rank r."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        self.left, self.right, self.made = (np.asarray(x, np.int64) for x in (left, right, made))
        ranks = np.arange(len(self.made))
        last = np.full(int(max(self.left.max(initial=0), self.right.max(initial=0), self.made.max(initial=0))) + 1, -1)
        last[self.made] = ranks
        if (np.maximum(last[self.left], last[self.right]) > ranks).any():
            raise ValueError("a merge comes before the one that makes its parts: ranks have no ascending order")
        self.base = len(last)
        keys = self.left * self.base + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it has none."""
        if not len(self.keys):
            return np.full(len(left), -1)
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[at] == keys) & (left >= 0) & (right >= 0) & (left < self.base) & (right < self.base)
        return np.where(known, self.order[at], -1)

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, sizes) of the words after all merges; ``sizes`` are symbols per word."""
        sizes = np.asarray(sizes, np.int64)
        words = len(sizes)
        word = np.repeat(np.arange(words), sizes)
        token = np.full(len(symbols) + words + 1, GAP, np.int64)  # a gap before each word, and one after all
        place = np.arange(len(symbols)) + word + 1
        token[place] = symbols
        after = np.arange(1, len(token) + 1)
        before = np.arange(-1, len(token) - 1)
        alive = token != GAP
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray) -> None:
            ranks = self.rank_of(token[positions], token[after[positions]])
            found = ranks >= 0
            if not found.any():
                return
            positions, ranks = positions[found], ranks[found]
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts)):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(part)

        enter(place)
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            left, right = self.left[rank], self.right[rank]
            at = at[alive[at] & (token[at] == left) & (token[after[at]] == right)]
            if left == right and len(at) > 1:
                at = at[_first_of_overlaps(at, after)]
            if not len(at):
                continue
            gone = after[at]
            token[at] = self.made[rank]
            alive[gone] = False
            token[gone] = GAP
            after[at] = after[gone]
            before[after[at]] = at
            left_ones = before[at]
            enter(np.unique(np.concatenate([at, left_ones[alive[left_ones]]])))
        kept = alive[place]
        return token[place[kept]], np.bincount(word[kept], minlength=words)


def _first_of_overlaps(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which occurrences of a pair of equal symbols are merged: every other one of a row of overlaps."""
    begins = np.ones(len(at), bool)
    begins[1:] = after[at[:-1]] != at[1:]
    first = np.flatnonzero(begins)
    return (np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))) % 2 == 0
