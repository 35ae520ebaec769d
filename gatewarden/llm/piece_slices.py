"""Piece paths of many segments at once, in numpy.

A slice of texts is cut into its segments, equal segments are taken once, and all
different ones walk their paths together: each step appends to every segment the
longest piece that fits its last one, or takes its last one back. Substrings are looked
up by hash, from prefix sums over the slice's bytes. The few segments that are very long
or have characters no piece has are walked singly by ``Pieces.path``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from gatewarden.llm.piece_bpe import SPACE, START, Pieces, pieces_of
from gatewarden.llm.text_batches import Slice, mixed

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE_BYTE = 0x20
#: Bytes of the longest segments walked together; a path has no more steps.
STEPS = 48
NEW_PAIRS = 4_096
#: Ids of segments that a process remembers from slice to slice.
SEEN_IDS = 4_000_000


class SeenSegments:
    """Segments by hash, in order, with their ids in one flat array."""

    def __init__(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))

    def known(self, keys: np.ndarray) -> np.ndarray:
        return self.keys[self._places(keys)] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def add(self, keys: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> None:
        """New keys in ascending order, and their ids one after another."""
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start = np.insert(self.start, at, len(self.ids) + bounds[:-1])
        self.size = np.insert(self.size, at, np.diff(bounds))
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def ranges(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) in ``ids`` of known keys."""
        at = self._places(keys)
        return self.start[at], self.size[at]


class SliceEncoder:
    def __init__(self, path: str):
        self.pieces: Pieces = pieces_of(path)
        # In bytes a text's own space stands for the mark, which is written as one byte.
        raw = {i: p.replace(SPACE, " ").encode() for p, i in self.pieces.id.items()}
        keys = np.array([self._hash(b) for b in raw.values()], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.fromiter(raw, np.int64)[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have one hash; choose another base")
        self.sizes = np.zeros(len(self.pieces.text), np.int64)
        for i, b in raw.items():
            self.sizes[i] = len(b)
        self.lengths = sorted({len(b) for b in raw.values()}, reverse=True)
        # Longest piece that begins with two given bytes.
        self.longest = np.ones((256, 256), np.int64)
        for b in raw.values():
            if len(b) > 1:
                self.longest[b[0], b[1]] = max(self.longest[b[0], b[1]], len(b))
        #: Whether the model takes texts as they are, but for spaces and the mark in front.
        self.plain = self.pieces.model.normalize(" a  b\tÀﬁ ") == " a  b\tÀﬁ ".replace(" ", SPACE).join([SPACE, ""])
        # No piece has these characters, so texts may be cut at both of their sides.
        self.apart = np.array([b < 128 and chr(b) not in self.pieces.id and b != _SPACE_BYTE for b in range(256)])
        self.old_pairs = self.new_pairs = (np.zeros(0, np.int64), np.zeros(0, bool))
        self.kept = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        self.seen = SeenSegments()

    @staticmethod
    def _hash(data: bytes) -> int:
        total, power = 0, 1
        for byte in data:
            total = (total + (byte + 1) * power) & 0xFFFFFFFFFFFFFFFF
            power = power * int(_BASE) & 0xFFFFFFFFFFFFFFFF
        return total

    def _fits(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``Pieces.fits`` of many pairs; what is asked for the first time is remembered.

        New pairs go to a short table first, so that the long one is rarely copied.
        """
        key = (first + 1) * len(self.sizes) + second
        out, known = self._remembered(self.old_pairs, key)
        if not known.all():
            left = np.flatnonzero(~known)
            out[left], known[left] = self._remembered(self.new_pairs, key[left])
            if not known.all():
                left = np.flatnonzero(~known)
                new = np.unique(key[left])
                fits = np.array([
                    self.pieces.fits(int(k) // len(self.sizes) - 1, int(k) % len(self.sizes)) for k in new
                ])
                self.new_pairs = self._merged(self.new_pairs, new, fits)
                out[left] = self._remembered(self.new_pairs, key[left])[0]
                if len(self.new_pairs[0]) > NEW_PAIRS:
                    self.old_pairs = self._merged(self.old_pairs, *self.new_pairs)
                    self.new_pairs = (np.zeros(0, np.int64), np.zeros(0, bool))
        return out

    @staticmethod
    def _remembered(pairs: tuple[np.ndarray, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fits, known) of the keys in a sorted table."""
        keys, fits = pairs
        if not len(keys):
            return np.zeros(len(key), bool), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return fits[at], keys[at] == key

    @staticmethod
    def _merged(pairs, keys: np.ndarray, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(pairs[0], keys)
        return np.insert(pairs[0], at, keys), np.insert(pairs[1], at, fits)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse, kept for the next slice."""
        if len(self.kept[0]) < n:
            self.kept = tuple(np.cumprod(np.append(np.uint64(1), np.full(n - 1, base))) for base in (_BASE, _INVERSE))
        return self.kept[0][:n], self.kept[1][:n]

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, offsets of the rows); an empty text has none."""
        # The mark in front of every text, for which its row gets one byte more.
        lengths = np.diff(part.offsets)
        filled = lengths > 0
        offsets = np.zeros(part.rows + 1, np.int64)
        np.cumsum(lengths + filled, out=offsets[1:])
        data = np.full(offsets[-1] + 1, _SPACE_BYTE, np.uint8)  # one byte more, to look ahead
        row_of = np.repeat(np.arange(part.rows), lengths)
        data[np.arange(len(part.data)) + (np.cumsum(filled))[row_of]] = part.data
        end_of_data = int(offsets[-1])
        text = data[:end_of_data]

        space = text == _SPACE_BYTE
        begins = np.zeros(end_of_data, bool)
        begins[1:] = space[1:] & ~space[:-1]
        apart = self.apart[text]
        begins |= apart
        begins[1:] |= apart[:-1]
        begins[offsets[:-1][filled]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], end_of_data)

        powers, back = self._powers(end_of_data + 1)
        sums = np.zeros(end_of_data + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])

        # Two independent hashes: the substring's own and its mix with the length.
        own = (sums[end] - sums[start]) * back[start]
        keys, first, inverse = np.unique(mixed(own + (end - start).astype(np.uint64)), return_index=True, return_inverse=True)
        unseen = ~self.seen.known(keys)
        if unseen.any():
            new = first[unseen]
            self.seen.add(keys[unseen], *self._paths(data, sums, back, start[new], end[new]))
        at, count = self.seen.ranges(keys)
        at, count = at[inverse], count[inverse]
        total = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        ids = self.seen.ids[np.arange(total[-1]) + np.repeat(at - total[:-1], count)]
        segments_before = np.searchsorted(start, offsets)
        if len(self.seen.ids) > SEEN_IDS:
            self.seen = SeenSegments()
        return ids, total[segments_before]

    def _paths(self, data, sums, back, start, end) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the segments, one after another."""
        n = len(start)
        at, last, depth = start.copy(), np.full(n, START), np.zeros(n, np.int64)
        limit = np.full(n, self.lengths[0])
        trail = np.zeros((n, STEPS), np.int32)
        active = np.flatnonzero(end - start <= STEPS)
        finished = np.zeros(n, bool)
        for _ in range(2 * STEPS):
            if not len(active):
                break
            position = at[active]
            room = np.minimum(end[active] - position, self.longest[data[position], data[position + 1]])
            room = np.minimum(room, limit[active])
            chosen = self._longest_fitting(sums, back, position, room, last[active])
            ahead = chosen >= 0
            go, piece = active[ahead], chosen[ahead]
            trail[go, depth[go]] = piece
            depth[go] += 1
            at[go] += self.sizes[piece]
            last[go] = piece
            limit[go] = self.lengths[0]
            done = at[go] == end[go]
            finished[go[done]] = True
            # No edge goes on: take the last one back and try shorter ones in its place.
            back_up = active[~ahead]
            back_up = back_up[depth[back_up] > 0]
            depth[back_up] -= 1
            taken = trail[back_up, depth[back_up]]
            at[back_up] -= self.sizes[taken]
            limit[back_up] = self.sizes[taken] - 1
            last[back_up] = np.where(depth[back_up] > 0, trail[back_up, depth[back_up] - 1], START)
            active = np.concatenate([go[~done], back_up])
        by_hand = {}
        for k in np.flatnonzero(~finished).tolist():
            segment = data[start[k] : end[k]].tobytes().decode().replace(" ", SPACE)
            by_hand[k] = np.array(self.pieces.ids_of(segment, self.pieces.path(segment)), np.int64)
        depth[~finished] = [len(x) for x in by_hand.values()]
        bounds = np.zeros(n + 1, np.int64)
        np.cumsum(depth, out=bounds[1:])
        ids = np.zeros(bounds[-1], np.int64)
        for step in range(int(depth[finished].max(initial=0))):
            own = np.flatnonzero(finished & (depth > step))
            ids[bounds[own] + step] = trail[own, step]
        for k, own in by_hand.items():
            ids[bounds[k] : bounds[k + 1]] = own
        return ids, bounds

    def _longest_fitting(self, sums, back, position, room, last) -> np.ndarray:
        """The longest piece of at most ``room`` bytes at each position that fits the last one; -1 if none."""
        chosen = np.full(len(position), -1)
        open_ = np.arange(len(position))
        for length in self.lengths:
            able = open_[room[open_] >= length]
            if not len(able):
                continue
            p = position[able]
            key = (sums[p + length] - sums[p]) * back[p]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[found] == key
            able, piece = able[hit], self.ids[found[hit]]
            if len(able):
                fit = self._fits(last[able], piece)
                chosen[able[fit]] = piece[fit]
                open_ = open_[chosen[open_] < 0]
        return chosen


@lru_cache(maxsize=2)
def slice_encoder(path: str) -> SliceEncoder:
    return SliceEncoder(path)
