"""The pieces of a SentencePiece BPE model: merging, adjacency, and max-plus transfer between cuts.

A sequence of pieces is the encoding of its text exactly if every two neighbours are
the encoding of their own concatenation (``fits``). So encoding is a best path: nodes
are (position, last piece), an edge appends a piece, its weight is 0 if the piece fits
the one before and minus infinity if not. A chunk of a text maps the states in which a
path may cross its left cut to those in which it may cross its right cut, and such
max-plus matrices combine associatively.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

SPACE = "▁"
#: A state is (code points beyond the cut, last piece).
State = tuple[int, int]
START, UNKNOWN = -1, -2
#: Segments kept with their ids, per process.
CACHED_SEGMENTS = 200_000
CACHED_PAIRS = 500_000

_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(self.model.get_piece_size())
        special = {
            i for i in numbers
            if self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i) or self.model.is_byte(i)
        }
        self.text = [self.model.id_to_piece(i) for i in numbers]
        self.id = {self.text[i]: i for i in numbers if i not in special}
        self.score = [self.model.get_score(i) for i in numbers]
        self.longest = max(map(len, self.id))
        self.byte = {int(self.text[i][1:-1], 16): i for i in numbers if self.model.is_byte(i)}
        self.raw = [b"" if i in special else self.text[i].replace(SPACE, " ").encode() for i in numbers]
        for value, i in self.byte.items():
            self.raw[i] = bytes([value])
        # No piece has a space behind another character, so none crosses a segment's border.
        if any(SPACE in piece.lstrip(SPACE) for piece in self.id):
            raise ValueError("pieces cross words; cut at other places")
        #: Lengths of the pieces that begin with these three characters (or are shorter), longest first.
        sizes: dict[str, set[int]] = {}
        for piece in self.id:
            sizes.setdefault(piece[:3], set()).add(len(piece))
        self.lengths = {
            start: tuple(sorted(own | {k for k in (1, 2) if start[:k] in self.id}, reverse=True))
            for start, own in sizes.items()
        }
        self.segments: dict[str, list[int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def unknown(self, char: str) -> list[int]:
        """Ids of a character that no piece has: its bytes, or the unknown piece."""
        if len(self.byte) == 256:
            return [self.byte[b] for b in char.encode()]
        return [self.model.unk_id()]

    def merged(self, text: str) -> list[int]:
        """Pieces of a text by merging, best score first, leftmost among equals; UNKNOWN per unknown character."""
        part: list[str | None] = list(text)
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                both = part[i] + part[j]
                found = self.id.get(both)
                if found is not None:
                    heapq.heappush(queue, (-self.score[found], i, both))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, both = heapq.heappop(queue)
            j = after[i]
            if part[i] is None or j >= n or part[i] + part[j] != both:
                continue  # one of the two has been merged since
            part[i], part[j] = both, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.id.get(p, UNKNOWN) for p in part if p is not None]

    def fits(self, first: int, second: int) -> bool:
        """Whether two pieces are the encoding of their concatenation."""
        known = self.pairs.get((first, second))
        if known is None:
            if UNKNOWN in (first, second):
                known = True
            elif first == START:
                known = self.merged(self.text[second]) == [second]
            else:
                known = self.merged(self.text[first] + self.text[second]) == [first, second]
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            self.pairs[first, second] = known
        return known

    def path(self, text: str) -> list[int]:
        """The pieces of a segment as the path from its start to its end, longest edges tried first.

        Only one path reaches a position, so a position that leads nowhere is never tried again.
        """
        n, get, pairs, lengths = len(text), self.id.get, self.pairs, self.lengths
        out: list[int] = []
        ends: list[int] = []
        dead: set[int] = set()
        at, last, room = 0, START, n
        while at < n:
            room = min(room, n - at)
            for length in lengths.get(text[at : at + 3]) or (2, 1):
                if length > room:
                    continue
                piece = get(text[at : at + length])
                if piece is None:
                    if length > 1 or text[at] in self.id:
                        continue
                    piece = UNKNOWN
                if at + length not in dead:
                    fit = pairs.get((last, piece))
                    if fit or fit is None and self.fits(last, piece):
                        out.append(piece)
                        ends.append(at)
                        at, last, room = at + length, piece, n
                        break
            else:  # no edge goes on from here
                dead.add(at)
                room = at - ends[-1] - 1
                at = ends.pop()
                out.pop()
                last = out[-1] if out else START
        return out

    def ids_of(self, text: str, pieces: list[int]) -> list[int]:
        """Ids with the unknown characters of ``text`` written out."""
        if UNKNOWN not in pieces:
            return pieces
        out, at = [], 0
        for p in pieces:
            if p == UNKNOWN:
                out += self.unknown(text[at])
                at += 1
            else:
                out.append(p)
                at += len(self.text[p])
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole normalised text, segment by segment."""
        out: list[int] = []
        known = self.segments
        for segment in _SEGMENT.findall(text):
            ids = known.get(segment)
            if ids is None:
                ids = self.ids_of(segment, self.path(segment))
                if len(segment) <= 64:
                    if len(known) >= CACHED_SEGMENTS:
                        known.clear()
                    known[segment] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that encoding puts in front."""
        text = b"".join([self.raw[i] for i in ids]).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text

    def _ending(self, text: str, end: int, shortest: int = 1):
        """(length, piece) of the pieces that end there."""
        for length in range(shortest, min(self.longest, end) + 1):
            piece = self.id.get(text[end - length : end])
            if piece is not None:
                yield length, piece
        if shortest == 1 and end and text[end - 1] not in self.id:
            yield 1, UNKNOWN

    def crossing(self, text: str, cut: int) -> list[State]:
        """Every state in which a path could cross a cut."""
        return [
            (over, piece)
            for over in range(min(self.longest, len(text) - cut + 1))
            for _, piece in self._ending(text, cut + over, over + 1)
        ]

    def _walk(self, text: str, entries: list[tuple[int, int]], stop: int) -> dict[int, dict[int, list]]:
        """Nodes reached from ``entries`` (position, piece) by pieces that begin before ``stop``.

        Each has [bits of the entries that reach it, position and piece before it].
        """
        nodes: dict[int, dict[int, list]] = {}
        for k, (position, piece) in enumerate(entries):
            node = nodes.setdefault(position, {}).setdefault(piece, [0, None, None])
            node[0] |= 1 << k
        begin = min((p for p, _ in entries), default=stop)
        for end in range(begin + 1, min(stop + self.longest, len(text) + 1)):
            for length, piece in self._ending(text, end):
                start = end - length
                if start >= stop or start not in nodes:
                    continue
                for last, (bits, _, _) in nodes[start].items():
                    if bits and self.fits(last, piece):
                        node = nodes.setdefault(end, {}).setdefault(piece, [0, start, last])
                        if node[1] is None:
                            node[1], node[2] = start, last
                        node[0] |= bits
        return nodes

    def _borders(self, text: str, left: int, right: int) -> tuple[int, int] | None:
        """First and last segment border in [left, right)."""
        def is_border(k: int) -> bool:
            return k > 0 and text[k] == SPACE and text[k - 1] != SPACE

        first = next((k for k in range(left, right) if is_border(k)), None)
        if first is None:
            return None
        return first, next(k for k in range(right - 1, first - 1, -1) if is_border(k))

    def transfer(self, text: str, left: int, right: int, entries: list[State], at_end: bool) -> list[tuple[State, State]]:
        """The finite entries of the chunk's max-plus matrix (their weight is 0)."""
        nodes_in = [(left + over, piece) for over, piece in entries]
        borders = self._borders(text, left, right)
        if borders:
            head = self._walk(text, [e for e in nodes_in if e[0] <= borders[0]], borders[0])
            alive = [e for e in nodes_in if e[0] <= borders[0]]
            bits = 0
            for node in head.get(borders[0], {}).values():
                bits |= node[0]
            alive = {e for k, e in enumerate(alive) if bits >> k & 1}
            tail = self._walk(text, [(borders[1], START)], right)
            exits = self._exits(tail, right, at_end)
            return [(s, x) for s, e in zip(entries, nodes_in) if e in alive for x, b in exits if b]
        nodes = self._walk(text, nodes_in, right)
        return [(s, x) for x, b in self._exits(nodes, right, at_end) for k, s in enumerate(entries) if b >> k & 1]

    @staticmethod
    def _exits(nodes: dict[int, dict[int, list]], right: int, at_end: bool) -> list[tuple[State, int]]:
        return [
            ((end - right, piece), node[0])
            for end, found in nodes.items() if end == right or end > right and not at_end
            for piece, node in found.items()
        ]

    def between(self, text: str, left: int, right: int, entry: State, leave: State) -> list[int]:
        """Ids of the chunk's part of the path that crosses its cuts in these states."""
        first, last = (left + entry[0], entry[1]), (right + leave[0], leave[1])
        borders = self._borders(text, left, right)
        if not borders:
            return self._back(text, self._walk(text, [first], right), first, last)
        head = self._walk(text, [first], borders[0])
        ids = []
        if first[0] < borders[0]:
            (end_piece,) = [p for p, node in head[borders[0]].items() if node[0]]
            ids = self._back(text, head, first, (borders[0], end_piece))
        ids += self.encode(text[borders[0] : borders[1]])
        start = (borders[1], START)
        return ids + self._back(text, self._walk(text, [start], right), start, last)

    def _back(self, text: str, nodes, first: tuple[int, int], last: tuple[int, int]) -> list[int]:
        pieces, (position, piece) = [], last
        while (position, piece) != first:
            pieces.append(piece)
            _, position, piece = nodes[position][piece]
        return self.ids_of(text[first[0] : last[0]], pieces[::-1])


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


Matrix = dict[State, dict[State, float]]


def composed(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus product of two transfer matrices; missing entries are minus infinity."""
    out: Matrix = {}
    for entry, middle in a.items():
        row: dict[State, float] = {}
        for state, weight in middle.items():
            for leave, more in b.get(state, {}).items():
                row[leave] = max(row.get(leave, weight + more), weight + more)
        if row:
            out[entry] = row
    return out


def boundary_states(chunks: list[Matrix], entry: State, leave: State) -> list[State]:
    """States of the best path at all cuts, ends included, by halving: products are associative."""
    products: dict[tuple[int, int], Matrix] = {}

    def product(low: int, high: int) -> Matrix:
        if high - low == 1:
            return chunks[low]
        if (low, high) not in products:
            middle = (low + high) // 2
            products[low, high] = composed(product(low, middle), product(middle, high))
        return products[low, high]

    def resolve(low: int, high: int, start: State, end: State) -> list[State]:
        if high - low == 1:
            return []
        middle = (low + high) // 2
        left, right = product(low, middle)[start], product(middle, high)
        state = max(
            (s for s in left if end in right.get(s, {})), key=lambda s: (left[s] + right[s][end], s)
        )
        return resolve(low, middle, start, state) + [state] + resolve(middle, high, state, end)

    return [entry, *resolve(0, len(chunks), entry, leave), leave]
