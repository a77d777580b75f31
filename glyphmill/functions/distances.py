"""Edit distances of arrays of numbers, exact for any two, many pairs at a time.

Pairs go side by side along diagonals: how far each diagonal is reached with 0, 1, 2, ... edits. That takes the
square of the edits, whatever the length. Pairs with more edits than that pays for go side by side through their
tables of distances, in blocks of 64 rows as bits: first only near the best path so far, for a bound, then wherever a
path within the bound may pass, which proves the distance. Few pairs at a time are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Pairs, and numbers of both their sides, that go side by side.
GROUP_PAIRS = 512
GROUP_NUMBERS = 1 << 22
#: Windows of equal numbers that are looked at together at most.
MOST_WINDOWS = 64
#: Nanoseconds of one diagonal at one number of edits; of one step bit by bit, and for each number of the other side;
#: of one step of all blocks, and for each of them.
DIAGONAL_NS, STEP_NS, BIT_NS, BLOCKS_NS, BLOCK_NS = 35, 2400, 0.4, 20_000, 30
#: Different numbers whose places are held as bits all the time.
HELD_NUMBERS = 512
#: Steps of blocks between two looks at which blocks are needed; how far from the best a block may be for a first bound.
WINDOW = 32
NEAR = 40
#: Rows of a part of a long pair, a multiple of 64, and how many numbers agree where it is cut: of few kinds, and of many.
PART_ROWS = 1024
RUN, RUN_OF_MANY = 16, 6
#: What a run through a table is for.
NEAREST, WITHIN, PART, LAST_PART = range(4)
#: Blocks that go side by side; pairs, numbers, and words of 64 bits in the tables of places, that wait for it together.
BLOCK_ROOM = 4000
BLOCK_PAIRS = 16384
BLOCK_NUMBERS = 1 << 24
PLACE_WORDS = 1 << 23
_NOWHERE, _FAR = -(1 << 40), 1 << 40
_AT_FIRST, _TRUE = np.array([[(1 << 64) - 1], [0], [0], [1]], np.uint64), np.ones(1, bool)
_ONE, _HALF, _ALL, _NO_CODE = np.uint64(1), np.uint64((1 << 32) - 1), np.uint64((1 << 64) - 1), np.uint32((1 << 32) - 1)


def distance(a: np.ndarray, b: np.ndarray) -> int:
    """Levenshtein distance of one pair."""
    return int(distances([a], [b])[0])


def distances(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Levenshtein distances of pairs of arrays of numbers from 0 to 2**32 - 1."""
    n, m = (np.array([*map(len, side)], np.int64) for side in (a, b))
    found = np.maximum(n, m)
    lengths = n + m
    # Pairs of like length take like many edits.
    order = np.argsort(lengths, kind="stable")
    order = order[np.minimum(n, m)[order] > 0]
    # Those that may share the steps of each through the blocks.
    beside = len(order) - np.searchsorted(lengths[order], lengths[order] // 2)
    most = np.zeros(len(a), np.int64)
    most[order] = _most(n[order], m[order], np.minimum(beside, BLOCK_PAIRS))
    left: list[int] = []
    for group in _groups(order, lengths, GROUP_PAIRS, GROUP_NUMBERS):
        edits = _side_by_side([a[at] for at in group], [b[at] for at in group], most[group], give_up=True)
        found[group[edits >= 0]] = edits[edits >= 0]
        left += group[edits < 0].tolist()
    for group in _groups(np.array(left, np.int64), lengths, BLOCK_PAIRS, BLOCK_NUMBERS):
        found[group] = _beyond_diagonals([a[at] for at in group], [b[at] for at in group])
    return found


def _groups(order: np.ndarray, lengths: np.ndarray, pairs: int, numbers: int) -> Iterator[np.ndarray]:
    """``order`` in stretches of so many pairs and numbers at most, or of one pair."""
    start, held = 0, 0
    for end, length in enumerate(lengths[order].tolist()):
        if end > start and (end - start == pairs or held + length > numbers):
            yield order[start:end]
            start, held = end, 0
        held += length
    if start < len(order):
        yield order[start:]


def _most(n: np.ndarray, m: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Edits up to which diagonals cost less than bits, or blocks of so many pairs."""
    bits = np.minimum(n, m) * (STEP_NS + BIT_NS * np.maximum(n, m))
    # A look for a bound and one for the proof, some seven blocks a column in all; parts of long pairs share steps.
    blocks = 2 * BLOCKS_NS * np.minimum(m, 2 * PART_ROWS) / beside + 7 * BLOCK_NS * m
    return (np.minimum(bits, blocks) / DIAGONAL_NS) ** 0.5 // 1 + 8


def _beyond_diagonals(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Distances of a group by blocks, or bit by bit where that costs less."""
    n, m = (np.array([*map(len, side)], np.int64) for side in (a, b))
    if (np.minimum(n, m) * (STEP_NS + BIT_NS * np.maximum(n, m))).sum() < 2 * BLOCKS_NS * m.max():
        return np.array([_by_bits(x, y) for x, y in zip(a, b, strict=True)], np.int64)
    found = np.zeros(len(a), np.int64)
    for group in _Blocks.of(a, b):
        found[group.places] = group.distances()
    return found


def _windows(numbers: list[np.ndarray], kind: type, end: int, past: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each array begins, and at every place the next numbers as one of 64 bits; ``end`` follows each array, ``past`` times the last."""
    starts = np.cumsum([0, *(len(x) + 1 for x in numbers)])[:-1]
    joined = np.full(starts[-1] + len(numbers[-1]) + past, end, kind)
    for start, x in zip(starts.tolist(), numbers):
        joined[start : start + len(x)] = x
    size = joined.itemsize
    return starts, np.ndarray(len(joined) - 8, np.uint64, joined.tobytes(), strides=(size,)).copy()


def _along_diagonals(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The distance of one pair; None above ``most``."""
    found = int(_side_by_side([a], [b], np.array([most]))[0])
    return None if found < 0 else found


def _side_by_side(a: list[np.ndarray], b: list[np.ndarray], most: np.ndarray, give_up: bool = False) -> np.ndarray:
    """Distances of a group; -1 above ``most``, or with ``give_up`` also where edits are so close that it is likely."""
    n, m = (np.array([*map(len, side)], np.int64) for side in (a, b))
    found = np.full(len(a), -1, np.int64)
    rows = np.flatnonzero(np.abs(m - n) <= most)
    if not len(rows):
        return found
    highest = max((int(x.max()) for side in (a, b) for x in side if len(x)), default=0) + 2
    kind = np.uint8 if highest < 1 << 8 else np.uint16 if highest < 1 << 16 else np.uint32 if highest < 1 << 32 else np.uint64
    size = 8 * np.dtype(kind).itemsize
    per, shift = 64 // size, size.bit_length() - 1
    # After each side comes a number of its own: no pair agrees past its ends, so that paths may go on there.
    past = int(most.max()) + 64 * MOST_WINDOWS + 16
    a_starts, a_next = _windows(a, kind, highest - 1, past)
    b_starts, b_next = _windows(b, kind, highest, past)

    # Places in ``a`` by pair and diagonal, from ``low`` on, with two on each side that are not reached.
    reached, low, edits = np.full((len(rows), 5), _NOWHERE, np.int64), 0, 0
    while len(rows):
        apart, left = m[rows] - n[rows], most[rows] - edits
        # No more diagonals than lead to the end with the edits that are left.
        was, low, high = low, max(-edits, int((apart - left).min())), min(edits, int((apart + left).max()))
        width, at = high - low + 1, low - was + 1
        if edits:
            # One more of ``b``, one of each, or one more of ``a``.
            best = np.maximum(reached[:, at + 1 : at + 1 + width], reached[:, at + 2 : at + 2 + width])
            best += 1
            np.maximum(best, reached[:, at : at + width], out=best)
        else:
            best = np.zeros((len(rows), 1), np.int64)
        reached = np.full((len(rows), width + 4), _NOWHERE, np.int64)
        in_a = (best + a_starts[rows, None]).ravel()
        in_b = (best + (b_starts[rows, None] + np.arange(low, high + 1))).ravel()
        alike = _alike(a_next[in_a], b_next[in_b], shift)
        best += alike.reshape(best.shape)
        on, ahead = np.flatnonzero(alike == per), 4
        flat = best.ravel()
        while len(on):
            # Long runs are few: more and more windows at a time.
            in_a[on] += per
            in_b[on] += per
            next_a, next_b = (np.minimum(i[on, None] + per * np.arange(ahead), len(w) - 1) for i, w in ((in_a, a_next), (in_b, b_next)))
            next_a, next_b = a_next[next_a], b_next[next_b]
            first = np.argmax(next_a != next_b, axis=1)
            row = np.arange(len(on))
            same = next_a[row, first] == next_b[row, first]
            first[same] = ahead - 1
            flat[on] += per * first + _alike(next_a[row, first], next_b[row, first], shift)
            in_a[on] += per * (ahead - 1)
            in_b[on] += per * (ahead - 1)
            on = on[same]
            ahead = min(4 * ahead, MOST_WINDOWS)
        ends = apart - low
        there = (ends >= 0) & (ends < width)
        there &= best[np.arange(len(rows)), np.where(there, ends, 0)] >= n[rows]
        found[rows[there]] = edits
        edits += 1
        stays = ~there & (most[rows] >= edits)
        if give_up and edits >= 32 and edits & (edits - 1) == 0:
            # Given up if as many edits for the rest as for what is behind are too many by a quarter.
            behind = (2 * best + np.arange(low, high + 1)).max(axis=1)
            stays &= 4 * edits * (n[rows] + m[rows]) <= 5 * most[rows] * behind
        if not stays.all():
            rows, best = rows[stays], best[stays]
            reached = reached[: len(rows)]
        reached[:, 2:-2] = best
    return found


def _alike(x: np.ndarray, y: np.ndarray, shift: int) -> np.ndarray:
    """How many numbers of ``2**shift`` bits agree before the first that does not, of windows of 64 bits."""
    differing = x ^ y
    # Its lowest bit less one: as many ones as there are agreeing bits.
    low = np.negative(differing)
    low &= differing
    low -= _ONE
    return np.bitwise_count(low) >> np.uint8(shift)


class _Blocks:
    """Tables of distances of a group, of blocks of 64 rows: a step takes block ``r`` of a table to column ``step - r``.

    A column of a block is where it rises and falls by one from row to row. Columns before the first are as if one
    more of ``b`` came before for each, so that all blocks begin with rises. Only blocks that are needed are held;
    above them distances count as rising with each column, which they cannot exceed.
    """

    def __init__(self, places: np.ndarray, a: list[np.ndarray], b: list[np.ndarray], kinds: list[int]) -> None:
        self.places, self.kinds = places, np.array(kinds, np.int64)
        self.n, self.m = (np.array([*map(len, side)], np.int64) for side in (a, b))
        blocks = (self.n + 63) // 64
        widths = blocks + self.m + 2 * WINDOW
        self.columns = np.cumsum(widths) - widths + blocks + WINDOW - 1
        codes = np.zeros(widths.sum(), np.int32)
        self.firsts = np.cumsum(blocks) - blocks
        self.tables = np.cumsum(blocks * self.kinds) - blocks * self.kinds
        held = int((blocks * self.kinds).sum()) <= PLACE_WORDS
        self.same = np.zeros(int((blocks * self.kinds).sum()) if held else 0, np.uint64)
        self.rows = None if held else np.zeros((int(blocks.sum()), 64), np.uint32)
        self.cuts = [_cuts(x, y, RUN if k < 256 else RUN_OF_MANY) for x, y, k in zip(a, b, kinds, strict=True)]
        for p, (x, y) in enumerate(zip(a, b, strict=True)):
            codes[self.columns[p] + 1 : self.columns[p] + 1 + len(y)] = y
            if held:
                at = np.flatnonzero(x)
                words = self.tables[p] + (at >> 6) * kinds[p] + x[at]
                np.add.at(self.same, words, np.uint64(1) << (at & 63).astype(np.uint64))
            else:
                self.rows[self.firsts[p] : self.firsts[p] + blocks[p]].reshape(-1)[: len(x)] = x
        self.codes = np.lib.stride_tricks.sliding_window_view(codes, WINDOW)

    @staticmethod
    def of(a: list[np.ndarray], b: list[np.ndarray]) -> Iterator[_Blocks]:
        """Groups whose tables of places fit; the places of one pair that does not fit are compared at each step."""
        group: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        held = 0

        def made() -> _Blocks:
            places, x, y, kinds = zip(*group, strict=True)
            return _Blocks(np.array(places), list(x), list(y), list(kinds))

        for place, pair in enumerate(zip(a, b, strict=True)):
            x, y, kinds = _in_common(*pair)
            words = (len(x) + 63) // 64 * kinds
            if group and held + words > PLACE_WORDS:
                yield made()
                group, held = [], 0
            group.append((place, x, y, kinds))
            held += words
        if group:
            yield made()

    def distances(self) -> np.ndarray:
        """All distances.

        Long pairs are cut where both sides agree, and the distances of their parts add up to a bound. It is the
        distance if no part of ``a`` is nearer to any stretch of ``b`` that a path within the bound can take it to.
        Pairs that this does not settle, and short ones, are followed from end to end within their bound.
        """
        parts = [(p, i, j, k, h) for p, cuts in enumerate(self.cuts) for (i, j), (k, h) in zip(cuts, cuts[1:])]
        pair, i, j, i_end, j_end = np.array(parts, np.int64).T
        longer = np.maximum(i_end - i, j_end - j)
        bound = self._run(pair, i, i_end - i, j, j_end - j, np.full(len(pair), NEAREST), longer)
        # Near what nothing in common comes to, the path may have been lost where it is much shorter.
        far = np.flatnonzero(bound > longer // 2 + WINDOW)
        bound[far] = self._within(*(x[far] for x in (pair, i, i_end - i, j, j_end - j, bound, bound // 4)))
        known = np.bincount(pair, bound, len(self.n)).astype(np.int64)
        whole = (np.bincount(pair, minlength=len(self.n)) == 1)[pair]
        # Columns a path within the bound can take a part to.
        most, apart = known[pair], (self.m - self.n)[pair]
        first = np.where(whole, 0, np.maximum(i - (most - apart) // 2, 0))
        last = np.where(whole, j_end, np.minimum(i_end + (most + apart) // 2, self.m[pair]))
        kind = np.where(whole, WITHIN, np.where(i_end == self.n[pair], LAST_PART, PART))
        tried = np.flatnonzero(bound)
        least = bound.copy()
        least[tried] = self._run(*(x[tried] for x in (pair, i, i_end - i, first, last - first, kind, bound)))
        bound[whole] = least[whole]
        known = np.bincount(pair, bound, len(self.n)).astype(np.int64)
        left = np.unique(pair[least < bound])
        known[left] = self._within(left, 0 * left, self.n[left], 0 * left, self.m[left], known[left], known[left])
        return known

    def _within(
        self, pair: np.ndarray, i: np.ndarray, n: np.ndarray, j: np.ndarray, m: np.ndarray, bound: np.ndarray, most: np.ndarray
    ) -> np.ndarray:
        """Distances that are not above ``bound``, tried up to ``most``, then twice that, and so on."""
        bound, most, left = bound.copy(), most.copy(), np.arange(len(pair))
        while len(left):
            tried = self._run(*(x[left] for x in (pair, i, n, j, m, np.full(len(pair), WITHIN), most)))
            bound[left] = np.minimum(bound[left], tried)
            left = left[bound[left] > most[left]]
            most[left] = np.minimum(bound[left], 2 * most[left])
        return bound

    def _run(
        self, pair: np.ndarray, i: np.ndarray, n: np.ndarray, j: np.ndarray, m: np.ndarray, kind: np.ndarray, most: np.ndarray
    ) -> np.ndarray:
        """What ``n`` rows from ``i`` and ``m`` columns from ``j`` of pairs come to; ``i`` is a multiple of 64.

        ``NEAREST``: an upper bound, from blocks near the best path. ``WITHIN``: the distance if it is not above
        ``most``, else an upper bound. ``PART``: the least distance to any stretch of the columns, or ``most`` if that
        is less; ``LAST_PART``: of stretches up to the end. Tables begin, the largest first, as others leave room: a
        step costs much the same for one block and for a thousand.
        """
        order = np.argsort(-(n + m), kind="stable")
        pair, i, n, j, m, kind, most = (x[order] for x in (pair, i, n, j, m, kind, most))
        blocks, apart = (n + 63) // 64, m - n
        part = kind >= PART
        # A table ends with a look at its blocks.
        lag = -(m + blocks - 1) % WINDOW
        waits = lag.copy()
        # Rows of the last block that are not there.
        over = np.array([(-1 << (k - 1) % 64 + 1) & (1 << 64) - 1 for k in n.tolist()], np.uint64)
        known = np.where(part, most, np.maximum(n, m))
        limit = np.minimum(most, known)
        width = np.where(kind == WITHIN, 3 + most // 128, 3)
        begun = 0

        within, parts, nearest = (kind == WITHIN).any(), part.any(), (kind == NEAREST).any()
        # Table, block, and the distance in its last row; where it rises and falls, and by how much the last row did last.
        ints, bits = np.zeros((3, 0), np.int64), np.zeros((4, 0), np.uint64)
        steps = 0
        while ints.shape[1] or begun < len(n):
            room, first = BLOCK_ROOM - ints.shape[1], begun
            while begun < len(n) and room > 0:
                room -= width[begun]
                begun += 1
            if begun > first:
                fresh = np.arange(first, begun)
                waits[fresh] += steps
                ints = np.concatenate([ints, [fresh, 0 * fresh, 64 + lag[fresh]]], axis=1)
                bits = np.concatenate([bits, np.repeat(_AT_FIRST, len(fresh), axis=1)], axis=1)
            (of, block, bottom), (up, down, rose, fell) = ints, bits
            columns, column = m[of], steps - block - waits[of]
            above = bottom - np.bitwise_count(up) + np.bitwise_count(down)
            last_row = (block + 1) << 6
            starts = np.flatnonzero(np.concatenate([_TRUE, of[1:] != of[:-1]]))
            needed = column <= columns
            if within or nearest or (kind[of[starts]] == LAST_PART).any():
                rows, tables = n[of], of[starts]
                # From the last row of a block on, edits of all that is left do.
                rest = bottom + np.maximum(rows - last_row, columns - column)
                rest[(last_row > rows) | (column < 0) | ~needed | part[of]] = _FAR
                done = np.flatnonzero((last_row >= rows) & (column == columns))
                p = of[done]
                rest[done] = bottom[done] - np.bitwise_count(up[done] & over[p]) + np.bitwise_count(down[done] & over[p])
                known[tables] = np.minimum(known[tables], np.minimum.reduceat(rest, starts))
                limit[tables] = np.minimum(limit[tables], known[tables])
                needed[done] = False
            own = limit[of]
            if within:
                # Least distances of whole paths through the last column of the block or right above it, from its last
                # row and from above; and blocks below that such a path may enter before the next look.
                off = apart[of] - column + last_row
                least = np.maximum(bottom + off - 2 * np.clip(off, 0, 64), above + 64 - off - 2 * np.clip(64 - off, 0, 64))
                more = np.maximum(((own - bottom - off + 2 * WINDOW) >> 7) + 1, 0)
                more[bottom - off > own] = 0
                some = least <= own
            if parts:
                # No more than the rows in between can change a distance from one row to another.
                middle = above + np.bitwise_count(up & _HALF) - np.bitwise_count(down & _HALF)
                lower = (middle + bottom - 31) >> 1
                near = np.minimum((above + middle - 31) >> 1, lower) < own
                below = np.where(lower < own, ((own - 1 - lower + WINDOW) >> 6) + 1, 0)
                some, more = (np.where(part[of], near, some), np.where(part[of], below, more)) if within else (near, below)
            if nearest:
                edge = np.where(needed, np.minimum(bottom, above), _FAR)
                edge -= np.repeat(np.minimum.reduceat(edge, starts), np.diff(np.append(starts, len(of)))) + NEAR
                some, more = edge <= 0, bottom - np.minimum(bottom, above) + edge <= 0
            needed &= some if nearest else some | (column < 0)
            # The last block of the table that is asked for so far.
            asked = np.maximum.accumulate((of << 32) + np.where(needed, block + more, 0))
            kept = needed.copy()
            kept[1:] |= asked[:-1] >= (of[1:] << 32) + block[1:]
            kept = np.flatnonzero(kept)
            following = np.full(len(kept), _FAR)
            following[:-1] = np.where(of[kept][1:] == of[kept][:-1], block[kept][1:], _FAR)
            asked = np.minimum(asked[kept] - (of[kept] << 32), blocks[of[kept]] - 1)
            new = np.maximum(np.minimum(asked, following - 1) - block[kept], 0)
            added = int(new.sum())
            if added or len(kept) < len(of):
                before = np.cumsum(new) - new
                to = np.arange(len(kept)) + before
                source = np.repeat(np.arange(len(kept)), new)
                nth = np.arange(added) - before[source]
                was, was_bits = ints[:, kept], bits[:, kept]
                ints, bits = np.empty((3, len(kept) + added), np.int64), np.empty((4, len(kept) + added), np.uint64)
                ints[:, to], bits[:, to] = was, was_bits
                if added:
                    at = to[source] + nth + 1
                    bits[:, at] = _AT_FIRST
                    # A column behind each; distances may have been one more there.
                    under = was[2] - (was_bits[2] - was_bits[3]).view(np.int64)
                    ints[:, at] = was[0, source], was[1, source] + nth + 1, under[source] + 64 * (nth + 1) + nth
                (of, block, bottom), (up, down, rose, fell) = ints, bits
            if not len(of):
                continue
            column = steps - block - waits[of]
            free = part[of] & (block == 0)
            same = self._alike(pair[of], block + i[of] // 64, column + j[of])
            heads = np.concatenate([[True], (of[1:] != of[:-1]) | (block[1:] != block[:-1] + 1)])
            moved = _step(same, heads, free, column, up, down, rose, fell)
            bits[2:] = moved[-1, :, 1:]
            # The last row of a part may end anywhere.
            ends = np.flatnonzero((block == blocks[of] - 1) & (kind[of] == PART))
            if len(ends):
                at = bottom[ends] + np.cumsum((moved[1:, 0, ends + 1] - moved[1:, 1, ends + 1]).view(np.int64), axis=0)
                there = column[ends] + np.arange(1, WINDOW + 1)[:, None]
                at[(there < 0) | (there > m[of[ends]])] = _FAR
                known[of[ends]] = np.minimum(known[of[ends]], at.min(axis=0))
            bottom += (moved[1:, 0, 1:].sum(axis=0) - moved[1:, 1, 1:].sum(axis=0)).view(np.int64)
            steps += WINDOW
        found = np.empty_like(known)
        found[order] = known
        return found

    def _alike(self, pair: np.ndarray, block: np.ndarray, column: np.ndarray) -> Iterator[np.ndarray]:
        """At each of the next columns, which rows of the blocks are as the column."""
        codes = self.codes[self.columns[pair] + column + 1]
        if self.rows is None:
            yield from np.ascontiguousarray(self.same[codes + (self.tables[pair] + block * self.kinds[pair])[:, None]].T)
            return
        rows, codes = self.rows[self.firsts[pair] + block], codes.astype(np.uint32)
        # Zero is of one side only.
        codes[codes == 0] = _NO_CODE
        for at in range(WINDOW):
            yield np.packbits(rows == codes[:, at, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def _step(
    alike: Iterator[np.ndarray], heads: np.ndarray, free: np.ndarray, column: np.ndarray,
    up: np.ndarray, down: np.ndarray, rose: np.ndarray, fell: np.ndarray,
) -> np.ndarray:
    """``WINDOW`` columns on, changing ``up`` and ``down``; what last rows rose and fell at each step, from the one before on."""
    size = len(up)
    # Above the first block distances rise with each column, unless paths may begin anywhere, and fall before the first.
    rising, kept = (heads & ~free).astype(np.uint64), np.where(heads, 0, _ALL)
    early = np.flatnonzero(heads & (column < 0))
    moved = np.zeros((WINDOW + 1, 2, size + 1), np.uint64)
    moved[0, 0, 1:], moved[0, 1, 1:] = rose, fell
    coming, both, vertical = np.empty((2, size), np.uint64), np.empty((2, size), np.uint64), np.empty(size, np.uint64)
    (rises, horizontal), (up_in, down_in) = both, coming
    last = np.uint64(63)
    for at, same in enumerate(alike):
        (rose_in, fell_in), (rose, fell) = moved[at], moved[at + 1]
        np.bitwise_and(rose_in[:-1], kept, up_in)
        np.bitwise_and(fell_in[:-1], kept, down_in)
        np.bitwise_or(up_in, rising, up_in)
        if len(early):
            waiting = early[column[early] + at < 0]
            up_in[waiting], down_in[waiting] = 0, 1
        np.bitwise_or(same, down, vertical)
        np.bitwise_or(same, down_in, same)
        np.bitwise_and(same, up, horizontal)
        np.add(horizontal, up, horizontal)
        np.bitwise_xor(horizontal, up, horizontal)
        np.bitwise_or(horizontal, same, horizontal)
        np.bitwise_or(horizontal, up, rises)
        np.invert(rises, rises)
        np.bitwise_or(rises, down, rises)
        np.bitwise_and(up, horizontal, horizontal)
        np.right_shift(rises, last, rose[1:])
        np.right_shift(horizontal, last, fell[1:])
        np.add(both, both, both)
        np.bitwise_or(both, coming, both)
        np.bitwise_or(vertical, rises, up)
        np.invert(up, up)
        np.bitwise_or(up, horizontal, up)
        np.bitwise_and(rises, vertical, down)
    return moved


def _cuts(a: np.ndarray, b: np.ndarray, run: int) -> list[tuple[int, int]]:
    """Where a long pair may be cut, its ends with it: amid numbers that agree."""
    cuts, at = [(0, 0)], PART_ROWS
    if at + PART_ROWS // 2 <= len(a):
        text, size = b.tobytes(), b.itemsize
    # Up to where it was followed, and how far ``b`` was ahead there.
    seen = ahead = 0

    def around(at: int, reach: int) -> list[int]:
        """The places of a run of ``a`` next to where it would be without edits."""
        sought, like = a[at - run // 2 : at - run // 2 + run].tobytes(), at - run // 2 + ahead
        start, end = max(like - reach, cuts[-1][1]) * size, max(like + reach + run, 0) * size
        middle = min(max(like * size, start), end)
        found = (text.find(sought, middle, end), text.rfind(sought, start, middle + len(sought)))
        return sorted({x // size for x in found if x >= 0 and x % size == 0}, key=lambda x: abs(x - like))

    while at + PART_ROWS // 2 <= len(a):
        places = around(at, 32 + (at - seen) // 4)
        if len(places) > 1 and at - seen > 64:
            # Followed in small steps, not to take one of several like it for another.
            for step in range(seen + 64, at, 64):
                if near := around(step, 32 + (step - seen) // 4):
                    seen, ahead = step, near[0] - step + run // 2
            places = around(at, 32 + (at - seen) // 4)
        if places:
            seen, ahead = at, places[0] - at + run // 2
            cuts.append((at, places[0] + run // 2))
            at += PART_ROWS
        else:
            at += 64
    return [*cuts, (len(a), len(b))]


def _in_common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Both with the numbers they have in common from 1 on, others 0; and how many different ones that makes."""
    highest = int(max(a.max(), b.max()))
    if highest > max(1 << 16, 4 * (len(a) + len(b))):
        different, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b, highest = codes[: len(a)], codes[len(a) :], len(different)
    both = np.zeros(highest + 1, np.int32)
    both[a] = 1
    also = np.zeros(highest + 1, np.int32)
    also[b] = 1
    both &= also
    numbers = np.cumsum(both, dtype=np.int32) * both
    return numbers[a], numbers[b], int(numbers.max()) + 1


def _by_bits(a: np.ndarray, b: np.ndarray) -> int:
    """A column of the table of distances as two long integers: where it rises and where it falls by one."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    n = len(a)
    if not len(b):
        return n
    in_order = np.argsort(a, kind="stable")
    different, firsts = np.unique(a[in_order], return_index=True)
    places = dict(zip(different.tolist(), np.split(in_order, firsts[1:]), strict=True))
    hold, held = len(places) <= HELD_NUMBERS, {}

    def same_as(number: int) -> int:
        if number in held:
            return held[number]
        marks = np.zeros(n, np.uint8)
        marks[places.get(number, ())] = 1
        same = int.from_bytes(np.packbits(marks, bitorder="little").tobytes(), "little")
        if hold:
            held[number] = same
        return same

    every, top = (1 << n) - 1, 1 << (n - 1)
    rises, falls, last = every, 0, n
    for number in b.tolist():
        same = same_as(number) if number in places else 0
        vertical = same | falls
        horizontal = (((same & rises) + rises) ^ rises) | same
        up = falls | (every & ~(horizontal | rises))
        down = rises & horizontal
        last += bool(up & top) - bool(down & top)
        up, down = (up << 1) | 1, down << 1
        rises = (down | ~(vertical | up)) & every
        falls = up & vertical & every
    return last
