"""Longest common extensions by recompression.

A sequence of numbers is compressed in rounds until rounds stop shortening it. A round first turns every maximal
block of one repeated symbol into a symbol of its own (symbol, length), then splits all symbols at random into left
and right ones and turns every left-right pair into a symbol. Equal stretches are compressed alike but for their
ends, so an extension is answered by climbing the levels while both positions stay aligned, and descending into
the first two symbols that differ: a constant number of steps on each of O(log n) levels. Queries run as vectors.
"""

from __future__ import annotations

import numpy as np

_RNG_SEED = 20250711


class _Level:
    """One string of the grammar. ``sym`` its symbols, ``at`` the place of each in the input (and the input's length),
    ``up`` the place of each one's parent in the next string, ``first`` whether it is its parent's first child,
    ``child`` the first child of each (in the string before), ``blocks`` whether the next string joins blocks."""

    __slots__ = ("sym", "at", "up", "first", "child", "blocks", "left")

    def __init__(self, sym, at, child):
        self.sym, self.at, self.child = sym, at, child
        self.up = self.first = self.left = None
        self.blocks = False

    def join(self, first: np.ndarray, blocks: bool) -> None:
        self.first, self.blocks = first, blocks
        self.up = np.cumsum(first) - 1
        if blocks:                                              # symbols from here to the end of the block
            ends = np.append(np.flatnonzero(first)[1:], len(first))
            self.left = ends[self.up] - np.arange(len(first))

    def mirrored(self, up_len: int, prev_ends) -> "_Level":
        n = len(self.sym)
        m = _Level(self.sym[::-1], self.at[-1] - self.at[::-1], prev_ends)
        if self.first is not None:
            starts = np.flatnonzero(self.first)
            last = np.zeros(n, bool)
            last[np.append(starts[1:], n) - 1] = True
            m.join(last[::-1], self.blocks)
        return m


def _numbered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of each distinct pair."""
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def grammar(seq: np.ndarray) -> list[_Level]:
    """The levels of ``seq`` (int64), the input first."""
    rng = np.random.Generator(np.random.PCG64(_RNG_SEED))
    sym = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    at, count = np.arange(len(seq) + 1), int(sym.max(initial=-1)) + 1
    levels, idle = [_Level(sym, at, None)], 0
    while len(sym) > 1 and idle < 4:
        before = len(sym)
        for blocks in (True, False):
            first = np.ones(len(sym), bool)
            if blocks:
                first[1:] = sym[1:] != sym[:-1]
            else:
                right = rng.random(count) < 0.5                 # in the order of symbols, the same wherever they stand
                first[1:] = ~(right[sym[1:]] & ~right[sym[:-1]])
            if first.all():
                continue
            starts = np.flatnonzero(first)
            size = np.diff(np.append(starts, len(sym)))
            joined = size > 1
            nxt = np.empty(len(starts), np.int64)
            nxt[~joined] = sym[starts[~joined]]
            other = size[joined] if blocks else sym[starts[joined] + 1]
            made = _numbered(sym[starts[joined]], other)
            nxt[joined] = made + count
            count += int(made.max()) + 1
            levels[-1].join(first, blocks)
            at = np.append(at[starts], at[-1])
            sym = nxt
            levels.append(_Level(sym, at, starts))
        present, sym = np.unique(sym, return_inverse=True)      # numbers without gaps keep the next draw short
        sym, count = sym.astype(np.int64), len(present)
        levels[-1].sym = sym
        idle = idle + 1 if len(sym) > 0.95 * before else 0
    return levels


def mirror(levels: list[_Level]) -> list[_Level]:
    """The grammar of the reversed sequence, from the same symbols."""
    out = []
    for t, lv in enumerate(levels):
        ends = None
        if t:
            n = len(levels[t - 1].sym)
            ends = n - np.append(lv.child[1:], n)[::-1]
        out.append(lv.mirrored(0, ends))
    return out


def extensions(levels: list[_Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common extension to the right from each ``i`` and ``j``, where ``i < j``. The sequence must
    end in a number that occurs only there."""
    out = np.zeros(len(i), np.int64)
    a, b = i.astype(np.int64).copy(), j.astype(np.int64).copy()
    live, stop = np.arange(len(i)), []
    for t, lv in enumerate(levels):                             # climb: step over what keeps the two from a parent's start
        x, y = a[live], b[live]
        top = lv.first is None
        if top:
            move = np.ones(len(live), bool)
        else:
            move = ~(lv.first[x] & lv.first[y])
        done = np.zeros(len(live), bool)
        while move.any():
            m = np.flatnonzero(move)
            same = lv.sym[x[m]] == lv.sym[y[m]]
            done[m[~same]] = True
            move[m[~same]] = False
            m = m[same]
            if lv.blocks:
                step = np.minimum(lv.left[x[m]], lv.left[y[m]])
            else:
                step = 1
            x[m] += step
            y[m] += step
            if not top:
                move[m] = ~(lv.first[x[m]] & lv.first[y[m]])
        a[live], b[live] = x, y
        stop.append(live[done])
        live = live[~done]
        if top:
            break
        a[live], b[live] = lv.up[a[live]], lv.up[b[live]]
    down = np.zeros(0, np.int64)
    for t in range(len(stop) - 1, -1, -1):                      # descend: two symbols differ; find where inside them
        lv = levels[t]
        if len(down):
            x, y = levels[t + 1].child[a[down]], levels[t + 1].child[b[down]]
            move = np.ones(len(down), bool)
            while move.any():
                m = np.flatnonzero(move)
                same = lv.sym[x[m]] == lv.sym[y[m]]
                move[m[~same]] = False
                m = m[same]
                step = np.minimum(lv.left[x[m]], lv.left[y[m]]) if lv.blocks else 1
                x[m] += step
                y[m] += step
            a[down], b[down] = x, y
        down = np.concatenate([down, stop[t]])
    out[down] = levels[0].at[a[down]] - i[down]
    return out
