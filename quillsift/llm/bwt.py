"""Burrows-Wheeler transform of a collection of byte strings, and classes of suffixes that share a prefix of given length.

``classes`` finds them without computing a longest common prefix from text: starting from the first symbols' intervals, each
interval is extended backward by each symbol (LF mapping). A place where suffixes w.x and w.y part at level l sends
the places where c.w.x and c.w.y part to level l + 1, so common prefixes come out breadth first, by increasing value;
the expansion stops at the wanted length, and places not reached by then join suffixes that share at least that many bytes.
Of the parts into which an interval falls, all but the largest are extended; the separated neighbours of its
suffixes are met from the other side.
"""

from __future__ import annotations

import numpy as np


def build(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, symbols (byte + 1; 0 ends each part) and part of each place. Ends are distinct, in the order of parts."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    stops = np.cumsum(sizes + 1) - 1
    n = int(stops[-1]) + 1
    text = np.zeros(n, np.uint64)
    part = np.repeat(np.arange(len(parts)), sizes + 1)
    full = np.ones(n, bool)
    full[stops] = False
    text[full] = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64) + np.uint64(1)
    left = stops[part] - np.arange(n)  # bytes before the end
    key, h = np.zeros(n, np.uint64), 7
    for k in range(h):
        moved = np.zeros(n, np.uint64)
        moved[: max(0, n - k)] = text[k:]
        key = (key << np.uint64(9)) | np.where(left >= k, moved, np.uint64(0))
    order = np.argsort(key)
    short = left < h
    few = np.flatnonzero(short)
    order[short[order]] = few[np.lexsort((part[few], key[few]))]
    sorted_key, tied = key[order], ~short[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (sorted_key[1:] != sorted_key[:-1]) | ~tied[1:]
    del key, sorted_key
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    while True:
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        at = order[slots]
        own = rank[at]
        pair = (own << np.int64(32)) | rank[np.minimum(at + h, n - 1)]
        by = np.argsort(pair)
        at, pair = at[by], pair[by]
        order[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = pair[1:] != pair[:-1]
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        fresh[slots] |= new
        h *= 2
    return order, text.astype(np.uint16), part


def _spread(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of intervals, given their starts and sizes."""
    return np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))


def classes(order: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix, in sorted order, parts from the one before it within ``length`` symbols."""
    n = len(order)
    bwt = text[order - 1]  # of the first place the last end: an end either way
    psi = np.argsort(bwt, kind="stable").astype(np.int32)  # where each suffix's next suffix stands
    lf = np.empty(n, np.int32)
    lf[psi] = np.arange(n, dtype=np.int32)
    first = bwt[psi]
    bound = np.ones(n, bool)
    bound[1:] = (first[1:] != first[:-1]) | (first[1:] == 0)
    split = np.append(bound, True)  # between symbols no interval is extended
    begin = np.flatnonzero(bound)
    # intervals by number: the number of each place, and where each starts and stops
    number = (np.cumsum(bound) - 1).astype(np.int32)
    start, stop, known = np.empty(n, np.int64), np.empty(n, np.int64), len(begin)
    start[:known], stop[:known] = begin, np.append(begin[1:], n)
    size = stop[:known] - start[:known]
    most = int(np.argmax(size))
    part = np.arange(known) != most
    p = _spread(start[:known][part], size[part])
    for _ in range(1, length):
        p = p[bwt[p] != 0]
        q, own = lf[p], number[p]
        up = ~split[q + 1]
        up[up] = number[psi[q[up] + 1]] != own[up]
        down = ~split[q]
        down[down] = number[psi[q[down] - 1]] != own[down]
        marks = np.concatenate((q[up] + 1, q[down]))
        marks = np.unique(marks[~bound[marks]]).astype(np.int64)
        if not len(marks):
            break
        bound[marks] = True
        # each interval with marks falls into parts; the largest keeps its number
        whole = number[marks]
        head = np.ones(len(marks), bool)
        head[1:] = whole[1:] != whole[:-1]
        group = np.cumsum(head) - 1
        ids = whole[head]
        at = np.arange(len(marks)) + group + 1  # a part starts at each mark, and one before the first of each interval
        lo = np.empty(len(marks) + len(ids), np.int64)
        firsts = np.flatnonzero(head) + np.arange(len(ids))
        lo[at], lo[firsts] = marks, start[ids]
        hi = np.append(lo[1:], 0)
        lasts = np.append(firsts[1:], len(lo)) - 1
        hi[lasts] = stop[ids]
        size = hi - lo
        tops = np.repeat(np.maximum.reduceat(size, firsts), np.diff(np.append(firsts, len(lo))))
        large = np.flatnonzero(size == tops)
        owner = np.searchsorted(firsts, large, side="right") - 1
        keep = large[np.unique(owner, return_index=True)[1]]
        start[ids], stop[ids] = lo[keep], hi[keep]
        part = np.ones(len(lo), bool)
        part[keep] = False
        lo, hi, size = lo[part], hi[part], size[part]
        fresh = np.arange(known, known + len(lo))
        start[fresh], stop[fresh], known = lo, hi, known + len(lo)
        p = _spread(lo, size)
        number[p] = np.repeat(fresh, size).astype(np.int32)
    return bound


def repeats(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """class, part and offset of every suffix that shares its first ``length`` bytes with another one, by class."""
    order, text, part = build(parts)
    bound = classes(order, text, length)
    last = np.append(bound[1:], True)
    shared = ~(bound & last)
    at = order[shared]
    starts = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])[:-1]))
    return np.cumsum(bound)[shared], part[at], at - starts[part[at]]
