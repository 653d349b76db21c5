"""Suffix arrays by induced sorting, and common prefixes in text order. Plain helpers for one shard."""

from __future__ import annotations

import numpy as np


def _buckets(codes: np.ndarray, size: int) -> np.ndarray:
    """Where the bucket of each code starts; one more entry than codes."""
    return np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=size))))


def _is_smaller(codes: np.ndarray) -> np.ndarray:
    """Suffix i is smaller than suffix i + 1 (S-type); the end counts as the least suffix."""
    n = len(codes)
    if n < 2:
        return np.zeros(n, dtype=bool)
    step = np.sign(codes[1:].astype(np.int64) - codes[:-1].astype(np.int64))
    # Equal neighbours take the type of the next position that differs.
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(step, -1)[at] > 0, False)


def _induce(codes: np.ndarray, smaller: np.ndarray, starts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Order of all suffixes induced from the order of the LMS suffixes ``seeds``, one suffix after the other."""
    n, values, types = len(codes), codes.tolist(), smaller.tolist()
    order = [-1] * n
    tails = starts[1:].tolist()
    for i in reversed(seeds.tolist()):
        c = values[i]
        tails[c] -= 1
        order[tails[c]] = i
    heads = starts[:-1].tolist()
    c = values[n - 1]  # the last suffix is larger than the end
    order[heads[c]] = n - 1
    heads[c] += 1
    for at in range(n):
        i = order[at] - 1
        if i >= 0 and not types[i]:
            c = values[i]
            order[heads[c]] = i
            heads[c] += 1
    tails = starts[1:].tolist()
    for at in range(n - 1, -1, -1):
        i = order[at] - 1
        if i >= 0 and types[i]:
            c = values[i]
            tails[c] -= 1
            order[tails[c]] = i
    return np.array(order, dtype=np.int64)


def _append(order: np.ndarray, edge: np.ndarray, codes: np.ndarray, new: np.ndarray, step: int) -> None:
    """Put suffixes ``new`` into their buckets in the order given, from ``edge`` on in direction ``step``."""
    c = codes[new]
    by = np.argsort(c, kind="stable")
    c = c[by]
    first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
    sizes = np.diff(np.append(first, len(c)))
    within = np.arange(len(c)) - np.repeat(first, sizes)
    order[edge[c] + step * within] = new[by]
    edge[c[first]] += step * sizes


def _induce_buckets(codes: np.ndarray, smaller: np.ndarray, starts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """As ``_induce``, a whole bucket at a time: for texts over few codes."""
    n, used = len(codes), np.flatnonzero(np.diff(starts))
    order = np.full(n, -1, dtype=np.int64)
    ends = starts[1:] - 1
    tails = ends.copy()
    if len(seeds):
        _append(order, tails, codes, seeds[::-1], -1)
    heads = starts[:-1].copy()
    _append(order, heads, codes, np.array([n - 1]), 1)

    def before(at: np.ndarray, small: bool) -> np.ndarray:
        at = at[at > 0] - 1
        return at[smaller[at] == small]

    for c in used:
        at = starts[c]
        while at < heads[c]:  # larger suffixes of the bucket; they may add to it
            at, done = heads[c], at
            if len(new := before(order[done:at], False)):
                _append(order, heads, codes, new, 1)
        if len(new := before(order[tails[c] + 1 : ends[c] + 1], False)):
            _append(order, heads, codes, new, 1)
    tails = ends.copy()
    for c in used[::-1]:
        at = ends[c]
        while at > tails[c]:
            at, done = tails[c], at
            if len(new := before(order[at + 1 : done + 1][::-1], True)):
                _append(order, tails, codes, new, -1)
        if len(new := before(order[starts[c] : heads[c]][::-1], True)):
            _append(order, tails, codes, new, -1)
    return order


def _names(codes: np.ndarray, smaller: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """Ranks of the LMS substrings, equal ones alike. They compare by code, then type, position by position.

    As many positions as fit go into one integer; substrings that are longer and still tied go on with the next.
    """
    n, bits = len(codes), (2 * size + 1).bit_length()
    each = 62 // bits
    symbol = np.append(2 * codes.astype(np.int64) + smaller + 1, np.zeros(1, dtype=np.int64))  # 0: the end
    length = np.append(lms[1:] + 1, n + 1) - lms
    rank, live, at = np.zeros(len(lms), dtype=np.int64), np.arange(len(lms)), 0
    while len(live):
        word = np.zeros(len(live), dtype=np.int64)
        for k in range(at, at + each):
            inside = k < length[live]
            word = (word << bits) | np.where(inside, symbol[np.minimum(lms[live] + k, n)], 0)
        # Ranks are places, so that a group of ties can be parted within the places it takes.
        by = np.lexsort((word, rank[live]))
        r, w = rank[live][by], word[by]
        new_group, new = np.append(True, r[1:] != r[:-1]), np.append(True, (r[1:] != r[:-1]) | (w[1:] != w[:-1]))
        place = np.arange(len(live))
        group_at = np.maximum.accumulate(np.where(new_group, place, 0))
        tie_at = np.maximum.accumulate(np.where(new, place, 0))
        rank[live[by]] = r + tie_at - group_at
        at += each
        tied = np.append(~new[1:], False) | ~new
        live = live[by[tied]]
        live = live[length[live] > at]
    return np.unique(rank, return_inverse=True)[1]


#: Up to so many codes, whole buckets are induced at a time.
FEW_CODES = 1024


def suffix_array(codes: np.ndarray, size: int = 256) -> np.ndarray:
    """Starts of the suffixes of ``codes`` (values below ``size``) in ascending order."""
    n = len(codes)
    if n < 2:
        return np.arange(n, dtype=np.int64)
    smaller = _is_smaller(codes)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        reduced = _names(codes, smaller, lms, size)
        top = int(reduced.max()) + 1
        lms = lms[suffix_array(reduced, top) if top < len(lms) else np.argsort(reduced)]
    induce = _induce_buckets if size <= FEW_CODES else _induce
    return induce(codes, smaller, _buckets(codes, size), lms)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Permuted LCP array: for each start, the bytes shared with the suffix before it in ``order``, up to ``most``.

    Along the text a value falls by one at most, so only the starts whose preceding bytes differ
    (irreducible values) are compared byte by byte; the others follow from them.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    fresh = np.ones(n, dtype=bool)
    ok = (here > 0) & (before > 0)
    fresh[ok] = data[here[ok] - 1] != data[before[ok] - 1]
    fresh[1:] |= before[:-1] < 0
    value = np.zeros(n, dtype=np.int64)
    live, at = np.flatnonzero(fresh & (before >= 0)), 0
    # Compared in full, since the values that follow count down from them.
    while len(live):
        x, y = live + at, before[live] + at
        equal = (x < n) & (y < n)
        equal &= data[np.minimum(x, n - 1)] == data[np.minimum(y, n - 1)]
        live = live[equal]
        value[live] += 1
        at += 1
    carried = np.where(fresh, value + here, -1)
    value = np.maximum(np.maximum.accumulate(carried) - here, 0)
    value[before < 0] = 0
    return np.minimum(value, most)
